"""The general training-data problems: small cases with nulls, ties, repeated rows, empty tables and clashing columns, and brute force."""

import json
import random
from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from lexmill.operators.diff import Field, diff_copies, diff_fields
from lexmill.operators.incremental import CommitConflict, IntervalLedger, merge_intervals, number_arrivals, pending, subtract_intervals, to_intervals
from lexmill.operators.references import hot_keys, orphan_references, orphan_report, validity_intervals
from lexmill.operators.shred import Path, Shredder, Table, decode, decoded, positions, rebuild, shred, shred_tables
from lexmill.session import digest_key, entity_key, latest

T = lambda day: D(2025, 1, day)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- keys


def test_keys(spark):
    df = spark.createDataFrame([(" STATUTE-7 ", "SHA256:AB "), ("statute-7@eng", "ab"), ("  ", ""), (None, None), ("\xa0x\t", " sha256: ab")], "k string, d string")
    got = df.select(entity_key(F.col("k")), digest_key(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("statute-7", "ab"), ("statute-7", "ab"), (None, None), (None, None), ("x", "ab")]


def test_latest_breaks_ties_by_content_and_takes_null_as_oldest(spark):
    df = spark.createDataFrame([("a", T(1), 1), ("a", T(2), 2), ("a", T(2), 3), ("a", T(2), 3), ("b", None, 9), (None, T(1), 4)], "k string, at timestamp, v int")
    assert rows(latest(df, ["k"], ["at"], ["v"])) == [("a", 3), ("b", 9), (None, 4)]
    assert rows(latest(df.limit(0), ["k"], ["at"], ["v"])) == []


# ---- 1


def _orphans(spark, refs, parents):
    r = spark.createDataFrame(refs, "child_table string, child_key string, ref_key string, child_created timestamp, ref_extra string, valid_to int")
    p = spark.createDataFrame(parents, "id string, updated timestamp, created timestamp, deleted timestamp, child_key string")
    return orphan_references(r, validity_intervals(p, F.lower("id"), "updated", "created", "deleted"))


def test_orphans_tell_missing_deleted_and_late_apart(spark):
    parents = [("A", T(1), T(1), None, "x"), ("A", T(2), T(1), T(2), "x"), ("B", T(1), T(5), None, None), ("C", T(1), T(1), T(3), None), ("C", T(4), T(1), None, None), (None, T(1), T(1), None, None), ("D", None, None, None, None)]
    refs = [("t", "1", "a", T(3), "", 1), ("t", "2", "b", T(3), "", 1), ("t", "3", "b", T(6), "", 1), ("t", "4", "c", T(3), "", 1), ("t", "5", "zz", T(3), "", 1), ("t", "5", "zz", T(3), "", 1), ("t", "6", None, T(3), "", 1), ("t", "7", "d", T(3), "", 1), ("t", "8", "b", None, "", 1), ("t", "9", "zz", None, "", 1)]
    got = rows(_orphans(spark, refs, parents))
    assert got == sorted([("t", "1", "deleted", "2025-01"), ("t", "2", "late", "2025-01"), ("t", "5", "missing", "2025-01"), ("t", "9", "missing", None)], key=str)
    assert ("t", "2025-01", "missing", 1) in rows(orphan_report(_orphans(spark, refs, parents)))


def test_orphans_of_empty_tables(spark):
    assert rows(_orphans(spark, [], [("A", T(1), T(1), None, "")])) == []
    assert rows(_orphans(spark, [("t", "1", "a", T(1), "", 1)], [])) == [("t", "1", "missing", "2025-01")]


def test_orphans_with_a_hot_parent_against_brute_force(spark):
    rng = random.Random(3)
    parents = [(f"p{i}", T(rng.randint(1, 9)), T(rng.randint(1, 9)), T(5) if rng.random() < 0.3 else None, "") for i in range(20) for _ in range(rng.randint(0, 3))]
    refs = [("t", str(i), "p1" if rng.random() < 0.4 else f"p{rng.randint(0, 25)}", T(rng.randint(1, 9)), "", 0) for i in range(600)]
    newest = {}
    for k, u, c, d, _ in parents:
        # ties as in latest(): by creation, then deletion, NULL first
        key = (u, c, d is not None, d or T(1))
        newest[k] = max(newest.get(k, key), key)
    want = set()
    for _, i, k, created, *_ in refs:
        p = newest.get(k)
        reason = "missing" if p is None else "deleted" if p[2] else "late" if p[1] > created else None
        if reason:
            want.add(("t", i, reason, "2025-01"))
    assert set(rows(_orphans(spark, refs, parents))) == want
    frame = spark.createDataFrame(refs, "child_table string, child_key string, ref_key string, child_created timestamp, a string, b int")
    hot = hot_keys(frame, F.col("ref_key"), 20)
    assert max(hot, key=hot.get) == "p1" and hot["p1"] == sum(r[2] == "p1" for r in refs) // 20 + 1
    whole = validity_intervals(spark.createDataFrame(parents, "id string, updated timestamp, created timestamp, deleted timestamp, x string"), F.lower("id"), "updated", "created", "deleted")
    assert set(rows(orphan_references(frame, whole, hot))) == want


# ---- 2

TABLES = [Table("items", ("texts[].id", "texts[].parent.$ref", "texts[].prov[].bbox.l"), 2, outer=True), Table("leaf", ("a[].b[].c[]",), 3)]


def test_levels_of_nested_repetition():
    p = Path.parse("a[].b[].c[]")
    col = shred({"a": [{"b": [{"c": [1, 2]}, {"c": 3}]}, {}, {"b": {"c": []}}]}, p)
    assert [(r, d, v) for r, d, v in col] == [(0, 3 + 0, 1), (3, 3, 2), (2, 3, 3), (1, 1, None), (1, 2, None)]
    assert [at for at, *_ in positions(col, p)] == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1,), (2, 0)]


def test_round_trip_of_random_records_against_plain_loops():
    rng = random.Random(5)
    paths = sorted({x for t in TABLES for x in t.leaves})
    for _ in range(400):
        texts = [{k: v for k, v in (("id", f"#{i}"), ("parent", rng.choice([None, {"$ref": "p"}, "q"])), ("prov", rng.choice([None, [], {"bbox": {"l": 1}}, [{"bbox": {"l": 2}}, {}, {"bbox": {}}]]))) if rng.random() < 0.9} for i in range(rng.randint(0, 4))]
        nested = [{"b": [{"c": [rng.random() for _ in range(rng.randint(0, 3))]} for _ in range(rng.randint(0, 3))]} for _ in range(rng.randint(0, 3))]
        rec = {"texts": texts, "a": nested} if rng.random() < 0.9 else {}
        columns = {x: shred(rec, Path.parse(x)) for x in paths}
        want = []
        for i, t in enumerate(rec.get("texts", [])):
            parent = t.get("parent")
            parent = parent["$ref"] if isinstance(parent, dict) else parent
            prov = t.get("prov")
            prov = [prov] if isinstance(prov, dict) else prov or []
            places = [(k, p.get("bbox", {}).get("l")) for k, p in enumerate(prov)] or [(-1, None)]
            want += [([i, k], [t.get("id"), parent, None if v is None else json.dumps(v)]) for k, v in places]
        assert list(rebuild(columns, TABLES[0])) == want
        want = [([i, j, k], [json.dumps(v)]) for i, x in enumerate(rec.get("a", [])) for j, y in enumerate(x["b"]) for k, v in enumerate(y["c"])]
        assert list(rebuild(columns, TABLES[1])) == want


def test_maps_lists_of_lists_and_single_values():
    rec = {"pages": {"2": {"n": 5}, "1": {"n": 6}, "x": 3}, "t": [{"grid": [[{"c": "a"}, {"c": "b"}], [], [{"c": 1}]]}, {"grid": {"c": "single"}}, {}], "parent": "p", "body": {"children": {"$ref": "r"}}}
    tables = [Table("pages", ("pages{}.$key", "pages{}.n"), 1), Table("cells", ("t[].grid[][].c",), 3), Table("top", ("parent.$ref", "absent"), 0), Table("body", ("body.children[].$ref",), 1)]
    columns = Shredder({x for t in tables for x in t.leaves})(rec)
    got = {t.name: list(rebuild(columns, t)) for t in tables}
    assert got["pages"] == [([0], ["2", "5"]), ([1], ["1", "6"]), ([2], ["x", None])]
    assert got["cells"] == [([0, 0, 0], ["a"]), ([0, 0, 1], ["b"]), ([0, 2, 0], ["1"]), ([1, 0, 0], ["single"])]
    assert got["top"] == [([], ["p", None])] and got["body"] == [([0], ["r"])]
    # one walk gives the columns that a walk per path gives
    assert all(Shredder([x])(rec)[x] == c for x, c in columns.items()) and shred(rec, "parent.$ref") == [(0, 2, "p")]


@pytest.mark.parametrize("text", [None, "", "{", "[1]", "null", "3", '{"a": NaN}', '"{"', "{} x"])
def test_unreadable_payloads(text):
    assert decode(text) is None


def test_shredding_takes_the_latest_readable_delivery(spark):
    good = lambda n: json.dumps({"texts": [{"id": f"#{n}", "prov": [{"bbox": {"l": "1.5"}}]}]})
    data = [("a", good(1), T(1)), ("a", good(2), T(2)), ("a", good(2), T(2)), ("a", good(3)[:-2], T(3)), ("a", None, T(4)), ("b", json.dumps(good(4)), T(1)), ("c", "{}", T(1)), (None, good(5), T(1)), ("d", "oops", T(1))]
    df = spark.createDataFrame(data, "k string, payload string, at timestamp").withColumn("tbl", F.lit(1)).withColumn("_rows", F.lit(2))
    got = rows(shred_tables(df, {"k": F.col("k")}, "payload", "at", TABLES[:1]))
    assert got == [("a", "items", [0, 0], ["#2", None, "1.5"]), ("b", "items", [0, 0], ["#4", None, "1.5"])]
    assert rows(shred_tables(df.limit(0), {"k": F.col("k")}, "payload", "at", TABLES)) == []
    assert [r.k for r in decoded(df, "k", "payload", "at").orderBy("k").collect()] == ["a", "b", "c"]


def test_long_payload(spark):
    df = spark.createDataFrame([("a", json.dumps({"texts": [{"id": str(i), "prov": []} for i in range(5000)]}), T(1))], "k string, payload string, at timestamp")
    assert shred_tables(df, {"k": F.col("k")}, "payload", "at", TABLES[:1]).count() == 5000


# ---- 3


def _numbers(df):
    return sorted(n for r in df.collect() for n in range(r.lo, r.hi + 1))


def test_intervals_against_sets(spark):
    rng = random.Random(1)
    for bits in (2, 4, 16):
        a, p = ({rng.randint(0, 60) for _ in range(rng.randint(0, 40))} for _ in range(2))
        df = lambda s: spark.createDataFrame([(x,) for x in s] + [(None,)] + [(x,) for x in list(s)[:3]], "seq long")
        ia, ip = to_intervals(df(a), "seq", bits), to_intervals(df(p), "seq", bits)
        assert _numbers(ia) == sorted(a)
        assert _numbers(subtract_intervals(ia, ip, bits)) == sorted(a - p)
        assert _numbers(merge_intervals(ia, ip, block_bits=bits)) == sorted(a | p)
        for r in merge_intervals(ia, ip, block_bits=bits).collect():
            assert r.lo >> bits == r.hi >> bits == r.block


def test_pending_keeps_repeated_rows_and_other_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "seq long, lo string")
    done = spark.createDataFrame([(1, 1)], "lo long, hi long")
    assert rows(pending(df, done)) == [(2, "b"), (2, "b"), (3, None)]
    assert rows(pending(df.limit(0), done)) == []


def test_arrivals_get_numbers_without_gaps(spark):
    df, behind = number_arrivals(spark.range(100).repartition(7).select((99 - F.col("id")).alias("x")), 40)
    assert behind == 140 and sorted(r.seq for r in df.collect()) == list(range(40, 140)) and df.select("x").distinct().count() == 100
    empty, behind = number_arrivals(spark.range(0), 40)
    assert behind == 40 and empty.count() == 0


def _ledger(spark, tmp_path):
    return IntervalLedger(spark, str(tmp_path / "ledger"), ["k"], ["v"])


def _versions(spark, *pairs):
    return spark.createDataFrame([(k, v, f"{k}{v}") for k, v in pairs], "k string, v int, seq_ string")


def test_ledger_takes_each_version_once_though_new_keys_sort_first(spark, tmp_path):
    ledger = _ledger(spark, tmp_path)
    assert ledger.pending() is None and ledger.run(lambda d: d) is None and ledger.output() is None
    assert ledger.arrive(_versions(spark, ("b", 1), ("c", 1), ("d", 1), ("d", 1), (None, None))) == 4
    ledger.run(lambda d: d)
    # a new key before all others, a changed version, and all the old ones again
    assert ledger.arrive(_versions(spark, ("a", 1), ("b", 1), ("c", 2), ("c", 1), ("d", 1), (None, None))) == 2
    assert sorted(r.k for r in ledger.pending().collect()) == ["a", "c"]
    ledger.run(lambda d: d)
    assert ledger.pending().count() == 0
    assert rows(ledger.output().select("k", "v")) == sorted([("a", 1), ("b", 1), ("c", 1), ("c", 2), ("d", 1), (None, None)], key=str)
    log = ledger.log()
    assert log.select("seq").distinct().count() == log.count() == 6
    assert ledger.arrive(_versions(spark)) == 0 and ledger.run(lambda d: d) and ledger.output().count() == 6


def test_of_two_runs_at_the_same_time_one_commits(spark, tmp_path):
    ledger, other = _ledger(spark, tmp_path), _ledger(spark, tmp_path)
    ledger.arrive(_versions(spark, ("a", 1), ("b", 1)))

    def meanwhile(d):
        assert other.run(lambda x: x) is not None
        return d

    with pytest.raises(CommitConflict):
        ledger.run(meanwhile)
    assert rows(ledger.output().select("k")) == [("a",), ("b",)] and ledger.pending().count() == 0
    # new versions that arrive while a run goes on don't stop it
    ledger.arrive(_versions(spark, ("c", 1)))

    def arrives(d):
        other.arrive(_versions(spark, ("d", 1)))
        return d

    ledger.run(arrives)
    assert rows(ledger.pending().select("k")) == [("d",)]
    ledger.run(lambda d: d)
    assert rows(ledger.output().select("k")) == [("a",), ("b",), ("c",), ("d",)]


def test_of_two_deliveries_at_the_same_time_one_commits(spark, tmp_path):
    ledger, other = _ledger(spark, tmp_path), _ledger(spark, tmp_path)
    seen = ledger.commits()
    other.arrive(_versions(spark, ("a", 1)))
    with pytest.raises(CommitConflict):
        ledger._commit({"kind": "arrivals", "folder": "data/none", "first": 0, "next": 1}, seen)
    assert ledger.arrive(_versions(spark, ("a", 1), ("b", 1))) == 1


def test_ledger_survives_failures_and_takes_late_results_once(spark, tmp_path):
    ledger = _ledger(spark, tmp_path)
    ledger.arrive(_versions(spark, ("a", 1), ("b", 1), ("c", 1)))

    def broken(d):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.run(broken)
    assert ledger.output() is None and ledger.pending().count() == 3
    # b fails at first: its number stays a gap in the middle
    first = [r.k for r in ledger.log().orderBy("seq").collect()][1]
    ledger.run(lambda d: d.withColumn("ok", F.col("k") != first), done=lambda out: out.where("ok"))
    assert rows(ledger.pending().select("k")) == [(first,)]
    ledger.arrive(_versions(spark, ("e", 1)))
    ledger.run(lambda d: d.withColumn("ok", F.lit(True)))
    assert ledger.pending().count() == 0
    assert rows(ledger.output().where("ok").select("k")) == [("a",), ("b",), ("c",), ("e",)]


# ---- 5


def test_differences_of_copies(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z"), (None, 4, "n")], "k string, size int, sha string")
    right = spark.createDataFrame([("a", 1, "x", 7), ("b", 3, "y", 7), ("d", 4, "q", 7), (None, 4, "m", 7)], "k string, size int, sha string, extra int")
    fields = [Field("size", F.col("l.size"), F.col("r.size")), Field("sha", F.upper("l.sha"), F.upper("r.sha")), Field("odd", F.col("l.size"), F.lit(2), within=True)]
    diffs = diff_copies(left, right, "k", fields, "no_right", "no_left")
    got = rows(diff_fields(diffs, "k"))
    want = [("a", "odd", "1", "2"), ("b", "size", "2", "3"), ("c", "no_right", None, None), ("c", "odd", "3", "2"), ("d", "no_left", None, None), (None, "sha", "N", "M"), (None, "odd", "4", "2")]
    assert got == sorted(want, key=str)
    assert {r.field for r in diff_fields(diff_copies(left, right.limit(0), "k", fields[:2], "no_right", "no_left"), "k").collect()} == {"no_right"}
    assert diff_copies(left.limit(0), right.limit(0), "k", fields, "x", "y").count() == 0
