"""Sources, streaming, providers, and every query against its SQL on the smallest tables."""

import importlib.util
import json
from datetime import datetime as D
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from lexmill.plans import columns, problems, reference
from lexmill.providers import registry
from lexmill.sources import files, rest
from lexmill.streaming import sync

DATA = "/root/testdata/sf0.001"


# ---- sources


def test_listings_specs_and_timings(spark, tmp_path):
    (tmp_path / "STATUTE-9").mkdir()
    (tmp_path / "STATUTE-9" / "granules.json").write_text(json.dumps([{"granuleId": "STATUTE-9-Pg3", "granuleClass": "TREATY", "title": None}, {"granuleId": "STATUTE-9-FrontMatter-1-Pg1"}]))
    assert {(r.volume, r.granule_class) for r in files.read_listing(spark, f"{tmp_path}/*/granules.json").collect()} == {(9, "TREATY"), (9, None)}
    (tmp_path / "spec.yaml").write_text("granules:\n- STATUTE-9-Pg3\n- {granule_id: STATUTE-9-Pg3, package_id: other}\n- {granule_id: X, package_id: P, era: e}\n")
    assert [(r.granule_id, r.package_id) for r in files.read_spec(spark, str(tmp_path / "spec.yaml")).orderBy("pos").collect()] == [("STATUTE-9-Pg3", "STATUTE-9"), ("X", "P")]
    files.write_spec(spark.createDataFrame([("a", 1)], "granule_id string, n int"), str(tmp_path / "out.yaml"), {"seed": 1})
    assert "granule_id: a" in (tmp_path / "out.yaml").read_text()
    (tmp_path / "a.timing.json").write_text(json.dumps({"variant": "v", "engine": "e", "status": "ok", "pages": 2, "seconds": 3.0, "stats": {"tier": "A"}, "host": {"node": "h"}}))
    (tmp_path / "b.timing.json").write_text("{broken")
    assert [(r.variant, r.tier, r.host) for r in files.read_timings(spark, f"{tmp_path}/*.timing.json").collect()] == [("v", "A", "h")]
    gold = {"granule_id": "STATUTE-1-Pg3", "volume": 1, "period": "p", "pdf_page": 1, "lines": [{"role": "body", "text": "x"}]}
    (tmp_path / "p1.json").write_text(json.dumps(gold, indent=1))
    assert files.read_gold(spark, f"{tmp_path}/p*.json").first().lines[0].text == "x" and files.read_gold(spark, f"{tmp_path}/p*.json", "q").count() == 0
    tree = files.file_tree(spark, str(tmp_path), with_digest=True).collect()
    assert len(tree) == 6 and all(len(r.sha256) == 64 and r.size > 0 for r in tree)
    files.write_json_lines(spark.createDataFrame([("b", None), ("a", 1)], "z string, y int"), str(tmp_path / "lines"), ["z"])
    text = "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*"))
    assert text == '{"y":1,"z":"a"}\n{"y":null,"z":"b"}\n'
    made = []
    listing = lambda: (made.append(1), spark.range(3))[1]
    assert [files.cached_listing(spark, str(tmp_path / "cache"), listing).count() for _ in range(2)] == [3, 3] and made == [1]


def test_schema_validation(spark, tmp_path):
    (tmp_path / "law.xsd").write_text('<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="law"><xs:complexType><xs:sequence><xs:element name="num" type="xs:int"/></xs:sequence></xs:complexType></xs:element></xs:schema>')
    df = spark.createDataFrame([(1, "<law><num>1</num></law>"), (2, "<law><num>x</num></law>"), (3, "<law/>"), (4, "<law>"), (5, None)], "i int, x string")
    got = {r.i: r.v for r in df.select("i", files.is_valid(F.col("x"), str(tmp_path / "law.xsd")).alias("v")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: None}


def test_paginated_listing_pushes_filters(spark, tmp_path):
    page = lambda n, more: {"packages": [{"packageId": f"P{n}", "congress": "118"}, {"packageId": f"Q{n}", "congress": "117"}], **({"nextPage": "x", "nextOffsetMark": "m2"} if more else {})}
    (tmp_path / "collections_PLAW-first.json").write_text(json.dumps(page(1, True)))
    (tmp_path / "collections_PLAW-m2.json").write_text(json.dumps(page(2, False)))
    assert [x["packageId"] for x in rest.pages(rest.folder_fetch(str(tmp_path)), "collections/PLAW", {}, "packages")] == ["P1", "Q1", "P2", "Q2"]
    reader = rest.ListingReader({"collections": "PLAW"}, None, [])
    list(reader.pushFilters([rest.EqualTo(("congress",), "118"), rest.GreaterThanOrEqual(("lastModified",), "2025-01-01")]))
    assert reader.params == {"congress": "118", "since": "2025-01-01T00:00:00Z"}
    rest.register_listing(spark, rest.folder_fetch(str(tmp_path)))
    df = spark.read.format("listing").option("collections", "PLAW").load()
    assert sorted(r.packageId for r in df.where("title is null").collect()) == ["P1", "P2", "Q1", "Q2"]


# ---- providers


def test_units_fail_as_rows(spark):
    def start(variant):
        def engine(row):
            if row["text"] is None:
                raise ValueError("no text")
            return f"{variant}:{row['text']}", 2

        return engine

    registry.register(registry.Family("stub", start))
    got = {r.unit_id: (r.status, r.payload, r.error) for r in registry.run_units(spark.createDataFrame([("a", "x"), ("b", None)], "unit_id string, text string"), "stub:v").collect()}
    assert got == {"a": ("success", "v:x", None), "b": ("failed", None, "ValueError: no text")}
    with pytest.raises(KeyError, match="unknown profile"):
        registry.family_of("nothing:here")
    waits = spark.createDataFrame([(429, "7", 1), (503, None, 3), (404, None, 1)], "s int, h string, n int").select(registry.retry_after(F.col("s"), F.col("h"), F.col("n")).alias("w")).collect()
    assert [r.w for r in waits] == [7, 8, None]


# ---- streaming


def test_stream_folds_late_attempts_into_state(spark, tmp_path):
    schema = "unit_id string, status string, finished_at timestamp"
    for i, rows in enumerate([[("a", "failed", D(2025, 1, 2)), ("b", "running", None)], [("a", "success", D(2025, 1, 1)), ("b", "success", D(2025, 1, 3))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    seen = {}

    def keep(batch, n):
        seen.update({r.unit_id: (r.status, r.attempts) for r in batch.collect()})

    stream = sync.latest_status(sync.incoming(spark, f"{tmp_path}/in/*", schema, 1))
    stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert seen == {"a": ("failed", 2), "b": ("success", 2)}
    counted = []
    q = sync.run_batches(sync.incoming(spark, f"{tmp_path}/in/*", schema, 1), lambda b, n: counted.append(b.count()), f"{tmp_path}/cp2")
    q.awaitTermination()
    assert sum(counted) == 4
    windows = sync.attempt_counts(sync.incoming(spark, f"{tmp_path}/in/*", schema), "finished_at")
    windows.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == 3


def test_metadata_is_written_only_when_it_changes(spark):
    rows, written = {"n": 1}, []
    sink = sync.MetadataSink(lambda: spark.range(rows["n"]), lambda df: written.append(df.count()), every=2)
    sink.batch()
    sink.batch()
    sink.batch()
    sink.batch()
    rows["n"] = 2
    assert sink.flush() and written == [1, 2]


# ---- queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def _compare():
    spec = importlib.util.spec_from_file_location("compare", Path(__file__).resolve().parents[1] / "compare.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("name", [*problems.QUERIES, *reference.QUERIES, *columns.QUERIES])
def test_query_equals_its_sql(spark, duck, name):
    queries, sqls = problems.QUERIES | reference.QUERIES | columns.QUERIES, problems.SQL | reference.SQL | columns.SQL
    df = queries[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in sqls:
        assert df.columns
        return
    rel = duck.sql(sqls[name])
    canonical = _compare().canonical
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical(got, df.columns) == canonical(rel.fetchall(), rel.columns)
