"""Scalar functions and the ledger, sampling, comparison, splitting, layout, building and substitution operators."""

import random
import statistics
import xml.etree.ElementTree as ET
from datetime import date

import pytest
from pyspark.sql import functions as F

from lexmill.functions import costs, fuzzy, ids, markers, text, xml
from lexmill.operators import build, catalog, hybrid, layout, metrics, report, sampling, split


def one(spark, column, *values, kinds=None):
    names = [f"c{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds or ["string"] * len(values), strict=True))
    return spark.createDataFrame([values], schema).select(column(*[F.col(n) for n in names]).alias("x")).first().x


# ---- text and identifiers


@pytest.mark.parametrize("raw, want", [("“a”  –  b", '"a" - b'), ("co-\n  operate", "cooperate"), ("x\xadyﬁ ½", "xyfi 1⁄2"), (" ( a ) , b", "(a), b"), ("a\n\n b\t c", "a b c"), ("", "")])
def test_normalize_in_both_forms(spark, raw, want):
    assert one(spark, text.normalize, raw) == want == xml.normalize_text(raw)


def test_text_functions(spark):
    assert one(spark, text.tokens, "Évé, 2 (b)") == ["Évé", ",", "2", "(", "b", ")"]
    assert one(spark, text.blank_tokens, " a  b\n") == ["a", "b"] and one(spark, text.blank_tokens, " ") == []
    assert one(spark, text.clean, "a\xad b\xa0 \nc ") == "a b \nc" and one(spark, text.squash, " a \n b ") == "a b"
    lines = [("body", " a "), ("odd", "b"), ("footnote", ""), ("sidenote", "s")]
    kind = "array<struct<role:string,text:string>>"
    assert [tuple(r) for r in one(spark, text.clean_lines, lines, kinds=[kind])] == [("body", "a"), ("body", "b"), ("sidenote", "s")]
    assert one(spark, lambda c: text.role_text(c, text.TEXT_ROLES), lines, kinds=[kind]) == "a"
    assert one(spark, text.line_chars, lines, kinds=[kind]) == 3
    assert one(spark, text.numbered_lines, lines[:2], kinds=[kind]) == "1. [body]  a \n2. [odd] b"
    assert one(spark, lambda c: text.trim_xml(c, 20), "<a><meta>x</meta><b>text</b><c>more</c></a>") == "<a><meta/><b>text"


def test_granule_and_law_ids(spark):
    f = lambda c: F.struct(ids.granule_page(c), ids.granule_ordinal(c), ids.granule_volume(c), ids.package_of_granule(c))
    assert tuple(one(spark, f, "STATUTE-64-PgA283-2")) == ("a283", 2, 64, "STATUTE-64")
    assert tuple(one(spark, f, "STATUTE-64-FrontMatter-1-Pg3"))[:2] == (None, None)
    assert tuple(one(spark, ids.matter_parts, "STATUTE-64-FrontMatter-1-Pg3")) == ("FrontMatter", 1)
    assert one(spark, ids.granule_id, "64", "b3", 2, kinds=["string", "string", "int"]) == "STATUTE-64-PgB3-2"
    assert one(spark, ids.page_label, " B12@fre") == "b12" and one(spark, ids.page_of_citation, "64 Stat. A9") == "a9" and one(spark, ids.page_of_identifier, "/us/stat/64/B3") == "b3"
    assert one(spark, ids.pl_number, "PLAW-118publ5") == "118-5" and one(spark, ids.pl_number, "PLAW-118pvtl3") == "118-pvt3" and one(spark, ids.pl_number, "x") is None
    assert one(spark, ids.law_copy_path, "PLAW-118publ5") == "118/plaws/publ5/PLAW-118publ5_uslm.xml"
    assert one(spark, lambda c: ids.stat_page_label(c, F.lit(3)), "A13") == "A15"
    assert one(spark, ids.page_number, "371") == 371 and one(spark, ids.page_number, "B3") is None and one(spark, ids.integer, "2681-822") is None


def test_natural_page_order(spark):
    names = ["STATUTE-1-Pg10", "STATUTE-1-Pg3-2", "STATUTE-1-Pg3", "STATUTE-1-PgB3", "odd", "STATUTE-1-PgA33"]
    df = spark.createDataFrame([(n,) for n in names], "g string")
    assert [r.g for r in df.orderBy(ids.page_sort_key(F.col("g"))).collect()] == ["STATUTE-1-Pg3", "STATUTE-1-Pg3-2", "STATUTE-1-Pg10", "STATUTE-1-PgA33", "STATUTE-1-PgB3", "odd"]


def test_numerals_dates_headings(spark):
    assert [one(spark, ids.chapter_number, x) for x in ("162", "CXXI.", "abc", "")] == ["162", "121", None, None]
    assert one(spark, ids.us_date, "Mar. 3, 1853") == date(1853, 3, 3) == one(spark, ids.us_date, "March 3, 1853") and one(spark, ids.us_date, "Marsh 3, 1853") is None
    assert [one(spark, ids.ordinal, n, kinds=["int"]) for n in (1, 12, 22, 113, 3)] == ["1st", "12th", "22nd", "113th", "3rd"]
    assert tuple(one(spark, ids.split_heading, "IN GENERAL.-For purposes")) == ("IN GENERAL.", "For purposes")
    assert tuple(one(spark, ids.split_section_heading, "SHORT TITLE. This Act")) == ("SHORT TITLE.", "This Act")
    assert one(spark, ids.num_value, None, "SEC. 12a.") == "12a" and one(spark, ids.num_value, " 1—b ", "") == "1b"
    levels = [("1", "subsection", "paragraph"), ("1", "clause", "subclause"), ("i", "clause", "clause"), ("i", "section", "subsection"), ("A", "paragraph", "subparagraph"), ("b", None, "subsection"), ("b", "paragraph", "subsection")]
    assert all(one(spark, ids.level_of, d, c) == want for d, c, want in levels)
    assert one(spark, ids.slug, "/us/pl/1") == "id_us_pl_1"


def test_ranges_and_profiles(spark):
    assert one(spark, ids.volume_list, "1-3, 7,2") == [1, 2, 3, 7]
    with pytest.raises(Exception, match="bad range"):
        one(spark, ids.volume_list, "3-1")
    assert tuple(one(spark, ids.page_range, "3-7")) == (3, 7) and one(spark, ids.page_range, "7-3") is None
    got = one(spark, lambda c: ids.byte_ranges(c, F.lit(3), 2), 10, kinds=["bigint"])
    assert [tuple(r) for r in got] == [(0, 3), (4, 6), (7, 9)]
    assert one(spark, lambda c: ids.byte_ranges(c, F.lit(3), 2), 0, kinds=["bigint"]) == []
    assert [one(spark, f, "tesseract:psm6") for f in (ids.profile_family, ids.profile_variant, ids.profile_folder)] == ["tesseract", "psm6", "tesseract-psm6"] and one(spark, ids.psm_of_variant, "psm6") == 6
    assert [one(spark, ids.era, v, kinds=["int"]) for v in (1, 65, 137, 138, None)] == ["scanned-pre-1951", "scanned-1951-2002", "digital-2003+", None, None]
    assert ids.boundary_volumes() == [1, 9, 10, 31, 32, 64, 65, 89, 90, 116]
    keep = lambda c: ids.issued_on_or_after(c, F.lit("2020-01-01").cast("date"))
    assert [one(spark, keep, x) for x in ("2020-01-01T00:00", "2019-12-31", None, "soon")] == [True, False, True, True]


def test_law_identifiers_by_year(spark):
    f = lambda d: ids.law_identifiers(F.lit(81), F.lit(5), F.lit(False), d.cast("date"), F.lit("9"), F.lit(True))
    assert [tuple(one(spark, f, d)) for d in ("1899-01-02", "1950-01-02", "1960-01-02")] == [("/us/act/1899-01-02/ch9", None), ("/us/pl/81/5", "/us/act/1950-01-02/ch9"), ("/us/pl/81/5", None)]


def test_costs(spark):
    prices = {"small": (1.0, 2.0, 0.1, 1.25), "large": (10.0, 20.0, 1.0, 12.5)}
    f = lambda m: costs.usage_cost(m, F.lit(1_000_000), F.lit(500_000), F.lit(200_000), F.lit(0), prices, "large", True)
    assert one(spark, f, "small") == pytest.approx(0.8 + 1.0 + 0.02) and one(spark, f, "unknown") == pytest.approx(8 + 10 + 0.2)
    assert one(spark, costs.image_tokens, 750, 2, kinds=["int", "int"]) == 2
    assert one(spark, lambda r: costs.machine_cost(r, F.lit(1800)), 0.8, kinds=["double"]) == 0.4 and one(spark, lambda r: costs.machine_cost(r, F.lit(1800)), None, kinds=["double"]) is None


# ---- fuzzy comparison


def test_distances_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2))
        p, q = [*range(len(b) + 1)], [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            r, s = [i], [0]
            for j, y in enumerate(b, 1):
                r.append(min(p[j] + 1, r[-1] + 1, p[j - 1] + (x != y)))
                s.append(max(q[j], s[-1], q[j - 1] + (x == y)))
            p, q = r, s
        assert (fuzzy.edit_distance(a, b), fuzzy.common_length(a, b)) == (p[-1], q[-1])


def test_best_place_takes_the_earliest_of_equals():
    assert fuzzy.best_place("abc", "xxabcxxabc") == fuzzy.Place(100.0, 2, 5)
    assert fuzzy.best_place("", "abc").score == 0 and fuzzy.partial_ratio("needle in", "edl") == 100
    assert fuzzy.ratio("", "") == 100 and fuzzy.ratio("approved", "arprrovep") > 60


def test_error_rates(spark):
    cer = lambda a, b: one(spark, fuzzy.cer, a, b)
    assert [cer("abcd", "abxd"), cer("", ""), cer("", "x"), cer("a", "abc"), cer(None, "a")] == [0.25, 0, 1, 2, None]
    assert one(spark, fuzzy.wer, "the quick fox", "the fox") == pytest.approx(1 / 3)
    seg = [r.asDict() for r in one(spark, fuzzy.align, "a b c d", "a x c")]
    assert [s["op"] for s in seg] == ["equal", "replace", "equal", "delete"]
    f = lambda a, b: fuzzy.largest_differences(fuzzy.align(a, b), 1, 2)
    assert [tuple(r) for r in one(spark, f, "a bbb c d", "a x c")] == [("replace", "bb", "x")]
    o = lambda a, b: fuzzy.set_overlap(a, b)
    arrays = ["array<string>"] * 2
    assert tuple(one(spark, o, [], [], kinds=arrays))[:3] == (1, 1, 1) and tuple(one(spark, o, ["a", "b"], ["b", "c", "b"], kinds=arrays))[:3] == (0.5, 0.5, 0.5)


# ---- XML

U = f'xmlns="{xml.USLM}" xmlns:dc="{xml.DC}"'
LAW = f"""<pLaw {U}><meta><dc:title>T</dc:title><property>no</property></meta><main><page identifier="/us/stat/64/371">64 STAT. 371</page>
<section identifier="/us/pl/1/2/s1"><num value="1">Sec. 1.</num><heading>Title.</heading><content>First <i>words</i> here.<sidenote><p>Note one.</p></sidenote> Tail.</content></section>
<!-- remark -->after<page identifier="/us/stat/64/372"/><section><num>2</num><content>Second.</content></section></main></pLaw>"""


def test_reading_documents(spark):
    root = xml.parse(LAW)
    assert xml.body_text(root) == "Sec. 1. Title. First words here. Tail. after 2 Second."
    assert xml.sections(root) == [("1", "Title. First words here. Note one. Tail."), ("2", "Second.")]
    assert xml.sidenotes(root) == ["Note one."] and xml.identifiers(root) == (["/us/pl/1/2/s1"], ["/us/stat/64/371", "/us/stat/64/372"])
    counts = xml.structure_counts(root)
    assert (counts["section"], counts["page"], counts["table"]) == (2, 2, 0) and len(counts) == 17
    pages = {p["label"]: p for p in xml.page_texts(root, "370")}
    assert pages["371"]["sidenote"] == "Note one." and pages["372"]["body"] == "2 Second."
    assert one(spark, xml.body_text_col, "<a><b>x</b></a>") == "x" and one(spark, xml.body_text_col, "<a>") is None
    assert one(spark, xml.structure_col, LAW)["section"] == 2


MODS = """<mods xmlns="http://www.loc.gov/mods/v3" ID="id-X"><titleInfo><title>An Act</title></titleInfo><part type="article"><extent unit="pages"><start>{a}</start><end>{b}</end></extent></part>
<identifier type="preferred citation">64 Stat. 3</identifier><location><url displayLabel="PDF rendition">files/x</url></location>
<extension><accessId>STATUTE-64-Pg3</accessId><granuleClass>PUBLICLAW</granuleClass><congress>81</congress><totalPages>3</totalPages><law isPrivate="false"/><bill type="hr" number="7" congress="81"/></extension></mods>"""


def test_mods_records(spark):
    f = lambda c: xml.mods_record(c)
    r = one(spark, f, MODS.format(a="371", b="373"))
    assert (r.granule_id, r.granule_class, r.congress, r.page_start, r.page_end, r.page_range, r.total_pages, r.is_private, tuple(r.bill), r.session, r.pdf_url) == ("STATUTE-64-Pg3", "PUBLICLAW", 81, 371, 373, "371-373", 3, False, ("hr", "7", "81"), None, "files/x")
    r = one(spark, f, MODS.format(a="B3", b="B32"))
    assert (r.page_start_label, r.page_start) == ("B3", None)
    assert one(spark, f, "<mods>") is None


# ---- ledger


def test_decisions(spark):
    def run(expected, hub, local, upload=True):
        df = spark.createDataFrame([("p", i, f"f{i}", e, h, x) for i, (e, h, x) in enumerate(zip(expected, hub, local, strict=True))], "package_id string, pos int, hub_path string, expected bigint, hub bigint, local bigint")
        return tuple(catalog.decide(df, upload).first())[1:]

    assert run([10, 20], [10, 20], [None, None]) == ("skip", "on Hub with matching sizes")
    assert run([10, 20], [None, 20], [10, None]) == ("upload-only", "complete locally, missing from Hub")
    assert run([10, 20], [9, 20], [10, None]) == ("upload-only", "Hub size mismatch for f0; complete locally")
    assert run([10, 20], [9, None], [3, None]) == ("download", "Hub size mismatch for f0; missing or incomplete: f0, f1")
    assert run([None, None], [1, 1], [1, 1]) == ("skip", "no files are listed for this package")
    assert run([10, 20], [10, 20], [10, 5], False) == ("download", "missing or incomplete locally: f1") and run([10], [None], [10], False)[0] == "skip"


def test_reconciliation_can_report_a_file_twice(spark):
    df = spark.createDataFrame([("p", "a", 10, 9, 8), ("p", "b", 10, None, 10), ("p", "c", 10, None, None), ("p", "d", 10, 10, 10), ("p", "e", None, 1, 1)], "package_id string, path string, expected bigint, hub bigint, local bigint")
    got = sorted((r.path, r.category) for r in catalog.reconcile(df).collect())
    assert got == [("a", "size-mismatch"), ("a", "size-mismatch"), ("b", "local-only"), ("c", "missing")]
    counts = {r.category: r.n for r in catalog.category_counts(catalog.reconcile(df)).collect()}
    assert counts == {"local-only": 1, "hub-only": 0, "size-mismatch": 2, "missing": 1}


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    s = spark.createDataFrame([(2, None, "z"), (3, "c", "q")], "k int, v string, w string")
    run = lambda p: sorted(map(tuple, catalog.upsert(t, s, ["k"], p).collect()))
    assert run("overwrite") == [(1, "a", "x"), (2, None, "z"), (3, "c", "q")]
    assert run("coalesce") == [(1, "a", "x"), (2, "b", "z"), (3, "c", "q")]
    assert run({"v": "keep", "w": "overwrite"}) == [(1, "a", "x"), (2, "b", "z"), (3, "c", "q")]
    assert catalog.apply_migrations(["002_b.sql", "001_a.sql"], ["001_a.sql"]) == ["002_b.sql"]
    for bad in (["001_a.sql", "003_c.sql"], ["1_a.sql"], ["001_a.sql", "001_b.sql"]):
        with pytest.raises(ValueError):
            catalog.apply_migrations(bad, [])


def test_events_set_and_clear(spark):
    p = spark.createDataFrame([("a", "old", "path"), ("b", "old", "path")], "id string, status string, local string")
    e = spark.createDataFrame([("a", 1, "new", None, None), ("a", 2, None, None, True), ("b", 1, None, None, True), ("b", 2, "done", "again", None)], "id string, seq int, status string, local string, clear boolean")
    got = catalog.apply_file_events(p, e, "id", "seq", ["status", "local"], {"local": "clear"})
    assert sorted(map(tuple, got.collect())) == [("a", "new", None), ("b", "done", "again")]


def test_summaries(spark):
    import json

    s = {"packageId": "PLAW-118publ5", "congress": "118", "pages": "2", "title": "T", "dateIssued": "2023-05-01", "references": [{"collectionCode": "STATUTE", "contents": [{"title": "100", "pages": ["1", "2", "3"]}, {"title": "137", "pages": ["12", "2681-822", "10"]}, {"title": "5", "pages": []}]}]}
    df = spark.createDataFrame([(json.dumps(s),)], "p string").select(catalog.parse_summary(F.col("p")).alias("s"))
    row = df.select(*catalog.package_row(F.col("s"))).first()
    assert (row.collection, row.volume, row.congress, row.pages, row.scanned) == ("PLAW", 5, 118, 2, None)
    assert tuple(df.select(catalog.law_pages(F.col("s")).alias("x")).first().x) == (137, 10, 12)
    x = '<citableAs>137 Stat. 10</citableAs><page identifier="/us/stat/137/12"/><page identifier="/us/stat/9/99"/>'
    assert tuple(one(spark, catalog.law_pages_of_xml, x)) == (137, 10, 12)
    law = df.select(*catalog.statute_row(F.col("s"), F.lit(x))).first()
    assert (law.pl_number, law.start_page, law.end_page) == ("118-5", 10, 12)


def test_table_digest_ignores_order(spark):
    a = spark.createDataFrame([(1, None), (2, "b")], "x int, y string")
    assert catalog.rows_digest(a).first() == catalog.rows_digest(a.orderBy(F.desc("x"))).first()
    assert catalog.rows_digest(a).first() != catalog.rows_digest(a.where("x = 1")).first()


# ---- sampling and reports


def test_page_estimates(spark):
    g = [f"STATUTE-1-Pg{x}" for x in ("3", "3-2", "10", "60", "B3", "B33")] + ["STATUTE-1-FrontMatter-1-Pg1"]
    got = sampling.estimate_pages(spark.createDataFrame([(x, 1) for x in g], "granule_id string, volume int"))
    assert [r.est_pages for r in sorted(got.collect(), key=lambda r: g.index(r.granule_id))] == [1, 7, 50, 1, 30, 1]


def test_samples_are_seeded_and_independent(spark):
    df = spark.range(200).select(F.concat(F.lit("g"), "id").alias("g"), (F.col("id") % 3).alias("s"), F.lit(5).alias("n"))
    a = {r.g for r in sampling.stratified_sample(df, ["s"], "g", 4, 1).collect()}
    assert len(a) == 12 and a == {r.g for r in sampling.stratified_sample(df.repartition(7), ["s"], "g", 4, 1).collect()} != {r.g for r in sampling.stratified_sample(df, ["s"], "g", 4, 2).collect()}
    pages = lambda d: {(r.g, r.pdf_page) for r in sampling.choose_pages(d, "g", "n", 1, 2).collect()}
    assert {x for x in pages(df) if x[0] == "g7"} == pages(df.where("g = 'g7'"))


def test_budget(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 6 else 3.0) for i in range(10)], "i int, cost double")
    stops = [r.i for r in sampling.budget_stop(df, ["i"], "cost", 10, 12.0).collect() if r.stops]
    assert stops[0] == 6


def test_banded_distances_against_a_plain_table():
    def plain(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
        return d[-1]

    rng = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2))
        want = plain(a, b)
        assert fuzzy.edit_distance(a, b) == want == fuzzy.edit_distance(list(a), list(b)), (a, b)
        for k in (1, 2, 5, 20):
            got = fuzzy._banded_distance(a, b, k) if a and b else want
            assert got == want if want <= k else got > k, (a, b, k)
    for edits in (10, 300, 5000):  # several bands and stretches
        a = "".join(rng.choice("abcdefgh") for _ in range(6000))
        b = list(a)
        for _ in range(edits):
            b[rng.randrange(len(b))] = rng.choice(["", "x", "ab", "z"])
        b = "".join(b)
        assert fuzzy.edit_distance(a, b) == fuzzy._banded_distance(a, b, 20_000)


def test_medians(spark):
    rng = random.Random(3)
    rows_ = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.choice([None, 0.5, 0.25, rng.random() * 3, -rng.random()])) for _ in range(400)] + [("c", None), ("d", 7.0), ("e", 1.0), ("e", 2.0), ("e", 2.0), ("e", 100.0)]
    df = spark.createDataFrame(rows_, "g string, v double")
    got = {r.g: r.median for r in report.medians(df, ["g"], "v").collect()}
    want = {g: statistics.median(vs) for g in {g for g, _ in rows_} if (vs := [v for h, v in rows_ if h == g and v is not None])}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)
    assert report.medians(df.limit(0), ["g"], "v").count() == 0


def test_scores_tell_the_total_from_null_groups(spark):
    df = spark.createDataFrame([("a", 0.1, None), ("a", None, 0.5), (None, 0.3, None), ("b", 0.2, 0.1)], "period string, cer double, sidenote_cer double")
    got = {r.period: (r.pages, r.scored, r.missing, r.sidenote_pages) for r in report.summarize_scores(df).collect()}
    assert got == {"a": (2, 1, 1, 1), None: (1, 1, 0, 0), "b": (1, 1, 0, 1), "all": (4, 3, 1, 2)}


def test_paragraphs_continue_the_latest_item_of_their_role(spark):
    lines = [(1, 1, "body", "a", True), (1, 2, "sidenote", "n", True), (1, 3, "body", "b", False), (1, 4, "body", "c", True), (1, 5, "footnote", "f", False), (1, 6, "body", " ", True)]
    got = report.merge_paragraphs(spark.createDataFrame(lines, "page int, pos int, role string, text string, starts_paragraph boolean"), ["page"]).orderBy("first_pos").collect()
    assert [(r.role, r.text) for r in got] == [("body", "a\nb"), ("sidenote", "n"), ("body", "c"), ("footnote", "f")]


def test_page_routing_and_rendering(spark):
    pages = spark.createDataFrame([("g", 1, 64, "3"), ("g", 2, 64, "4"), ("h", 1, 64, None)], "granule_id string, pdf_page int, volume int, stat_page string")
    texts = spark.createDataFrame([("g", 1, "b", "s")], "granule_id string, pdf_page int, body string, sidenote string")
    assert sorted(r.source for r in report.candidate_texts(pages, texts).collect()) == ["no output", "page missing", "text"]
    v = spark.createDataFrame([(64, "3", "vb", "")], "volume int, label string, body string, sidenote string")
    s = spark.createDataFrame([("g", "4", "sb", "")], "granule_id string, label string, body string, sidenote string")
    assert sorted(r.source for r in report.first_available(pages, v, s).collect()) == ["no page label", "slice", "volume"]
    df = spark.createDataFrame([("a", 0.12345, None)], "n string, x double, y string")
    assert report.markdown_table(df, ["n"], {"x": 3}).splitlines()[-1] == "| a | 0.123 | - |"
    assert report.replace_section("# R\n\n## Notes\n\nold\n", "## Notes", "new") == "# R\n\n## Notes\n\nnew\n"


# ---- comparison of documents


def test_a_document_equals_itself(spark):
    df = spark.createDataFrame([("x", LAW, LAW), ("y", LAW, LAW.replace("Second", "Sccond")), ("z", LAW, "<bad")], "id string, a string, b string")
    x, y, z = metrics.compare(df, "a", "b").orderBy("id").collect()
    assert (x.cer, x.wer, x.equal_ratio > 0.8, x.section_match.recall, x.identifier_overlap.f1, x.sidenote_recall.recall, list(x.diffs)) == (0, 0, True, 1, 1, 1, [])
    assert 0 < y.cer < 0.1 and [d.op for d in y.diffs] == ["replace"] and z.cer is None


def test_clipping_finds_a_law_on_a_shared_page():
    ref = "Be it enacted that the sum of ten dollars is paid to Jane Roe for her horse. Approved, March 3, 1853."
    page = "Tail of another law. Approved, March 2, 1853. " + ref + " An Act to pay someone else again. Approved, March 3, 1853."
    clip = metrics.clip_to_reference(ref, page)
    assert clip.text == ref and clip.head_found and clip.tail_found
    assert metrics.clip_to_reference("", "x").text == "x" and not metrics.clip_to_reference("completely different words", "zzz qqq").head_found


def test_sections_are_matched_once():
    assert metrics.match_sections([("1", "abcdef"), ("1", "abcdef"), ("2", "")], [("1", "abcdeg"), ("2", "xyz")])["matched"] == 2
    assert metrics.match_sections([], [])["precision"] == 1.0


def test_adjudication(spark):
    line = lambda t, r="body": {"role": r, "text": t}
    a, b = [line("one"), line("two"), line("three")], [line("One"), line("2"), line("three"), line("four")]
    runs = metrics.differing_runs(a, b)
    assert [(r["run"], r["op"]) for r in runs] == [(1, "replace"), (2, "insert")]
    kind = "array<struct<role:string,text:string>>"
    pages = [(1, a, b, [(1, [("body", "too")], "image")]), (2, a, b, None), (3, a, a, [(1, [], "x")]), (4, None, b, None), (5, [], b, [(1, [("body", "n")], "old"), (1, [("body", "m")], "new")]), (None, a, b[:1], [(2, [], "gone")])]
    df = spark.createDataFrame(pages, f"k int, a {kind}, b {kind}, r array<struct<run:int,lines:{kind},reason:string>>")
    got = df.withColumn("runs", metrics.transcription_runs(F.col("a"), F.col("b"))).withColumn("s", metrics.agreed_lines(F.col("a"), F.col("b"))).withColumn("t", metrics.runs_text(F.col("runs")))
    one = got.where("k = 1").first()
    assert [x.text for x in one.s] == ["one", "three"] and one.t.startswith("Run 1:\n    A2 [body] two\n    B2 [body] 2")
    m = {r.k: r for r in metrics.merge_transcriptions(got, ["k"], resolutions="r").collect()}
    assert len(m) == len(pages)
    texts = {k: None if r.lines is None else [x.text for x in r.lines] for k, r in m.items()}
    assert texts == {1: ["one", "too", "three"], 2: ["one", "two", "three"], 3: ["one", "two", "three"], 4: None, 5: ["m"], None: ["one", "two", "three"]}
    assert {k: r.unresolved for k, r in m.items()} == {1: 1, 2: 2, 3: 0, 4: 1, 5: 0, None: 1}
    assert [tuple(x) for x in m[1].disagreements] == [(1, "two", "2", "too", "image"), (2, "", "four", "", metrics.UNRESOLVED)]


# ---- splitting

VOLUME = f"""<statutesAtLarge {U}><component role="statutesPart"><preface><page identifier="/us/stat/64/1"/><p>front</p></preface>
<publicLaws><component><pLaw><meta><citableAs>Public Law 1</citableAs><citableAs>64 Stat. 3</citableAs></meta><main><p>a</p><page identifier="/us/stat/64/4"/></main></pLaw></component>
<component><pLaw><meta/><main><p>b</p></main></pLaw></component><component><pLaw><main><page identifier="/us/stat/64/5"/><p>c</p><pLaw><p>nested</p></pLaw></main></pLaw></component></publicLaws></component>
<component role="statutesPart"><collection role="treaties"><presidentialDoc><meta/><main><page identifier="/us/stat/64/B3@eng"/><p>t</p></main></presidentialDoc></collection><backMatter><p>back</p></backMatter></component></statutesAtLarge>"""


def test_splitting_a_volume(spark):
    listing = spark.createDataFrame([(64, "STATUTE-64-Pg3", "PUBLICLAW"), (64, "STATUTE-64-Pg4", "PUBLICLAW"), (64, "STATUTE-64-Pg5", "PUBLICLAW"), (64, "STATUTE-64-PgB3", "TREATY"), (64, "STATUTE-64-PgB9", "TREATY"), (64, "STATUTE-64-FrontMatter-1-Pg1", "FRONTMATTER")], "volume int, granule_id string, granule_class string")
    cut = split.slices(split.volume_events(spark.createDataFrame([(64, VOLUME), (65, "<bad")], "volume int, xml string")), listing).orderBy("pos").collect()
    assert [(r.granule_id, r.start_page, r.part, r.matched) for r in cut] == [
        ("STATUTE-64-FrontMatter-1-Pg1", "1", 1, True), ("STATUTE-64-Pg3", "3", 1, True), ("STATUTE-64-Pg4", "4", 1, True), ("STATUTE-64-Pg5", "5", 1, True), ("STATUTE-64-PgB3", "b3", 2, True), ("STATUTE-64-BackMatter-2-PgB3", "b3", 2, False),
    ]
    assert [xml.name(ET.fromstring(r.xml)) for r in cut] == ["preface", "pLaw", "pLaw", "pLaw", "presidentialDoc", "backMatter"]
    df = spark.createDataFrame([tuple(r) for r in cut], "volume int, granule_id string, doc_type string, granule_class string, start_page string, ordinal int, part int, citable_as string, title string, matched boolean, class_differs boolean, pos int, xml string")
    assert sorted((r.granule_id, r.reason) for r in split.unpaired(df, listing).collect()) == [("STATUTE-64-BackMatter-2-PgB3", "slice without a listed granule"), ("STATUTE-64-PgB9", "no slice")]
    assert {r.group: r.aligned for r in split.alignment(df, listing).collect()} == {"PUBLICLAW": True, "TREATY": False}


# ---- layout and building


def _doc(*texts, kind="body", label="text"):
    return [{"page": 1, "rank": i, "kind": kind, "label": label, "text": t, "t": 700.0 - i, "cells": None} for i, t in enumerate(texts)]


def test_layout_items_follow_the_body_tree(spark):
    import json

    item = lambda i, t, l, top, **x: {"self_ref": f"#/texts/{i}", "label": "text", "text": t, "prov": [{"page_no": 1, "bbox": {"l": l, "t": top, "r": l + 300, "b": top - 10}}], **x}
    doc = {"texts": [item(0, "second", 100, 600), item(1, "first", 100, 650), item(2, "hidden", 1, 1, content_layer="furniture"), item(3, "72 STAT. 9", 100, 770), {**item(4, "note", 450, 500), "prov": {"page_no": 1, "bbox": {"l": "450", "t": 490, "r": 500, "b": 500}}}],
           "body": {"children": [{"$ref": "#/texts/1"}, {"$ref": "#/texts/0"}, {"$ref": "#/texts/2"}, {"$ref": "#/texts/3"}, {"$ref": "#/texts/4"}]}, "pages": {"1": {"size": {"width": 612, "height": 792}}}}
    df = spark.createDataFrame([("g", json.dumps(doc)), ("h", "{")], "granule_id string, payload string")
    got = layout.classify_items(layout.layout_items(df, "granule_id", "payload")).orderBy("rank").collect()
    assert [(r.text, r.kind) for r in got] == [("72 STAT. 9", "header"), ("first", "body"), ("second", "body"), ("note", "sidenote")] and got[3].t == 500
    assert layout.page_texts(spark.createDataFrame([tuple(r) for r in got], "granule_id string, pos int, page int, label string, text string, l double, t double, r double, b double, cells array<array<string>>, width double, height double, kind string, rank int")).first().body == "first second"


def _classified(spark, *docs):
    """docs: granule, items"""
    flat = [(g, x["page"], x["rank"], x["kind"], x["label"], x["text"], x["t"], x["cells"]) for g, items in docs for x in items]
    return spark.createDataFrame(flat, "granule_id string, page int, rank int, kind string, label string, text string, t double, cells array<array<string>>")


def _identities(spark, *rows):
    kind = "doc_type string, congress int, law_number int, is_private boolean, volume int, start_page int, granule_id string, package_id string, date_issued string, title string"
    full = [(g, ("pLaw", w.get("congress"), w.get("law_number"), False, w.get("volume"), w.get("start_page"), g, w.get("package_id"), None, w.get("title"))) for g, w in rows]
    return spark.createDataFrame(full, f"granule_id string, identity struct<{', '.join(x.replace(' ', ':') for x in kind.split(', '))}>")


def test_signs_of_lines(spark):
    want = {
        "Arprrovep, March 3, 1853.": (False, True, False), "He came, March 3, 1853.": (False, False, False), "Agreed  to March 3, 1853": (False, True, False), "Arprrovep, Marsh 3, 1853.": (False, False, False),
        "Cuar. CXXII.- An Act for": (True, False, True), "XXII. - An Act for": (True, False, True), "Zzzzz. CXXII.- An Act for": (False, False, False), "CHAPTER 1-GENERAL PROVISIONS": (False, False, False), "[CHAPTER 486]": (True, False, True), "CHAP. 5.-An Act to": (True, False, True),
        "Whereas it is": (False, False, True), "SEC. 2. Whoever": (False, False, True), "AN ACT": (True, False, True), "Public Law 81-7": (True, False, True), "": (False, False, False), None: (False, False, False),
    }
    got = markers.line_signs(spark.createDataFrame([(t,) for t in want], "text string")).collect()
    assert {r.text: (r.starts, r.ends, r.signals) for r in got} == want


def test_start_and_end_of_a_document_on_shared_pages(spark):
    cases = {
        "STATUTE-10-Pg3-2": ({}, ["CHAP. 1.-An Act one.", "Be it enacted a.", "Approved, March 2, 1853.", "CHAP. 2.-An Act two.", "Be it enacted b.", "SEC. 2. Whoever.", "Approved, March 3, 1853.", "CHAP. 3.-An Act three."], "marker", 3, 7),
        "STATUTE-10-Pg4-5": ({}, ["x", "CHAP. 1.-An Act one.", "Be it enacted a."], "marker", 1, 3),
        "STATUTE-10-Pg5": ({"law_number": 7}, ["x", "Public Law 81-7", "y"], "law-number", 1, 3),
        "STATUTE-10-Pg6": ({"title": "An Act for the relief of Jane Roe and others"}, ["some tail", "AN ACT", "An Act for the relief of Jane Roe and others", "Whereas a", "CHAP. 9.-An Act"], "title", 1, 4),
        "STATUTE-10-Pg7": ({}, ["words", "Approved, March 3, 1853.", "then text"], "end-marker", 2, 3),
        "STATUTE-10-Pg8": ({}, ["words", "more words"], "none", 0, 2),
    }
    docs = _classified(spark, *[(g, _doc(*texts)) for g, (_, texts, *_) in cases.items()], ("PLAW-1publ1", _doc("CHAP. 1.-An Act one.", "Be it enacted a.", "Approved, March 2, 1853.", "more")), ("other", _doc("a")), (None, _doc("b")))
    who = _identities(spark, *[(g, {"package_id": "STATUTE-10", **w}) for g, (w, *_) in cases.items()], ("PLAW-1publ1", {"package_id": "PLAW-1publ1"}))
    signed = build.with_roles(docs, who)
    for g, (_, texts, rule, start, stop) in cases.items():
        found = sorted((r["rank"], r.role, r._start_rule_) for r in signed.where(F.col("granule_id") == g).collect())
        assert [x[1] for x in found] == ["before"] * start + ["line"] * (stop - start) + ["after"] * (len(texts) - stop) and {x[2] for x in found} == {rule}, g
    built = {r.granule_id: r for r in build.build_documents(docs, who).collect()}
    assert len(built) == len(cases) + 3 and built["STATUTE-10-Pg3-2"].trailing_items == 1 and built["STATUTE-10-Pg3-2"].preface_items == 3 and built["PLAW-1publ1"].trailing_items == 0
    told = lambda g: " | ".join(built[g].warnings)
    assert "document ends on page 1" in told("STATUTE-10-Pg3-2") and "1 items behind" in told("STATUTE-10-Pg3-2") and "document 5 on its first page, but 1 marker" in told("STATUTE-10-Pg4-5")
    assert "next document starts on page 1" in told("STATUTE-10-Pg6") and "not recognized on page 1 (rule none)" in told("STATUTE-10-Pg8")


def test_levels_ids_and_sidenotes(spark):
    items = [*_doc("SECTION 1. SHORT TITLE. This.", "(a) IN GENERAL.-For", "(1) one", "(A) x", "(i) y", "(b) two", "continued", "SEC. 1. Quoted."), *_doc("a side note", kind="sidenote"), *_doc("118 STAT. 3", kind="header"), {**_doc("t")[0], "cells": [["a", "b"]], "rank": 99}]
    out = build.build_documents(_classified(spark, ("g", items)), _identities(spark, ("g", {"congress": 118, "law_number": 5, "volume": 137, "start_page": 10}))).first()
    root = ET.fromstring(out["xml"])
    idents = [e.get("identifier") for e in root.iter() if e.get("identifier")]
    assert "/us/pl/118/5/s1/a/1/A/i" in idents and "/us/pl/118/5/s1/a/1/A/b" in idents and "/us/stat/137/10" in idents
    every = [e.get("id") for e in root.iter() if e.get("id")]
    assert len(every) == len(set(every)) and out["kept_ratio"] >= 0.8
    assert [xml.name(e) for e in xml.child(root, "main")][:2] == ["sidenote", "section"] and root.find(".//{http://www.w3.org/1999/xhtml}td") is not None


def test_documents_of_a_frame(spark):
    df = spark.createDataFrame([("g", 1, 1, "body", "text", "SEC. 1. Text.", 1.0, None), ("h", 1, 1, "body", "text", "words", 1.0, None)], "granule_id string, page int, rank int, kind string, label string, text string, t double, cells array<array<string>>")
    who = spark.createDataFrame([("g", 118, 5)], "granule_id string, congress int, law_number int").select("granule_id", catalog.identity_of_granule({"granule_class": F.lit("PUBLICLAW"), "number": F.col("law_number"), "congress": F.col("congress"), "package_id": F.lit("PLAW-118publ5"), "page_start": F.lit(1), "granule_id": F.lit(None).cast("string"), "date_issued": F.lit(None), "title": F.lit("T")}).alias("identity"))
    g, h = build.build_documents(df, who).orderBy("granule_id").collect()
    assert "/us/pl/118/5/s1" in g.xml and "<p>words</p>" in h.xml


# ---- substitution


def test_hybrid_keeps_structure_and_every_candidate_word(spark):
    body = "<section><num value='{n}'>Sec. {n}.</num><content>{t}</content></section>"
    doc = lambda *ts: f"<pLaw {U}><meta><docNumber>5</docNumber><congress>118</congress></meta><main>{''.join(body.format(n=i + 1, t=t) for i, t in enumerate(ts))}<action>Approved May 1.</action></main></pLaw>"
    pub = doc("The quick brown fox <i>jumps</i> over the dog.", "A second <page identifier='/us/stat/137/B2'/> sentence of this act.")
    cand = doc("Tbe quick brown fox jumps ovcr the dog.", "A sccond sentence of tbis act.")
    out = hybrid.build_hybrid(pub, cand, {"primary": "/us/pl/118/5", "volume": 137})
    words = " ".join(ET.fromstring(out["xml"]).itertext())
    assert all(w in words for w in ("Tbe", "ovcr", "sccond", "tbis")) and "quick" in words
    assert out["identifier"] == "/us/pl/118/5" and out["sections_matched"] == 2 and 'identifier="/us/stat/137/b2"' in out["xml"] and "/us/pl/118/5/s2" in out["xml"]
    assert hybrid.build_hybrid(None, cand, {})["xml"] == cand and hybrid.build_hybrid(pub, "<bad", {}) is None
    who = F.struct(F.lit(118).alias("congress"), F.lit(5).alias("law_number"), F.lit(False).alias("is_private"), F.lit(137).alias("volume"), F.lit(None).cast("string").alias("date_issued"), F.lit(None).cast("string").alias("chapter"))
    df = spark.createDataFrame([("a", pub, cand), ("b", None, cand), ("c", pub, "<bad")], "granule_id string, publisher_xml string, candidate_xml string").withColumn("identity", who)
    a, b, c = hybrid.hybrids(df, "granule_id").orderBy("granule_id").collect()
    assert a.identifier == "/us/pl/118/5" and b.xml == cand and c.xml is None


def test_section_chain_prefers_the_similar_one():
    a, b = [("1", 0)], [("1", 0), ("1", 3)]
    assert hybrid.section_chain(a, b, ["real", "text", "here"], ["toc", "line", "x", "real", "text", "here"]) == [(0, 3)]
    assert hybrid.carry([0, 2], ["a", "b", "c"], ["a", "x", "b", "c"]) == [0, 3]


