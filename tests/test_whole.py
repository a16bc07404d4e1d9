"""Queries over small tables of their own: nothing is left out."""

from lexmill.plans import reference


def write(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_unit_and_profile_is_pivoted(spark, tmp_path):
    results = [("a", "digital", "failed"), ("a", "digital", "success"), ("a", "vlm:large", "failed"), ("b", "hybrid:scanned", "skipped"), ("c", "digital@clean", "success"), ("c", "new", "failed"), ("d", None, None)]
    d = write(spark.createDataFrame(results, "unit_id string, profile string, status string"), tmp_path, "unit_results")
    got = {r.unit_id: {k: v for k, v in r.asDict().items() if v is not None and k != "unit_id"} for r in reference.pivoted_status_all(spark, d).collect()}
    assert got == {"a": {"digital": "success", "vlm:large": "failed"}, "b": {"hybrid:scanned": "skipped"}, "c": {"rest": "digital@clean=success; new=failed"}, "d": {"rest": "?=?"}}


def test_lines_of_one_reading_count_in_documents(spark, tmp_path):
    """Granule a: equal lines, one of text only, one of orig only; b has only text, c only orig."""
    lines = [(1, "a", 1, "Be it enacted", "Be it enacted"), (2, "a", 2, "onlytext here", None), (3, "a", 3, None, "onlyorig there"), (4, "a", 4, "to the end", "to the end"), (5, "b", 1, "some text", None), (6, "c", 1, None, "some orig")]
    rows = [(i, g, None, 1, n, "body", t, o, 100.0, 600.0 - 20 * n, 500.0, 610.0 - 20 * n) for i, g, n, t, o in lines]
    d = write(spark.createDataFrame(rows, "item_id bigint, granule_id string, volume int, page_no int, item_no int, label string, text string, orig string, l double, t double, r double, b double"), tmp_path, "page_items")
    write(spark.read.parquet("/root/testdata/sf0.001/granules.parquet").limit(0), tmp_path, "granules")
    a, b, c = reference.compared_documents(spark, d).orderBy("granule_id").collect()
    assert a.diffs >= 1 and 0 < a.wer < 1 and a.equal_ratio < 1
    assert [(x.granule_id, x.cer, x.wer, x.equal_ratio, x.diffs) for x in (b, c)] == [("b", 1, 1, 0, 1), ("c", 1, 1, 0, 1)]
    xmls = {r.granule_id: r.xml for r in reference.hybrid_documents(spark, d).collect()}
    assert all(w in xmls["a"] for w in ("enacted", "onlytext", "onlyorig", "end")) and "some text" in xmls["b"] and "orig" in xmls["c"]


def test_word_errors_tell_other_than_ascii_characters_apart(spark, tmp_path):
    lines = [(1, None, "señor état", "señor étât"), (2, None, "señor", "señor"), (3, None, "a b", "a c"), (4, None, None, "x")]
    d = write(spark.createDataFrame(lines, "item_id bigint, volume int, text string, orig string"), tmp_path, "page_items")
    assert sorted((r.item_id, r.wer) for r in reference.word_errors(spark, d).collect()) == [(1, 0.5), (2, 0), (3, 0.5)]
