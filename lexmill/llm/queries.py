"""Queries of the text problems, over their whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.langid import detect_languages, language_issues, train
from lexmill.llm.ocr import content_lines, findings, in_order, learn, paragraphs_of, repair
from lexmill.llm.packing import pack_documents, packing_report
from lexmill.llm.repeats import blocks, occurrences, repeated_items, source_lines, strip_items
from lexmill.llm.tokenize import encode_texts
from lexmill.session import entity_key, latest, table


def _content() -> Column:
    return F.coalesce("text", "orig")


def _page_lines(spark: SparkSession, d: str, notices: DataFrame | None = None) -> DataFrame:
    return content_lines(table(spark, d, "page_items"), F.trim("granule_id"), _content(), notices)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    ordered = in_order(_page_lines(spark, d))
    return findings(repair(ordered, learn(ordered)))


def p4_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs by granule; the lines repeated within a package (problem 6) are its notices."""
    ordered = in_order(_page_lines(spark, d, repeated_items(_repeated(spark, d))))
    return paragraphs_of(repair(ordered, learn(ordered)))


def _repeated(spark: SparkSession, d: str) -> DataFrame:
    """The places of page_items where blocks repeated within a package begin."""
    granules = latest(table(spark, d, "granules"), {"doc": entity_key(F.col("granule_id"))}, ["updated_at"], ["package_id"])
    source_of = granules.select("doc", entity_key(F.col("package_id")).alias("source"))
    return occurrences(source_lines(table(spark, d, "page_items"), entity_key(F.col("granule_id")), source_of, _content(), ["page_no", "item_no"], page=F.col("page_no")))


def p6_blocks(spark: SparkSession, d: str) -> DataFrame:
    return blocks(_repeated(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_items(_repeated(spark, d)).select(F.col("item").alias("item_id"))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return strip_items(table(spark, d, "page_items"), repeated_items(_repeated(spark, d)), entity_key(F.col("granule_id")), _content(), ["page_no", "item_no"])


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"), "doc_id", "text")


def _capacities(spark: SparkSession, d: str) -> dict[int, int]:
    """The capacities in use: a fixed table of a few rows."""
    return {r.budget_id: r.capacity for r in table(spark, d, "token_budgets").select("budget_id", "capacity").collect()}


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"), "doc_id", "text", _capacities(spark, d))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(p8_pack(spark, d), _capacities(spark, d))


def p9_langs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return detect_languages(docs, "doc_id", "text", train(docs, "doc_id", "text", "lang"), "lang")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language_issues(p9_langs(spark, d), "doc_id").select("doc_id", "para_no", "lang")


P6_SQL = """
with g as (select lower(trim(regexp_replace(granule_id, '@.*$', ''))) doc, nullif(lower(trim(regexp_replace(package_id, '@.*$', ''))), '') source from granules
  where nullif(trim(granule_id), '') is not null qualify row_number() over (partition by doc order by updated_at desc) = 1),
l as (select i.item_id, g.doc, g.source, regexp_replace(lower(coalesce(i.text, i.orig)), '[^\\p{L}\\p{N}]+', '', 'g') line
  from page_items i join g on lower(trim(regexp_replace(i.granule_id, '@.*$', ''))) = g.doc where g.source is not null),
n as (select * from l where line <> ''),
t as (select source, count(distinct doc) docs from n group by source),
f as (select source, line, count(distinct doc) docs from n group by source, line)
select distinct item_id from n join f using (source, line) join t using (source) where f.docs >= 8 and f.docs >= 0.1 * t.docs
"""

_P6_DOC = "lower(trim(regexp_replace({c}, '@.*$', '')))"
_P6_LINES = f"""
g as (select {_P6_DOC.format(c='granule_id')} doc, nullif({_P6_DOC.format(c='package_id')}, '') source from granules
  where nullif(trim(granule_id), '') is not null qualify row_number() over (partition by doc order by updated_at desc) = 1),
l as (select distinct i.item_id, i.page_no, i.item_no, g.doc, g.source, regexp_replace(lower(coalesce(i.text, i.orig)), '[^\\p{{L}}\\p{{N}}]+', '', 'g') line
  from page_items i join g on {_P6_DOC.format(c='i.granule_id')} = g.doc where g.source is not null),
n as (select *, row_number() over (partition by doc order by page_no, item_no, item_id, line) spot from l where line <> ''),
t as (select source, count(distinct doc) source_docs from n group by source),
f as (select source, line from n join t using (source) group by source, line, source_docs having count(distinct doc) >= 8 and count(distinct doc) >= 0.1 * source_docs)
"""

P6_BLOCKS_SQL = f"""
with recursive {_P6_LINES},
h as (select n.*, t.source_docs from n join f using (source, line) join t using (source)),
b as (
  select source, doc, spot, item_id, source_docs, 1 lines, line block from h
  union all
  select source, doc, spot, item_id, source_docs, lines, block from (
    select b.source, b.doc, b.spot, b.item_id, b.source_docs, b.lines + 1 lines, b.block || chr(10) || h.line block from b join h on b.doc = h.doc and h.spot = b.spot + b.lines)
  qualify count(distinct doc) over (partition by source, block) >= greatest(8, 0.1 * source_docs)),
e as (select source, doc, spot, item_id, source_docs, max(lines) lines, arg_max(block, lines) block from b group by all),
m as (select e.* from e left join e p on e.doc = p.doc and p.spot = e.spot - 1 where p.lines is null or p.lines <= e.lines)
select source, lines, min(item_id) first_item, count(*) places, count(distinct doc) docs, any_value(source_docs) source_docs from m group by source, lines, block
"""

P6_CLEAN_SQL = f"""
with {_P6_LINES},
r as (select distinct item_id from n join f using (source, line)),
i as (select nullif({_P6_DOC.format(c='granule_id')}, '') doc, page_no, item_no, item_id, coalesce(text, orig) line, item_id in (select item_id from r) out from page_items)
select doc, coalesce(string_agg(line, chr(10) order by page_no, item_no, item_id) filter (not out), '') as text, count(*) filter (out) removed from i where doc is not null group by doc
"""

QUERIES = {"p4_found": p4_found, "p4_paragraphs": p4_paragraphs, "p6_found": p6_found, "p6_blocks": p6_blocks, "p6_clean": p6_clean, "p7_ids": p7_ids, "p8_pack": p8_pack, "p8_report": p8_report, "p9_found": p9_found, "p9_langs": p9_langs}
SQL: dict[str, str] = {"p6_found": P6_SQL, "p6_blocks": P6_BLOCKS_SQL, "p6_clean": P6_CLEAN_SQL}
