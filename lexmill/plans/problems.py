"""Queries of the general training-data problems, over their whole tables, with DuckDB equivalents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.diff import Field, diff_copies, diff_fields
from lexmill.operators.incremental import IntervalLedger, number_arrivals, pending, ranges_of, to_intervals
from lexmill.operators.references import hot_keys, orphan_references, orphan_report, validity_intervals
from lexmill.operators.shred import Table, shred_tables
from lexmill.session import BLANKS, blank_trim, cut, digest_key, ensure_checkpoint_dir, entity_key, latest, table

# ---- 1: references to records that do not exist


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    granules, packages, slices = (table(spark, d, t) for t in ("granules", "packages", "slices"))
    current = latest(granules, {"_key": entity_key(F.col("granule_id"))}, ["updated_at"], ["granule_id", "package_id", "deleted_at", "created_at"])
    refs = current.where("_key is not null and deleted_at is null").select(
        F.lit("granules").alias("child_table"), F.col("granule_id").alias("child_key"), entity_key(F.col("package_id")).alias("ref_key"), F.col("created_at").alias("child_created")
    )
    cuts = slices.select(F.lit("slices").alias("child_table"), F.col("slice_id").cast("string").alias("child_key"), entity_key(F.col("granule_id")).alias("ref_key"), F.col("created_at").alias("child_created"))
    to_packages = orphan_references(refs, validity_intervals(packages, entity_key(F.col("package_id")), "updated_at", "created_at", "deleted_at"), hot_keys(granules, entity_key(F.col("package_id"))))
    to_granules = orphan_references(cuts, validity_intervals(granules, entity_key(F.col("granule_id")), "updated_at", "created_at", "deleted_at"), hot_keys(slices, entity_key(F.col("granule_id"))))
    return to_packages.unionByName(to_granules)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p1_found(spark, d))


def _sql_key(c: str) -> str:
    return f"nullif(trim(lower(regexp_replace({c}, '@.*$', '')), {_SQL_BLANKS}), '')"


_SQL_BLANKS = "' ' || chr(9) || chr(13) || chr(10) || chr(160)"

P1_SQL = f"""
with g as (select *, {_sql_key('granule_id')} k from granules), p as (select *, {_sql_key('package_id')} k from packages),
gl as (select * from g where k is not null qualify row_number() over (partition by k order by updated_at desc) = 1),
pl as (select * from p where k is not null qualify row_number() over (partition by k order by updated_at desc) = 1),
refs as (
  select 'granules' child_table, granule_id child_key, {_sql_key('package_id')} ref, created_at from gl where deleted_at is null
  union all select 'slices', slice_id::varchar, {_sql_key('granule_id')}, created_at from slices),
pairs as (
  select r.*, p.k pk, p.deleted_at pdel, p.created_at pc from refs r left join pl p on r.ref = p.k where child_table = 'granules'
  union all select r.*, p.k, p.deleted_at, p.created_at from refs r left join gl p on r.ref = p.k where child_table = 'slices')
select distinct child_table, child_key,
  case when pk is null then 'missing' when pdel is not null then 'deleted' else 'late' end reason, strftime(created_at, '%Y-%m') period
from pairs where ref is not null and (pk is null or pdel is not null or pc > created_at)
"""

# ---- 2: deeply nested semi-structured records

KINDS = ("texts", "groups", "tables")
#: Leaves of each object, of its places, and of the other tables.
OBJECT = ("self_ref", "parent.$ref", "label", "content_layer", "name", "level", "text", "orig")
PLACE = ("page_no", "bbox.l", "bbox.t", "bbox.r", "bbox.b", "bbox.coord_origin")
ITEM_TABLES = [Table(k, (f"{k}[].self_ref", f"{k}[].parent.$ref", f"{k}[].prov[].bbox.l"), 2, outer=True) for k in KINDS]
OBJECT_TABLES = [Table(k, tuple(f"{k}[].{x}" for x in OBJECT), 1) for k in KINDS]
PLACE_TABLES = [Table(k, tuple(f"{k}[].prov[].{x}" for x in PLACE), 2) for k in KINDS]
CHILD_TABLES = [*[Table(k, (f"{k}[].children[].$ref",), 2) for k in KINDS], Table("body", ("body.children[].$ref",), 1)]
PAGE_TABLES = [Table("pages", ("pages{}.$key", "pages{}.page_no", "pages{}.size.width", "pages{}.size.height"), 1)]
CELL_TABLES = [Table("cells", ("tables[].data.grid[][].text",), 3)]
SECTION_TABLES = [Table("sections", ("references[].contents[].sections[]",), 3)]
SUMMARY = ("packageId", "collectionCode", "title", "congress", "session", "dateIssued", "pages", "download.pdfLink", "download.uslmLink")
SUMMARY_TABLES = [Table("summary", SUMMARY, 0), Table("short_title", ("shortTitle[].title",), 1)]
REFERENCE_TABLES = [Table("references", ("references[].collectionCode",), 1)]
CONTENT_TABLES = [Table("contents", tuple(f"references[].contents[].{x}" for x in ("label", "title", "congress", "number", "type")), 2)]
PAGE_REF_TABLES = [Table("pages", ("references[].contents[].pages[]",), 3)]


def _layout(spark: SparkSession, d: str, tables: list[Table]) -> DataFrame:
    return shred_tables(table(spark, d, "layout_docs"), {"granule_id": F.col("granule_id")}, "payload", "fetched_at", tables)


def _summaries(spark: SparkSession, d: str, tables: list[Table]) -> DataFrame:
    return shred_tables(table(spark, d, "plaw_summaries"), {"package_id": F.col("package_id")}, "payload", "fetched_at", tables)


def _vals(names: list[str], at: int = 0) -> list[Column]:
    return [F.col("vals")[at + i].alias(n) for i, n in enumerate(names)]


def _idx(*names: str) -> list[Column]:
    return [F.col("idx")[i].alias(n) for i, n in enumerate(names)]


def _number(i: int) -> Column:
    return F.round(F.expr(f"try_cast(vals[{i}] as decimal(28, 12))"), 4).cast("double")


def p2_items(spark: SparkSession, d: str) -> DataFrame:
    """Layout objects, one row per place on a page: granule_id, kind, position, place, self_ref, parent_ref, l."""
    return _layout(spark, d, ITEM_TABLES).select("granule_id", F.col("tbl").alias("kind"), *_idx("position", "place"), *_vals(["self_ref", "parent_ref"]), _number(2).alias("l"))


def p2_objects(spark: SparkSession, d: str) -> DataFrame:
    """Layout objects: granule_id, kind, position and every leaf. `self_ref` is what other objects' `parent_ref` and children refer to."""
    return _layout(spark, d, OBJECT_TABLES).select("granule_id", F.col("tbl").alias("kind"), *_idx("position"), *_vals(["self_ref", "parent_ref", "label", "content_layer", "name", "level", "text", "orig"]))


def p2_places(spark: SparkSession, d: str) -> DataFrame:
    """Places of layout objects on pages; (granule_id, kind, position) is the object."""
    sides = [_number(i + 1).alias(x) for i, x in enumerate("ltrb")]
    return _layout(spark, d, PLACE_TABLES).select("granule_id", F.col("tbl").alias("kind"), *_idx("position", "place"), F.expr("try_cast(vals[0] as int)").alias("page_no"), *sides, F.col("vals")[5].alias("coord_origin"))


def p2_children(spark: SparkSession, d: str) -> DataFrame:
    """References to children, of objects (granule_id, kind, position) and of the body (position -1), in their order."""
    body = F.col("tbl") == "body"
    flat = _layout(spark, d, CHILD_TABLES)
    return flat.select("granule_id", F.col("tbl").alias("kind"), F.when(body, -1).otherwise(F.col("idx")[0]).alias("position"), F.when(body, F.col("idx")[0]).otherwise(F.try_element_at("idx", F.lit(2))).alias("child"), F.col("vals")[0].alias("ref"))


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of layouts with their sizes; `page_key` is the page's name in the record."""
    return _layout(spark, d, PAGE_TABLES).select("granule_id", *_vals(["page_key"]), F.expr("try_cast(vals[1] as int)").alias("page_no"), _number(2).alias("width"), _number(3).alias("height"))


def p2_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of tables: granule_id, position of the table, row, column, text."""
    return _layout(spark, d, CELL_TABLES).select("granule_id", *_idx("position", "row", "column"), *_vals(["text"]))


def p2_summaries(spark: SparkSession, d: str) -> DataFrame:
    """The packages' own leaves, one row per package."""
    flat = _summaries(spark, d, SUMMARY_TABLES[:1])
    return flat.select("package_id", *_vals(["summary_id", "collection", "title", "congress", "session", "date_issued", "pages", "pdf_link", "uslm_link"]))


def p2_references(spark: SparkSession, d: str) -> DataFrame:
    return _summaries(spark, d, REFERENCE_TABLES).select("package_id", *_idx("reference"), *_vals(["collection"]))


def p2_contents(spark: SparkSession, d: str) -> DataFrame:
    """Cited titles and laws; (package_id, reference) is their reference."""
    return _summaries(spark, d, CONTENT_TABLES).select("package_id", *_idx("reference", "content"), *_vals(["label", "title", "congress", "number", "type"]))


def p2_cited_pages(spark: SparkSession, d: str) -> DataFrame:
    """Cited pages; (package_id, reference, content) is what cites them."""
    return _summaries(spark, d, PAGE_REF_TABLES).select("package_id", *_idx("reference", "content", "position"), *_vals(["page"]))


def p2_sections(spark: SparkSession, d: str) -> DataFrame:
    """Cited sections: package_id, reference, content and element positions, section."""
    return _summaries(spark, d, SECTION_TABLES).select("package_id", *_idx("reference", "content", "position"), *_vals(["section"]))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    items = p2_items(spark, d).select(
        F.col("granule_id").alias("record_id"), F.lit("item").alias("kind"), F.coalesce("parent_ref", F.lit("")).alias("parent_key"),
        F.col("self_ref").alias("child_key"), F.coalesce(F.round(F.col("l").cast("decimal(28, 6)") * 100).cast("long"), F.lit(-1)).alias("num"),
    )
    sections = p2_sections(spark, d).select(
        F.col("package_id").alias("record_id"), F.lit("section").alias("kind"), F.concat_ws("/", "reference", "content").alias("parent_key"),
        F.col("section").alias("child_key"), F.col("position").cast("long").alias("num"),
    )
    return items.unionByName(sections).distinct()


_JSON_LATEST = """
select id, arg_max(p, fetched_at)::json p from (
  select id, fetched_at, case when json_valid(q) then q end p from (
    select {id} id, fetched_at, case when json_valid(payload) then case when json_type(payload) = 'VARCHAR' then payload::json->>'$' else payload end end q from {table}))
where p is not null and json_type(p) = 'OBJECT' group by id
"""
_AS_LIST = "case when {x} is null or json_type({x}) = 'NULL' then []::json[] when json_type({x}) = 'ARRAY' then from_json({x}, '[\"JSON\"]') else [{x}] end"

_P2 = f"""
with layout as ({_JSON_LATEST.format(id='granule_id', table='layout_docs')}),
objects as (select id, unnest({' || '.join('(' + _AS_LIST.format(x=f"(p->'{k}')") + ')' for k in ('texts', 'groups', 'tables'))}) o from layout),
places as (select id, o, {_AS_LIST.format(x="(o->'prov')")} pr from objects),
boxes as (select id, o, unnest(case when len(pr) = 0 then ['null'::json] else pr end) e from places),
summary as ({_JSON_LATEST.format(id='package_id', table='plaw_summaries')}),
refs as (select id, generate_subscripts(l, 1) - 1 i, unnest(l) r from (select id, {_AS_LIST.format(x="(p->'references')")} l from summary)),
cont as (select id, i, generate_subscripts(l, 1) - 1 j, unnest(l) c from (select id, i, {_AS_LIST.format(x="(r->'contents')")} l from refs)),
secs as (select id, i, j, generate_subscripts(l, 1) - 1 n, unnest(l) s from (select id, i, j, {_AS_LIST.format(x="(c->'sections')")} l from cont))
"""

P2_SQL = f"""{_P2}
select distinct id record_id, 'item' kind,
  coalesce(case when json_type(o->'parent') = 'VARCHAR' then o->>'parent' else o->'parent'->>'$."$ref"' end, '') parent_key, o->>'self_ref' child_key,
  coalesce(round(try_cast(e->'bbox'->>'l' as decimal(28, 12)) * 100)::bigint, -1) num from boxes
union all select distinct id, 'section', i || '/' || j, s->>'$', n::bigint from secs
"""

P2_ITEMS_SQL = f"""
with layout as ({_JSON_LATEST.format(id='granule_id', table='layout_docs')}),
lists as ({' union all '.join(f"select id, '{k}' kind, {_AS_LIST.format(x=f"(p->'{k}')")} l from layout" for k in ('texts', 'groups', 'tables'))}),
objects as (select id, kind, generate_subscripts(l, 1) - 1 position, unnest(l) o from lists),
places as (select id, kind, position, o, {_AS_LIST.format(x="(o->'prov')")} pr from objects),
boxes as (select id, kind, position, o, -1 place, 'null'::json e from places where len(pr) = 0 union all select id, kind, position, o, generate_subscripts(pr, 1) - 1, unnest(pr) from places where len(pr) > 0)
select id granule_id, kind, position::int position, place::int place, o->>'self_ref' self_ref, case when json_type(o->'parent') = 'VARCHAR' then o->>'parent' else o->'parent'->>'$."$ref"' end parent_ref,
  round(try_cast(e->'bbox'->>'l' as decimal(28, 12)), 4)::double l from boxes
"""

_OBJECTS = f"""
layout as ({_JSON_LATEST.format(id='granule_id', table='layout_docs')}),
lists as ({' union all '.join(f"select id, '{k}' kind, {_AS_LIST.format(x=f"(p->'{k}')")} l from layout" for k in KINDS)}),
objects as (select id, kind, generate_subscripts(l, 1) - 1 position, unnest(l) o from lists)
"""
_SCALAR = "case when json_type({x}) = 'VARCHAR' then {x}->>'$' when json_type({x}) <> 'NULL' then {x}::varchar end"


def _leaf(x: str) -> str:
    return _SCALAR.format(x=f"({x})")


def _sql_number(x: str) -> str:
    return f"round(try_cast(({x}) as decimal(28, 12)), 4)::double"


P2_OBJECTS_SQL = f"""
with {_OBJECTS}
select id granule_id, kind, position::int position, {_leaf("o->'self_ref'")} self_ref, case when json_type(o->'parent') = 'VARCHAR' then o->>'parent' else o->'parent'->>'$."$ref"' end parent_ref,
  {', '.join(f"""{_leaf(f"o->'{x}'")} "{x}" """ for x in OBJECT[2:])} from objects
"""
_PLACES = "places as (select id, kind, position, generate_subscripts(l, 1) - 1 place, unnest(l) e from (select id, kind, position, " + _AS_LIST.format(x="(o->'prov')") + " l from objects))"
P2_PLACES_SQL = f"""
with {_OBJECTS}, {_PLACES}
select id granule_id, kind, position::int position, place::int place, try_cast(e->>'page_no' as int) page_no, {', '.join(f"{_sql_number(f"e->'bbox'->>'{x}'")} {x}" for x in 'ltrb')}, {_leaf("e->'bbox'->'coord_origin'")} coord_origin from places
"""
P2_CHILDREN_SQL = f"""
with {_OBJECTS}, every as (select id, kind, position, {_AS_LIST.format(x="(o->'children')")} l from objects union all select id, 'body', -1, {_AS_LIST.format(x="(p->'body'->'children')")} from layout)
select id granule_id, kind, position::int position, (generate_subscripts(l, 1) - 1)::int child, unnest(l)->>'$."$ref"' as ref from every
"""
P2_PAGES_SQL = f"""
with layout as ({_JSON_LATEST.format(id='granule_id', table='layout_docs')}),
keys as (select id, p->'pages' ps, unnest(json_keys(p->'pages')) k from layout where json_type(p->'pages') = 'OBJECT'), one as (select id, k, json_extract(ps, '$."' || k || '"') e from keys)
select id granule_id, k page_key, try_cast(e->>'page_no' as int) page_no, {_sql_number("e->'size'->>'width'")} width, {_sql_number("e->'size'->>'height'")} height from one
"""
P2_CELLS_SQL = f"""
with {_OBJECTS}, grids as (select id, position, {_AS_LIST.format(x="(o->'data'->'grid')")} l from objects where kind = 'tables'),
lines as (select id, position, generate_subscripts(l, 1) - 1 r, unnest(l) e from grids), cells as (select id, position, r, generate_subscripts(l, 1) - 1 c, unnest(l) e from (select id, position, r, {_AS_LIST.format(x='(e)')} l from lines))
select id granule_id, position::int position, r::int "row", c::int "column", {_leaf("e->'text'")} as text from cells
"""
P2_SUMMARIES_SQL = f"""
with summary as ({_JSON_LATEST.format(id='package_id', table='plaw_summaries')})
select id package_id, {', '.join(f"{_leaf("p->'" + x.replace('.', "'->'") + "'")} {n}" for x, n in zip(SUMMARY, ('summary_id', 'collection', 'title', 'congress', 'session', 'date_issued', 'pages', 'pdf_link', 'uslm_link'), strict=True))} from summary
"""
P2_REFERENCES_SQL = f"{_P2} select id package_id, i::int reference, {_leaf("r->'collectionCode'")} collection from refs"
P2_CONTENTS_SQL = f"{_P2} select id package_id, i::int reference, j::int content, {', '.join(f"""{_leaf(f"c->'{x}'")} "{x}" """ for x in ('label', 'title', 'congress', 'number', 'type'))} from cont"
P2_CITED_SQL = f"{_P2}, pg as (select id, i, j, generate_subscripts(l, 1) - 1 n, unnest(l) e from (select id, i, j, {_AS_LIST.format(x="(c->'pages')")} l from cont)) select id package_id, i::int reference, j::int content, n::int position, {_leaf('e')} page from pg"

# ---- 3: processing only new or changed records

UNIT = ["unit_id", "profile", "page_range"]


def _unit_keys() -> dict[str, Column]:
    return {"unit_id": F.col("unit_id"), "profile": F.col("profile"), "page_range": blank_trim(F.coalesce(F.col("page_range"), F.lit("")))}


def _listings(units: DataFrame) -> DataFrame:
    """The listings in force: the latest of each unit, unless removed."""
    current = latest(units, _unit_keys(), ["listed_at"], ["input_sha256", "removed"]).where("not coalesce(removed, false)")
    return current.select(*UNIT, digest_key(F.col("input_sha256")).alias("digest"))


def _done_numbers(log: DataFrame, results: DataFrame) -> DataFrame:
    """`seq` of the listings whose latest result, whenever it was recorded, is a success over the same digest."""
    ended = results.where("finished_at is not null and status is distinct from 'skipped'")
    last = latest(ended, _unit_keys(), ["finished_at", "recorded_at", "result_id"], ["status", "input_sha256"]).where("status = 'success'")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in UNIT]
    good = last.select(*UNIT, digest_key(F.col("input_sha256")).alias("digest")).where("digest is not null")
    return log.alias("l").join(good.alias("r"), [*same, F.col("l.digest") == F.col("r.digest")]).select("l.seq")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The listings in force are numbered on arrival; the numbers that results commit become the processed intervals; the units in the gaps they leave are to be processed."""
    log, behind = number_arrivals(_listings(table(spark, d, "units")))
    processed = to_intervals(_done_numbers(log, table(spark, d, "unit_results")))
    return pending(log, processed, available=ranges_of(spark, (0, behind))).select(*UNIT)


#: Months up to which the listings of each delivery of p3_runs came in; the last delivery has all.
DELIVERIES = 3


def p3_runs(spark: SparkSession, d: str) -> DataFrame:
    """`delivery, unit_id, profile, page_range, digest`: the ledger over deliveries of listings, each of which has all listings of the one before. Every listed version is
    processed in the delivery that first has it, and only there."""
    units = table(spark, d, "units")
    at = units.agg(F.min("listed_at").alias("a"), F.max("listed_at").alias("b")).first()
    path = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    ledger = IntervalLedger(spark, path, UNIT, ["digest"])
    for k in range(DELIVERIES):
        share = (k + 1) / DELIVERIES
        have = units if at.a is None or share == 1 else units.where(F.col("listed_at") <= F.lit(str(at.a + (at.b - at.a) * share)).cast(units.schema["listed_at"].dataType))
        ledger.arrive(have.select(*[e.alias(c) for c, e in _unit_keys().items()], digest_key(F.col("input_sha256")).alias("digest")))
        ledger.run(lambda todo, k=k: todo.select(F.lit(k + 1).alias("delivery"), *UNIT, "digest"))
    out = cut(ledger.output())
    ledger.remove()
    return out


P3_SQL = f"""
with u as (select unit_id, profile, trim(coalesce(page_range, ''), {_SQL_BLANKS}) page_range, input_sha256, removed from units
  qualify row_number() over (partition by unit_id, profile, trim(coalesce(page_range, ''), {_SQL_BLANKS}) order by listed_at desc) = 1),
r as (select unit_id, profile, trim(coalesce(page_range, ''), {_SQL_BLANKS}) page_range, status, input_sha256 from unit_results
  where finished_at is not null and status is distinct from 'skipped'
  qualify row_number() over (partition by unit_id, profile, trim(coalesce(page_range, ''), {_SQL_BLANKS}) order by finished_at desc) = 1)
select u.unit_id, u.profile, u.page_range from u left join r on u.unit_id = r.unit_id and u.profile = r.profile and u.page_range = r.page_range
where not coalesce(u.removed, false) and not coalesce(r.status = 'success'
  and trim(regexp_replace(trim(lower(r.input_sha256), {_SQL_BLANKS}), '^sha256:', ''), {_SQL_BLANKS}) = trim(regexp_replace(trim(lower(u.input_sha256), {_SQL_BLANKS}), '^sha256:', ''), {_SQL_BLANKS}), false)
"""

P3_RUNS_SQL = f"""
with u as (select unit_id, profile, trim(coalesce(page_range, ''), {_SQL_BLANKS}) page_range, nullif(trim(regexp_replace(trim(lower(input_sha256), {_SQL_BLANKS}), '^sha256:', ''), {_SQL_BLANKS}), '') digest, listed_at from units),
t as (select min(listed_at) a, max(listed_at) b from units),
f as (select unit_id, profile, page_range, digest, min(listed_at) first from u group by all)
select case when first <= a + (b - a) * (1.0 / 3) then 1 when first <= a + (b - a) * (2.0 / 3) then 2 else 3 end delivery, unit_id, profile, page_range, digest from f, t
"""

# ---- 5: differences between two copies of data


def _path_key(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(c), F.lit(BLANKS)), r"^(\./|/)+", "")


def p5_diffs(spark: SparkSession, d: str) -> DataFrame:
    """`hub_path, diffs`: each row's differences as `field|ledger value|Hub value`, one behind the other."""
    side = lambda x, n: F.coalesce(x[n], F.lit(""))
    said = F.transform("diffs", lambda x: F.concat_ws("|", x["field"], side(x, "left_value"), side(x, "right_value")))
    return _differences(spark, d).select("hub_path", F.array_join(said, ";").alias("diffs"))


def _differences(spark: SparkSession, d: str) -> DataFrame:
    ledger = latest(table(spark, d, "file_decisions"), {"hub_path": _path_key(F.col("hub_path"))}, ["recorded_at"], ["expected", "local", "sha256"])
    hub = latest(table(spark, d, "hub_entries").where("size is not null"), {"hub_path": _path_key(F.col("hub_path"))}, ["committed_at"], ["size", "sha256"])
    fields = [
        Field("size", F.col("l.expected"), F.col("r.size")),
        Field("sha256", digest_key(F.col("l.sha256")), digest_key(F.col("r.sha256"))),
        Field("local", F.col("l.expected"), F.col("l.local"), within=True),
    ]
    return diff_copies(ledger, hub, "hub_path", fields, "missing_on_hub", "missing_in_ledger")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return diff_fields(_differences(spark, d), "hub_path").select("hub_path", "field")


def _sql_path(c: str) -> str:
    return f"regexp_replace(trim(lower({c}), {_SQL_BLANKS}), '^(\\./|/)+', '')"


def _sql_digest(c: str) -> str:
    return f"nullif(trim(regexp_replace(trim(lower({c}), {_SQL_BLANKS}), '^sha256:', ''), {_SQL_BLANKS}), '')"


P5_SQL = f"""
with l as (select {_sql_path('hub_path')} k, * from file_decisions qualify row_number() over (partition by {_sql_path('hub_path')} order by recorded_at desc) = 1),
h as (select {_sql_path('hub_path')} k, * from hub_entries where size is not null qualify row_number() over (partition by {_sql_path('hub_path')} order by committed_at desc) = 1),
b as (select coalesce(l.k, h.k) hub_path, l.recorded_at is not null in_l, h.committed_at is not null in_h, l.expected, l.local, h.size, {_sql_digest('l.sha256')} ls, {_sql_digest('h.sha256')} hs
  from l full outer join h on l.k = h.k)
select hub_path, 'missing_on_hub' field from b where in_l and not in_h
union all select hub_path, 'missing_in_ledger' from b where in_h and not in_l
union all select hub_path, 'size' from b where in_l and in_h and expected <> size
union all select hub_path, 'sha256' from b where in_l and in_h and ls <> hs
union all select hub_path, 'local' from b where in_l and expected <> local
"""

P5_DIFFS_SQL = f"""
{P5_SQL.split("select hub_path, 'missing_on_hub'")[0]},
v as (select hub_path, list_filter([
  case when in_l and not in_h then 'missing_on_hub||' end, case when in_h and not in_l then 'missing_in_ledger||' end, case when in_l and in_h and expected <> size then 'size|' || expected || '|' || size end,
  case when in_l and in_h and ls <> hs then 'sha256|' || ls || '|' || hs end, case when in_l and expected <> local then 'local|' || expected || '|' || local end], lambda x: x is not null) said from b)
select hub_path, array_to_string(said, ';') diffs from v where len(said) > 0
"""

QUERIES = {
    "p1_found": p1_found, "p1_report": p1_report, "p2_found": p2_found, "p2_items": p2_items, "p2_sections": p2_sections, "p2_objects": p2_objects, "p2_places": p2_places, "p2_children": p2_children, "p2_pages": p2_pages, "p2_cells": p2_cells,
    "p2_summaries": p2_summaries, "p2_references": p2_references, "p2_contents": p2_contents, "p2_cited_pages": p2_cited_pages, "p3_found": p3_found, "p3_runs": p3_runs, "p5_found": p5_found, "p5_diffs": p5_diffs,
}
SQL = {
    "p1_found": P1_SQL,
    "p1_report": f"select child_table, period, reason, count(*) orphans from ({P1_SQL}) group by all",
    "p2_found": P2_SQL,
    "p2_sections": f"{_P2} select id package_id, i::int reference, j::int content, n::int position, s->>'$' section from secs",
    "p2_items": P2_ITEMS_SQL,
    "p2_objects": P2_OBJECTS_SQL,
    "p2_places": P2_PLACES_SQL,
    "p2_children": P2_CHILDREN_SQL,
    "p2_pages": P2_PAGES_SQL,
    "p2_cells": P2_CELLS_SQL,
    "p2_summaries": P2_SUMMARIES_SQL,
    "p2_references": P2_REFERENCES_SQL,
    "p2_contents": P2_CONTENTS_SQL,
    "p2_cited_pages": P2_CITED_SQL,
    "p3_found": P3_SQL,
    "p3_runs": P3_RUNS_SQL,
    "p5_found": P5_SQL,
    "p5_diffs": P5_DIFFS_SQL,
}
