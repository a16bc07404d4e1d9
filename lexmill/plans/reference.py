"""Queries of the ledger, sampling, text, layout and report operators, over whole tables, with DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import fuzzy, ids, markers, text, xml
from lexmill.operators import catalog, layout, metrics, report, sampling, shred
from lexmill.plans import problems
from lexmill.session import latest, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- rows the queries share

_GRANULES = "select * from granules qualify row_number() over (partition by granule_id order by updated_at desc) = 1"
_PACKAGES = "select * from packages where package_id is not null qualify row_number() over (partition by package_id order by updated_at desc) = 1"
_VOLUME = "try_cast(regexp_extract(granule_id, '^STATUTE-([0-9]+)-', 1) as int)"
_ID = "'^STATUTE-([0-9]+)-Pg([A-Za-z]*)([0-9]+)(?:-([0-9]+))?$'"


def _granules(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "granules")
    one = latest(raw, ["granule_id"], ["updated_at"], [c for c in raw.columns if c not in ("granule_id", "updated_at")])
    return one.withColumn("volume", ids.granule_volume(F.col("granule_id")))


def _packages(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "packages").where("package_id is not null")
    return latest(raw, ["package_id"], ["updated_at"], [c for c in raw.columns if c not in ("package_id", "updated_at")])


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_items").select("item_id", "granule_id", "volume", "page_no", "item_no", "label", "text", "orig", "l", "t", "r", "b").distinct()


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Files of both copies: package_id, pos, hub_path, expected, hub, local, digests."""
    path = F.regexp_replace(text.strip(F.lower("hub_path")), r"^(\./|/)+", "")
    ledger = latest(table(spark, d, "file_decisions"), {"hub_path": path}, ["recorded_at"], ["expected", "local", "sha256"])
    hub = latest(table(spark, d, "hub_entries").where("size is not null"), {"hub_path": path}, ["committed_at"], ["size", "sha256"])
    both = ledger.alias("l").join(hub.alias("h"), "hub_path", "left")
    stem = F.regexp_extract("hub_path", r"/([^/]+)\.[a-z]+$", 1)
    return both.select(stem.alias("package_id"), F.when(F.col("hub_path").endswith("pdf"), 0).otherwise(1).alias("pos"), "hub_path", "expected", F.col("h.size").alias("hub"), "local", F.col("l.sha256").alias("sha256"), F.col("h.sha256").alias("hub_sha256"))


_PATH = "regexp_replace(trim(lower(hub_path)), '^(\\./|/)+', '')"
_FILES = f"""
files as (select regexp_extract(l.k, '/([^/]+)\\.[a-z]+$', 1) package_id, case when l.k like '%pdf' then 0 else 1 end pos, l.k hub_path, l.expected, h.size hub, l.local, l.sha256, h.sha256 hub_sha256
  from (select {_PATH} k, * from file_decisions qualify row_number() over (partition by {_PATH} order by recorded_at desc) = 1) l
  left join (select {_PATH} k, * from hub_entries where size is not null qualify row_number() over (partition by {_PATH} order by committed_at desc) = 1) h on l.k = h.k)"""

# ---- ledger


@query(f"""
with {_FILES},
f as (select *, (hub is not null and (expected is null or hub = expected)) on_hub, coalesce(hub <> expected, false) bad, coalesce(local = expected, false) complete from files),
p as (select package_id, count(expected) n, count(*) filter (expected is not null and on_hub) hubs, count(*) filter (expected is not null and (on_hub or complete)) have,
  coalesce(string_agg(hub_path, ', ' order by pos, hub_path) filter (expected is not null and bad), '') mism, coalesce(string_agg(hub_path, ', ' order by pos, hub_path) filter (expected is not null and not on_hub and not complete), '') miss from f group by package_id)
select package_id, case when n = 0 or hubs = n then 'skip' when have = n then 'upload-only' else 'download' end "action",
  case when n = 0 then 'no files are listed for this package' when hubs = n then 'on Hub with matching sizes'
    when have = n then case when mism <> '' then 'Hub size mismatch for ' || mism || '; complete locally' else 'complete locally, missing from Hub' end
    else case when mism <> '' then 'Hub size mismatch for ' || mism || '; ' else '' end || 'missing or incomplete: ' || miss end reason from p""")
def decide_actions(spark: SparkSession, d: str) -> DataFrame:
    return catalog.decide(_files(spark, d))


@query(f"""
with {_FILES},
p as (select package_id, count(expected) n, count(*) filter (expected is not null and local = expected) have,
  coalesce(string_agg(hub_path, ', ' order by pos, hub_path) filter (expected is not null and local is distinct from expected), '') miss from files group by package_id)
select package_id, case when have = n then 'skip' else 'download' end "action",
  case when n = 0 then 'no files are listed for this package' when have = n then 'complete locally (uploads disabled)' else 'missing or incomplete locally: ' || miss end reason from p""")
def decide_without_uploads(spark: SparkSession, d: str) -> DataFrame:
    return catalog.decide(_files(spark, d), upload_enabled=False)


_RECONCILE = f"""
with {_FILES}, e as (select * from files where expected is not null)
select package_id, hub_path "path", 'size-mismatch' category, 'Hub ' || hub || ', expected ' || expected detail from e where hub <> expected
union all select package_id, hub_path, 'size-mismatch', 'local ' || local || ', expected ' || expected from e where local <> expected
union all select package_id, hub_path, 'local-only', expected || ' bytes' from e where hub is null and local = expected
union all select package_id, hub_path, 'missing', 'not on Hub, not complete locally' from e where hub is null and local is distinct from expected"""


@query(_RECONCILE)
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    return catalog.reconcile(_files(spark, d).withColumnRenamed("hub_path", "path"))


_HUB_ONLY = """
select regexp_replace(regexp_extract(k, '[^/]*$'), '\\.[^.]*$', '') package_id, k "path", 'hub-only' category, 'no package for this file' detail
from (select distinct regexp_replace(trim(lower(hub_path)), '^(\\./|/)+', '') k from hub_entries where size is not null)
where (k like 'pdfs/%' or k like 'xmls/%') and regexp_replace(regexp_extract(k, '[^/]*$'), '\\.[^.]*$', '') not in (select lower(package_id) from packages where package_id is not null)"""


@query(_HUB_ONLY)
def hub_only(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace(text.strip(F.lower("hub_path")), r"^(\./|/)+", "")
    hub = table(spark, d, "hub_entries").where("size is not null").select(path.alias("path")).distinct()
    return catalog.hub_only(hub, table(spark, d, "packages").select(F.lower("package_id").alias("package_id")).where("package_id is not null"))


@query(f"select c.pos, c.category, count(e.category) n from (values (0, 'local-only'), (1, 'hub-only'), (2, 'size-mismatch'), (3, 'missing')) c(pos, category) left join ({_RECONCILE} union all {_HUB_ONLY}) e on c.category = e.category group by 1, 2")
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.category_counts(reconcile(spark, d).unionByName(hub_only(spark, d)))


@query(f"""
with {_FILES} select hub_path "path", (hub is not null and hub is not distinct from coalesce(expected, hub) and coalesce(sha256 = hub_sha256, true)) ok,
  (case when hub is null then 1 else 0 end + case when hub <> expected then 1 else 0 end + case when hub is not null and sha256 <> hub_sha256 then 1 else 0 end)::int problems from files""")
def verify_paths(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d).select(F.col("hub_path").alias("path"), F.col("expected").alias("size"), "sha256", F.col("hub").alias("hub_size"), "hub_sha256")
    return catalog.verify(f).select("path", "ok", F.size("problems").alias("problems"))


_SOURCE = "select c_custkey + 500 c_custkey, c_name, case when c_custkey % 3 = 0 then null else c_acctbal end c_acctbal, c_mktsegment from customer"


def _upserted(spark: SparkSession, d: str, policy) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = c.select((F.col("c_custkey") + 500).alias("c_custkey"), "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment")
    return catalog.upsert(c, new, ["c_custkey"], policy)


@query(f"select coalesce(s.c_custkey, t.c_custkey) c_custkey, case when s.c_custkey is null then t.c_name else s.c_name end c_name, case when s.c_custkey is null then t.c_acctbal else s.c_acctbal end c_acctbal, case when s.c_custkey is null then t.c_mktsegment else s.c_mktsegment end c_mktsegment from customer t full join ({_SOURCE}) s on t.c_custkey = s.c_custkey")
def upsert_overwrite(spark: SparkSession, d: str) -> DataFrame:
    return _upserted(spark, d, catalog.OVERWRITE)


@query(f"select coalesce(s.c_custkey, t.c_custkey) c_custkey, coalesce(s.c_name, t.c_name) c_name, coalesce(s.c_acctbal, t.c_acctbal) c_acctbal, case when t.c_custkey is null then s.c_mktsegment else t.c_mktsegment end c_mktsegment from customer t full join ({_SOURCE}) s on t.c_custkey = s.c_custkey")
def upsert_by_column(spark: SparkSession, d: str) -> DataFrame:
    return _upserted(spark, d, {"c_name": catalog.COALESCE, "c_acctbal": catalog.COALESCE, "c_mktsegment": catalog.KEEP})


_ATTEMPTS = "select distinct * from unit_results where finished_at is not null"


@query(f"""
with u as ({_ATTEMPTS}) select unit_id, profile, page_range, status, result_id from (select unit_id, profile, coalesce(page_range, '') page_range, status, result_id,
  row_number() over (partition by unit_id, profile, coalesce(page_range, '') order by finished_at desc, result_id desc) n from u) where n = 1""")
def latest_attempts(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "unit_results").where("finished_at is not null")
    keys = {"unit_id": F.col("unit_id"), "profile": F.col("profile"), "page_range": F.coalesce("page_range", F.lit(""))}
    return latest(done, keys, ["finished_at", "result_id"], ["status", "result_id"])


@query("""
with old as (select distinct result_id, unit_id, profile, coalesce(page_range, '') k, status from unit_results where status <> 'success'),
new as (select distinct result_id, unit_id, profile, coalesce(page_range, '') k, status from unit_results where status = 'success')
select result_id, unit_id, profile, status from old where not exists (select 1 from new where new.unit_id = old.unit_id and new.profile = old.profile and new.k = old.k)
union all select result_id, unit_id, profile, status from new""")
def replace_conversions(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "unit_results").select("result_id", "unit_id", "profile", "page_range", "status").distinct()
    key = catalog.conversion_key(F.col("unit_id"), F.lit(None).cast("string"), F.col("page_range"), F.col("profile"))
    return catalog.replace_rows(r.where("status <> 'success'"), r.where("status = 'success'"), key).select("result_id", "unit_id", "profile", "status")


@query("""
with base as (select distinct package_id from packages where package_id is not null),
e as (select package_id, updated_at, pdf_status, pdf_sha256, xml_bytes from packages where package_id is not null)
select b.package_id, (select arg_max(pdf_status, (updated_at, pdf_status)) from e where e.package_id = b.package_id and pdf_status is not null) pdf_status,
  (select arg_max(pdf_sha256, (updated_at, pdf_sha256)) from e where e.package_id = b.package_id and pdf_sha256 is not null) pdf_sha256,
  (select arg_max(xml_bytes, (updated_at, xml_bytes)) from e where e.package_id = b.package_id and xml_bytes is not null) xml_bytes from base b""")
def file_events(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "packages").where("package_id is not null").select("package_id", "updated_at", "pdf_status", "pdf_sha256", "xml_bytes")
    null = F.lit(None)
    base = events.select("package_id").distinct().select("package_id", null.cast("string").alias("pdf_status"), null.cast("string").alias("pdf_sha256"), null.cast("bigint").alias("xml_bytes"))
    return catalog.apply_file_events(base, events, "package_id", "updated_at", ["pdf_status", "pdf_sha256", "xml_bytes"])


@query(f"""
with p as ({_PACKAGES}) select 'pdfs/' || package_id || '.pdf' file_name, package_id, volume, congress, "session", strftime(date_issued, '%Y-%m-%d') date_issued, pages, scanned, pdf_bytes, pdf_sha256,
  case when xml_status in ('uploaded', 'verified') then 'xmls/' || package_id || '.xml' end xml_file, xml_bytes, xml_sha256
from p where collection = 'STATUTE' and pdf_status in ('uploaded', 'verified')""")
def metadata_rows(spark: SparkSession, d: str) -> DataFrame:
    return catalog.metadata_rows(_packages(spark, d))


@query(f"with p as ({_PACKAGES}) select package_id, volume, title from p where collection = 'STATUTE'")
def list_packages(spark: SparkSession, d: str) -> DataFrame:
    return catalog.list_packages(_packages(spark, d)).select("package_id", "volume", "title")


@query(f"""
with g as ({_GRANULES}) select distinct trim(package_id) package_id from g where trim(package_id) <> '' and trim(package_id) not in (select package_id from packages where package_id is not null)""")
def missing_parents(spark: SparkSession, d: str) -> DataFrame:
    g = _granules(spark, d).select(F.trim("package_id").alias("package_id")).where("package_id <> ''")
    return catalog.missing_parents(g, table(spark, d, "packages").select("package_id").where("package_id is not null"), "package_id")


@query("""
with memo as (select distinct unit_id, profile, lower(input_sha256) sha from unit_results where status = 'success' and input_sha256 is not null)
select distinct u.unit_id, u.profile, lower(u.input_sha256) sha from units u join memo on memo.unit_id = u.unit_id and memo.profile = u.profile and memo.sha = lower(u.input_sha256)""")
def memo_hits(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t: t.select("unit_id", "profile", F.lower("input_sha256").alias("sha"))
    work = key(table(spark, d, "units")).distinct()
    return catalog.memo_hits(work, key(table(spark, d, "unit_results").where("status = 'success' and input_sha256 is not null")), ["unit_id", "profile", "sha"])


@query("""
with r as (select unit_id, profile, arg_max(status, (finished_at, result_id)) status, arg_max(lower(coalesce(input_sha256, '')), (finished_at, result_id)) sha from unit_results where finished_at is not null group by 1, 2),
u as (select unit_id, profile, arg_max(lower(coalesce(input_sha256, '')), (listed_at, lower(coalesce(input_sha256, '')))) sha from units group by 1, 2)
select u.unit_id, u.profile, coalesce(r.status = 'success' and r.sha = u.sha, false) skip from u left join r on u.unit_id = r.unit_id and u.profile = r.profile""")
def should_skip(spark: SparkSession, d: str) -> DataFrame:
    sha = F.lower(F.coalesce("input_sha256", F.lit("")))
    u = latest(table(spark, d, "units").withColumn("sha", sha), ["unit_id", "profile"], ["listed_at"], ["sha"])
    r = latest(table(spark, d, "unit_results").where("finished_at is not null").withColumn("previous", sha), ["unit_id", "profile"], ["finished_at", "result_id"], ["status", "previous"])
    return u.join(r, ["unit_id", "profile"], "left").select("unit_id", "profile", catalog.skippable(F.lit(True), F.col("status"), F.col("previous"), F.col("sha")).alias("skip"))


_LATEST_SUMMARY = """
s as (select package_id, arg_max(p, fetched_at)::json p from (select package_id, fetched_at, case when json_valid(q) then q end p from (
  select package_id, fetched_at, case when json_valid(payload) then case when json_type(payload) = 'VARCHAR' then payload::json->>'$' else payload end end q from plaw_summaries)) where p is not null and json_type(p) = 'OBJECT' group by 1)"""


def _summaries(spark: SparkSession, d: str) -> DataFrame:
    """Latest readable summaries, parsed; shapes that drift were tidied by the shredder's reading."""
    raw = shred.decoded(table(spark, d, "plaw_summaries"), "package_id", "payload", "fetched_at")
    return raw.select("package_id", catalog.parse_summary(F.col("payload")).alias("s"))


#: What the summaries cite of the collection of statutes, in order: volume and pages of each entry.
_CITED = f"""{problems._P2},
st as (select cont.id, cont.c, row_number() over (partition by cont.id order by cont.i, cont.j) pos from cont join refs on cont.id = refs.id and cont.i = refs.i where refs.r->>'collectionCode' = 'STATUTE'),
e as (select id, pos, try_cast(trim(c->>'title') as int) v, list_filter(list_transform({problems._AS_LIST.format(x="(c->'pages')")}, lambda x: try_cast(trim(x->>'$') as int)), lambda x: x is not null) ps from st),
s as (select id, p, p->>'packageId' pid, try_cast(p->>'pages' as int) n from summary)"""


@query(f"""
{_CITED}, last as (select id, v from e qualify row_number() over (partition by id order by pos desc) = 1),
r as (select s.*, coalesce(nullif(p->>'collectionCode', ''), split_part(pid, '-', 1)) collection, last.v from s left join last using (id) where pid is not null),
w as (select *, coalesce(try_cast(p->>'volume' as int), case when collection = 'PLAW' then v end) volume from r)
select pid package_id, collection, volume, try_cast(p->>'congress' as int) congress, try_cast(p->>'session' as int) "session", try_cast(substr(p->>'dateIssued', 1, 10) as date) date_issued, n pages, p->>'title' title,
  case when collection = 'STATUTE' then volume <= 116 end scanned, p->'download'->>'pdfLink' pdf_url, p->'download'->>'uslmLink' xml_url from w""")
def package_rows(spark: SparkSession, d: str) -> DataFrame:
    return _summaries(spark, d).select(*catalog.package_row(F.col("s"))).where("package_id is not null")


@query(f"""
{_CITED}, best as (select e.* from e join s using (id) qualify row_number() over (partition by e.id order by coalesce(n > 0 and len(ps) = n, false) desc, len(ps) desc, pos) = 1),
k as (select *, regexp_extract(pid, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 1) c, regexp_extract(pid, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 2) t, regexp_extract(pid, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 3) m from s)
select c || case when t = 'pvtl' then '-pvt' else '-' end || m pl_number, c::int congress, m::int law_number, p->>'title' title, try_cast(substr(p->>'dateIssued', 1, 10) as date) date_enacted, v volume, list_min(ps) start_page, list_max(ps) end_page
from k left join best on k.id = best.id where c <> ''""")
def law_rows(spark: SparkSession, d: str) -> DataFrame:
    return _summaries(spark, d).select(*catalog.statute_row(F.col("s"), F.lit(None).cast("string"))).where("pl_number is not null")


@query("""
select package_id, regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 1) || case when regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 2) = 'pvtl' then '-pvt' else '-' end || regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 3) pl_number,
  '/us/' || case when regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 2) = 'pvtl' then 'pvtl' else 'pl' end || '/' || regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 1) || '/' || regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', 3) identifier
from (select distinct package_id from packages) where regexp_matches(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$')""")
def law_numbers(spark: SparkSession, d: str) -> DataFrame:
    p, c = table(spark, d, "packages").select("package_id").distinct(), F.col("package_id")
    out = p.select("package_id", ids.pl_number(c).alias("pl_number"), ids.law_identifier(ids.plaw_congress(c), ids.plaw_number(c), ids.plaw_is_private(c)).alias("identifier"))
    return out.where("pl_number is not null")


@query(f"""
with p as ({_PACKAGES}) select package_id, date_issued from p where collection = 'PLAW' and regexp_matches(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$') and coalesce(date_issued >= date '2010-01-01', true)""")
def select_laws(spark: SparkSession, d: str) -> DataFrame:
    p = _packages(spark, d).where("collection = 'PLAW'").select("package_id", "date_issued")
    return catalog.select_packages(p, F.lit("2010-01-01").cast("date"))


@query("""
with f as (select distinct hub_path, size from hub_entries where size >= 0), p as (select *, least(4, greatest(1, size // 1048576)) n from f)
select hub_path, size, i::bigint part, i * (size // n) + least(i, size % n) first_byte, (i + 1) * (size // n) + least(i + 1, size % n) - 1 last_byte from (select *, unnest(range(0, n)) i from p where size > 0)""")
def byte_ranges(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "hub_entries").where("size >= 0").select("hub_path", "size").distinct()
    parts = f.select("hub_path", "size", F.posexplode(ids.byte_ranges(F.col("size"), F.lit(4), 1 << 20)).alias("part", "r"))
    return parts.select("hub_path", "size", F.col("part").cast("long").alias("part"), F.col("r.first").alias("first_byte"), F.col("r.last").alias("last_byte"))


# ---- identifiers and sampling


@query(f"""
select distinct granule_id, {_VOLUME} volume, lower(regexp_extract(granule_id, {_ID}, 2) || regexp_extract(granule_id, {_ID}, 3)) page, coalesce(try_cast(nullif(regexp_extract(granule_id, {_ID}, 4), '') as int), 1) ordinal,
  regexp_extract(granule_id, '^(STATUTE-[0-9]+)-Pg', 1) package_id from granules where regexp_matches(granule_id, {_ID})""")
def granule_ids(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("granule_id")
    g = table(spark, d, "granules").select("granule_id").distinct()
    return g.select("granule_id", ids.granule_volume(c).alias("volume"), ids.granule_page(c).alias("page"), ids.granule_ordinal(c).alias("ordinal"), ids.package_of_granule(c).alias("package_id")).where("page is not null")


@query("""
select distinct granule_id, page_no, regexp_extract(granule_id, '-Pg([A-Za-z]*)([0-9]+)', 1) || (regexp_extract(granule_id, '-Pg([A-Za-z]*)([0-9]+)', 2)::int + page_no - 1) label from page_items where granule_id is not null and page_no is not null""")
def page_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_items").select("granule_id", "page_no").where("granule_id is not null and page_no is not null").distinct()
    start = F.upper(ids.granule_page(F.col("granule_id")))
    return p.select("granule_id", "page_no", ids.stat_page_label(start, F.col("page_no")).alias("label"))


_EST = f"""
k as (select granule_id, granule_class, title, date_issued, {_VOLUME} volume, lower(regexp_extract(granule_id, {_ID}, 2)) pre, regexp_extract(granule_id, {_ID}, 3)::int page, coalesce(try_cast(nullif(regexp_extract(granule_id, {_ID}, 4), '') as int), 1) pos
  from ({_GRANULES}) where regexp_matches(granule_id, {_ID})),
est as (select *, greatest(1, coalesce(lead(page) over (partition by volume, pre order by page, pos, granule_id) - page, 1)) est_pages from k)"""
_ERA = "case when volume between 1 and 64 then 'scanned-pre-1951' when volume between 65 and 116 then 'scanned-1951-2002' when volume between 117 and 137 then 'digital-2003+' end"
_PERIOD = "case when volume between 1 and 9 then '1789-1850' when volume between 10 and 31 then '1851-1900' when volume between 32 and 64 then '1901-1950' when volume between 65 and 89 then '1951-1975' when volume between 90 and 116 then '1976-2002' end"


@query(f"with {_EST} select granule_id, volume, est_pages from est")
def estimate_pages(spark: SparkSession, d: str) -> DataFrame:
    return sampling.estimate_pages(_granules(spark, d)).select("granule_id", "volume", "est_pages")


_CELLS = f"""
{_EST}, pool as (select *, {_ERA} era from est where est_pages <= 30),
allowed as (select * from pool where era is not null and granule_class in ('PUBLICLAW', 'PRIVATELAW', 'PROCLAMATION', 'TREATY', 'HCONRES', 'SCONRES') and (era <> 'digital-2003+' or granule_class in ('PUBLICLAW', 'PRIVATELAW'))),
cells as (select * from allowed qualify row_number() over (partition by era, granule_class order by sha256('20260905:' || granule_id), granule_id) <= 10)"""


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_sample(sampling.granule_pool(_granules(spark, d), 30, None), ["era", "granule_class"], "granule_id", 10, 20260905)


@query(f"with {_CELLS} select granule_id, era, granule_class, est_pages from cells")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).select("granule_id", "era", "granule_class", "est_pages")


@query(f"with {_CELLS} select era, granule_class, count(*) granules, sum(est_pages)::bigint pages from cells group by 1, 2")
def sample_counts(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_counts(_sample(spark, d))


_PICKED = "p as (select granule_id, unnest(range(1, total_pages + 1))::int pdf_page from g where total_pages > 0), picked as (select * from p qualify row_number() over (partition by granule_id order by sha256('7:' || granule_id || ':' || pdf_page)) <= 2)"


@query(f"with g as ({_GRANULES}), {_PICKED} select granule_id, pdf_page from picked")
def choose_pages(spark: SparkSession, d: str) -> DataFrame:
    return sampling.choose_pages(_granules(spark, d), "granule_id", "total_pages", 7, 2).select("granule_id", "pdf_page")


@query(f"with g as ({_GRANULES}), {_PICKED} select granule_id, array_to_string(list_sort(list(pdf_page)), ',') pages from picked group by 1")
def regroup_pages(spark: SparkSession, d: str) -> DataFrame:
    return sampling.regroup_pages(choose_pages(spark, d)).select("granule_id", F.concat_ws(",", F.col("pages").cast("array<string>")).alias("pages"))


@query(f"""
with {_EST}, pool as (select *, {_PERIOD} period from est where granule_class = 'PUBLICLAW' and est_pages <= 12),
v as (select period, volume from (select distinct period, volume from pool) qualify row_number() over (partition by period order by sha256('11:' || volume), volume) <= 3),
mine as (select p.* from pool p join v on p.volume = v.volume and p.period is not distinct from v.period where p.period is not null),
turns as (select *, row_number() over (partition by volume order by sha256('11:' || period || ':' || granule_id), granule_id) r from mine),
pages as (select *, unnest(range(1, est_pages + 1))::int pdf_page from turns),
picked as (select * from pages qualify row_number() over (partition by granule_id order by sha256('11:' || granule_id || ':' || pdf_page)) <= 2)
select period, granule_id, pdf_page from picked qualify row_number() over (partition by period order by r, volume, granule_id, pdf_page) <= 30""")
def plan_pages(spark: SparkSession, d: str) -> DataFrame:
    pool = sampling.granule_pool(_granules(spark, d), 12).where("period is not null")
    return sampling.plan_pages(pool, 11, 30, 2, 3).select("period", "granule_id", "pdf_page")


@query(f"""
with g as (select granule_id, {_VOLUME} volume, page_start pdf_page from ({_GRANULES}) where page_start is not null), p as (select *, {_PERIOD} period from g)
select period, granule_id from p where period is not null qualify row_number() over (partition by period order by sha256('5:review:' || granule_id || ':' || pdf_page), granule_id, pdf_page) <= 6""")
def choose_review(spark: SparkSession, d: str) -> DataFrame:
    g = _granules(spark, d).where("page_start is not null").select("granule_id", F.col("page_start").alias("pdf_page"), ids.period(F.col("volume")).alias("period"))
    return sampling.choose_review(g.where("period is not null"), 5, 30, groups=5).select("period", "granule_id")


@query(f"""
with g as (select granule_id, {_VOLUME} volume from ({_GRANULES})), r as (select *, row_number() over (partition by volume order by granule_id) n from g where volume is not null)
select granule_id, row_number() over (partition by n order by volume) turn_in_round, n::int round_no from r""")
def interleave(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    g = sampling.interleave(_granules(spark, d).where("volume is not null").select("granule_id", "volume"), "volume", [F.col("granule_id")])
    return g.select("granule_id", F.row_number().over(Window.partitionBy("turn._r").orderBy("turn._by")).cast("long").alias("turn_in_round"), F.col("turn._r").alias("round_no"))


@query("""
with o as (select o_custkey, o_orderkey, o_totalprice, count(*) over w n, sum(o_totalprice) over w s from orders window w as (partition by o_custkey order by o_orderkey rows unbounded preceding))
select o_custkey, o_orderkey, round(s, 2) spent_so_far, (s > 2000000 or (n >= 5 and s + (20 - n) * (s / n) > 2000000)) stops from o""")
def budget_stop(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    b = sampling.budget_stop(o, ["o_orderkey"], "o_totalprice", 20, 2_000_000.0, by=["o_custkey"])
    return b.select("o_custkey", "o_orderkey", F.round("spent_so_far", 2).alias("spent_so_far"), "stops")


@query(f"with g as (select *, {_VOLUME} volume from ({_GRANULES})) select volume, min(date_issued) first_date, max(date_issued) last_date from g where granule_class = 'PUBLICLAW' and date_issued is not null group by 1")
def volume_dates(spark: SparkSession, d: str) -> DataFrame:
    return sampling.volume_dates(_granules(spark, d))


@query(f"select volume, {_ERA} era, {_PERIOD} period, volume <= 116 scanned, case when volume <= 116 then 'scanned' else 'digital' end default_profile from (select distinct volume from page_items where volume is not null)")
def volume_buckets(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "page_items").select("volume").where("volume is not null").distinct()
    c = F.col("volume")
    return v.select("volume", ids.era(c).alias("era"), ids.period(c).alias("period"), ids.is_scanned(c).alias("scanned"), ids.default_profile(c).alias("default_profile"))


# ---- text


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_FROM, _TO = "".join(text.QUOTES | text.DASHES), "".join((text.QUOTES | text.DASHES).values())


def _sql_normal(c: str) -> str:
    blank = r"[ \t\n\x0B\f\r]"
    steps = [(f"([\\p{{L}}\\p{{N}}_])-{blank}*\\n{blank}*([\\p{{L}}\\p{{N}}_])", r"\1\2"), (r"[ \t\r\f\x0B\x{A0}]+", " "), (f"{blank}*\\n{blank}*", " "), (f"{blank}+([,.;:)\\]])", r"\1"), (f"([(\\[]){blank}+", r"\1")]
    out = f"translate(replace({c}, chr(173), ''), {_quote(_FROM)}, {_quote(_TO)})"
    for p, r in steps:
        out = f"regexp_replace({out}, {_quote(p)}, {_quote(r)}, 'g')"
    return f"trim({out})"


@query(f"select doc_id, {_sql_normal('text')} normal from documents")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.normalize(F.col("text"), compose=False).alias("normal"))


@query()
def normalize_composed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.normalize(F.col("text")).alias("normal"))


_TOKENS = r"'[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]'"


@query(f"select doc_id, len(regexp_extract_all(text, {_TOKENS}))::int tokens, len(list_distinct(regexp_extract_all(lower(text), {_TOKENS})))::int kinds from documents")
def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(text.tokens(F.col("text"))).alias("tokens"), F.size(F.array_distinct(text.tokens(F.lower("text")))).alias("kinds")).withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in ("tokens", "kinds")})


_PAIRS = "pairs as (select distinct item_id, volume, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') a, regexp_replace(orig, '[^\\x00-\\x7F]', '?', 'g') b from page_items where text is not null and orig is not null)"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Both readings of each line, other than ASCII characters as `?`, so that both engines count alike."""
    plain = lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", "?")
    return table(spark, d, "page_items").where("text is not null and orig is not null").select("item_id", "volume", plain("text").alias("a"), plain("orig").alias("b")).distinct()


@query(f"with {_PAIRS} select item_id, round(case when b = '' then (a <> '')::int::double else levenshtein(b, a) / length(b) end, 6) cer from pairs")
def character_errors(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("item_id", F.round(fuzzy.cer(F.col("b"), F.col("a")), 6).alias("cer"))


@query()
def word_errors(spark: SparkSession, d: str) -> DataFrame:
    """Word error rates of the readings as they are."""
    both = table(spark, d, "page_items").where("text is not null and orig is not null").select("item_id", "text", "orig").distinct()
    return both.select("item_id", F.round(fuzzy.wer(F.col("orig"), F.col("text")), 6).alias("wer"))


@query(f"""
with {_PAIRS}, s as (select {_PERIOD} period, levenshtein(b, a) / length(b) cer from pairs where b <> '')
select coalesce(period, case when grouping(period) = 1 then 'all' end) period, count(*) pages, count(cer) scored, count(*) - count(cer) missing, round(avg(cer), 6) mean_cer, round(median(cer), 6) median_cer from s group by grouping sets ((period), ())""")
def error_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _pairs(spark, d).where("b <> ''").select(ids.period(F.col("volume")).alias("period"), fuzzy.cer(F.col("b"), F.col("a")).alias("cer"), F.lit(None).cast("double").alias("sidenote_cer"))
    return report.summarize_scores(s).select("period", "pages", "scored", "missing", F.round("mean_cer", 6).alias("mean_cer"), F.round("median_cer", 6).alias("median_cer"))


@query(f"""
with {_PAIRS}, t as (select item_id, list_distinct(regexp_extract_all(b, {_TOKENS})) r, list_distinct(regexp_extract_all(a, {_TOKENS})) h from pairs),
n as (select item_id, len(r) nr, len(h) nh, len(list_intersect(r, h)) m from t),
q as (select *, case when nh > 0 then m / nh when nr = 0 then 1.0 else 0.0 end p, case when nr > 0 then m / nr when nh = 0 then 1.0 else 0.0 end r from n)
select item_id, nr::int reference, nh::int hypothesis, m::int matched, round(case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end, 3) f1 from q""")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    o = _pairs(spark, d).select("item_id", F.array(fuzzy.set_overlap(text.tokens(F.col("b")), text.tokens(F.col("a")))).alias("o"))
    return o.select("item_id", F.inline("o")).select("item_id", "reference", "hypothesis", "matched", F.round("f1", 3).alias("f1"))


_HEADING = r"'(?s)^([A-Z][A-Z0-9 ,;''’\-]{2,}?)\.\s*[-—–]+\s*(.*)$'"
_CONTENT = "coalesce(text, orig)"


@query(f"""
with c as (select distinct item_id, regexp_extract(coalesce(text, orig), '(?s)^\\([a-z]\\) (.*)$', 1) c from page_items) select item_id, case when regexp_matches(c, {_HEADING}) then trim(regexp_extract(c, {_HEADING}, 1)) || '.' end heading, case when regexp_matches(c, {_HEADING}) then trim(regexp_extract(c, {_HEADING}, 2)) else c end "text" from c where c <> ''""")
def split_headings(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "page_items").select("item_id", F.regexp_extract(F.coalesce("text", "orig"), r"(?s)^\([a-z]\) (.*)$", 1).alias("c")).where("c <> ''").distinct()
    return c.select("item_id", ids.split_heading(F.col("c")).alias("h")).select("item_id", "h.heading", "h.text")


@query("select package_id, date_issued, day(date_issued) || case when day(date_issued) % 100 between 10 and 20 then 'th' when day(date_issued) % 10 = 1 then 'st' when day(date_issued) % 10 = 2 then 'nd' when day(date_issued) % 10 = 3 then 'rd' else 'th' end day_name from (select distinct package_id, date_issued from packages where date_issued is not null)")
def long_dates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "packages").select("package_id", "date_issued").where("date_issued is not null").distinct()
    spoken = p.withColumn("said", F.date_format("date_issued", "MMMM d, yyyy"))
    return spoken.select("package_id", ids.us_date(F.col("said")).alias("date_issued"), ids.ordinal(F.dayofmonth("date_issued")).alias("day_name"))


@query()
def largest_differences(spark: SparkSession, d: str) -> DataFrame:
    """The three largest differences between each line and the next of its granule."""
    from pyspark.sql.window import Window

    lines = table(spark, d, "page_items").select("item_id", "granule_id", "page_no", "item_no", F.coalesce("text", "orig").alias("a")).distinct()
    following = F.lead("a").over(Window.partitionBy("granule_id").orderBy("page_no", "item_no", "item_id"))
    seg = lines.withColumn("b", following).select("item_id", fuzzy.align(F.col("a"), F.col("b")).alias("s"))
    return seg.select("item_id", F.inline(fuzzy.largest_differences(F.col("s"), 3)))


# ---- layout

_HEADS = " or ".join(f"regexp_matches(text, {_quote(p)})" for p in markers.HEADS)
_ITEMS = "i as (select distinct item_id, granule_id, page_no page, item_no pos, label, coalesce(text, orig) text, l, t, r, b, 612.0::double w, 792.0::double h from page_items)"


def _items(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_items").select("item_id", "granule_id", F.col("page_no").alias("page"), F.col("item_no").alias("pos"), "label", F.coalesce("text", "orig").alias("text"), "l", "t", "r", "b")
    return p.distinct().withColumn("width", F.lit(612.0)).withColumn("height", F.lit(792.0))


@query(f"""
with {_ITEMS}, m as (select granule_id, page, list_sort(list(l) filter ((r - l) > 0.4::double * w)) ls, list_sort(list(r) filter ((r - l) > 0.4::double * w)) rs from i group by 1, 2),
e as (select i.*, coalesce(ls[len(ls) // 2 + 1], 0.15::double * w) ml, coalesce(rs[len(rs) // 2 + 1], 0.85::double * w) mr from i join m on i.granule_id is not distinct from m.granule_id and i.page is not distinct from m.page),
k as (select *, case when t < 0.06::double * h or regexp_matches(text, {_quote(markers.PRINT_CODE)}) then 'footer'
  when b > 0.93::double * h and (regexp_matches(text, {_quote(markers.HEAD_STAT)}) or regexp_matches(text, {_quote(markers.PUBLIC_LAW)}) or regexp_matches(text, {_quote(markers.PRIVATE_LAW)}) or regexp_matches(text, {_quote(markers.PAGE_NUMBER)}) or length(text) < 60) then 'header'
  when r <= ml + 0.02::double * w or l >= mr - 0.02::double * w then 'sidenote' when (r - l) < 0.25::double * w and l > mr - 0.3::double * w and l > 0.6::double * w then 'sidenote' else 'body' end kind,
  row_number() over (partition by granule_id, page order by -round_even(t / 4, 0), l, pos) rank from e)
select item_id, case when rank <= 3 and kind = 'body' and length(text) < 80 and ({_HEADS}) then 'header' else kind end kind, rank::int rank from k""")
def classify_items(spark: SparkSession, d: str) -> DataFrame:
    return layout.classify_items(_items(spark, d)).select("item_id", "kind", "rank")


@query(f"with {_ITEMS} select distinct item_id from i where length(text) < 80 and ({_HEADS})")
def running_heads(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where(markers.is_running_head(F.col("text"))).select("item_id").distinct()


@query()
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    return layout.page_texts(layout.classify_items(_items(spark, d)))


@query()
def layout_items(spark: SparkSession, d: str) -> DataFrame:
    newest = shred.decoded(table(spark, d, "layout_docs"), "granule_id", "payload", "fetched_at")
    return layout.classify_items(layout.layout_items(newest, "granule_id", "payload")).select("granule_id", "pos", "page", "label", "kind", "rank", "l", "text")


@query()
def built_documents(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.operators.build import build_documents

    g = _granules(spark, d).select("granule_id", catalog.identity_of_granule({c: F.col(c) for c in ("granule_class", "number", "congress", "package_id", "page_start", "granule_id", "date_issued", "title")}).alias("identity"))
    return build_documents(layout.classify_items(_items(spark, d).where("granule_id is not null").withColumn("cells", F.lit(None).cast("array<array<string>>"))), g).withColumn("warnings", F.size("warnings"))


@query()
def compared_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents built from both readings of the lines, compared. A line that one reading lacks differs; a document that one reading lacks is empty there."""
    pair = _both_readings(spark, d, F.col("text")).withColumns({c: F.coalesce(c, F.lit(f'<lawDoc xmlns="{xml.USLM}"/>')) for c in ("reference", "generated")})
    out = metrics.compare(pair, "reference", "generated")
    return out.select("granule_id", F.round("cer", 6).alias("cer"), F.round("wer", 6).alias("wer"), F.round("equal_ratio", 6).alias("equal_ratio"), "clip_found", F.col("section_match.recall").alias("section_recall"), F.col("identifier_overlap.f1").alias("id_f1"), F.size("diffs").alias("diffs"))


def _both_readings(spark: SparkSession, d: str, generated: Column) -> DataFrame:
    """Documents of all lines with orig (`reference`) and of all with the `generated` text; NULL for a granule without such lines. Both are built in one pass, from one scan."""
    from lexmill.operators.build import build_documents

    readings = F.array(*[F.struct(F.lit(n).alias("reading"), c.alias("text")) for n, c in (("reference", F.col("orig")), ("generated", generated))])
    document = F.concat_ws(":", "reading", "granule_id").alias("document")
    lines = table(spark, d, "page_items").where("granule_id is not null").select("item_id", "granule_id", F.col("page_no").alias("page"), F.col("item_no").alias("pos"), "label", "l", "t", "r", "b", F.inline(readings)).where("text is not null")
    p = lines.select(document, "item_id", "page", "pos", "label", "text", "l", "t", "r", "b").distinct().withColumn("width", F.lit(612.0)).withColumn("height", F.lit(792.0)).withColumn("cells", F.lit(None).cast("array<array<string>>"))
    who = catalog.identity_of_granule({c: F.col(c) for c in ("granule_class", "number", "congress", "package_id", "page_start", "granule_id", "date_issued", "title")})
    g = _granules(spark, d).select("granule_id", who.alias("identity"), F.explode(F.array(F.lit("reference"), F.lit("generated"))).alias("reading")).select(document, "identity")
    built = build_documents(layout.classify_items(p, "document"), g, "document").select(F.substring_index("document", ":", 1).alias("reading"), F.expr("substring(document, locate(':', document) + 1)").alias("granule_id"), "xml")
    return built.groupBy("granule_id").agg(*[F.max(F.when(F.col("reading") == n, F.col("xml"))).alias(n) for n in ("reference", "generated")])


@query()
def hybrid_documents(spark: SparkSession, d: str) -> DataFrame:
    """The structure of the documents built from orig with the words of every line's content: text, else orig."""
    from lexmill.operators.hybrid import hybrids

    who = F.struct(F.lit(None).cast("int").alias("congress"), F.lit(None).cast("int").alias("law_number"), F.lit(False).alias("is_private"), ids.granule_volume(F.col("granule_id")).alias("volume"), F.lit(None).cast("string").alias("date_issued"), F.lit(None).cast("string").alias("chapter"))
    pair = _both_readings(spark, d, F.coalesce("text", "orig")).select("granule_id", F.col("reference").alias("publisher_xml"), F.col("generated").alias("candidate_xml"), who.alias("identity"))
    return hybrids(pair, "granule_id").withColumn("warnings", F.size("warnings"))


# ---- sequences and reports


@query("select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) last_signup from events")
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return report.forward_fill(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "last_signup").select("event_id", "last_signup")


@query("""
with s as (select event_id, user_id, ts, case when lag(event_type) over w is not distinct from event_type and row_number() over w > 1 then 0 else 1 end s from events window w as (partition by user_id order by ts, event_id))
select event_id, sum(s) over (partition by user_id order by ts, event_id rows unbounded preceding)::bigint run from s""")
def number_runs(spark: SparkSession, d: str) -> DataFrame:
    return report.number_runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type")).select("event_id", "run")


@query("""
with i as (select distinct granule_id, page_no, item_no pos, coalesce(label, 'body') "role", coalesce(text, orig) "text", item_id, item_no % 3 = 0 starts from page_items),
r as (select * from i where trim(coalesce("text", '')) <> ''),
o as (select *, case when starts or row_number() over (partition by granule_id, page_no, "role" order by pos) = 1 then 1 else 0 end o from r),
g as (select *, sum(o) over (partition by granule_id, page_no, "role" order by pos rows unbounded preceding) item from o)
select granule_id, page_no, "role", min(pos) first_pos, string_agg("text", chr(10) order by pos, "text") "text", count(*) lines from g group by granule_id, page_no, "role", item""")
def merge_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "page_items").select("granule_id", "page_no", F.col("item_no").alias("pos"), F.coalesce("label", F.lit("body")).alias("role"), F.coalesce("text", "orig").alias("text"), "item_id").distinct()
    return report.merge_paragraphs(i.withColumn("starts_paragraph", F.col("pos") % 3 == 0), ["granule_id", "page_no"])


_RUNS = "b as (select l_returnflag profile, l_linestatus tier, year(l_shipdate)::varchar era, l_discount cer, l_tax wer, case when l_linenumber > 5 then null else l_quantity end section_recall, l_tax id_f1, case when l_linenumber = 1 then 'both' else 'none' end clip, l_discount kept_ratio, l_linenumber = 2 xsd_valid, l_quantity as seconds, l_linenumber pages, case when l_linenumber = 3 then l_quantity end judge from lineitem)"
_STATS = "count(*) n, round(avg(cer), 6) mean_cer, round(median(cer), 6) median_cer, round(avg(wer), 6) mean_wer, round(avg(section_recall), 6) section_recall, round(avg(id_f1), 6) id_f1, count(*) filter (clip = 'both') clip_both, min(kept_ratio) kept_ratio, count(*) filter (xsd_valid) xsd_valid, round(sum(seconds) filter (seconds <> 0) / sum(pages) filter (pages <> 0), 6) seconds_per_page, count(judge) judged, round(avg(judge), 6) judge_mean"


@query(f"with {_RUNS} select case when grouping(profile) = 1 then 'all' else profile end profile, case when grouping(tier) = 1 then 'all' else tier end tier, era, {_STATS} from b group by grouping sets ((profile, tier, era), (era))")
def run_matrix(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    n = F.col("l_linenumber")
    b = li.select(
        F.col("l_returnflag").alias("profile"), F.col("l_linestatus").alias("tier"), F.year("l_shipdate").cast("string").alias("era"), F.col("l_discount").alias("cer"), F.col("l_tax").alias("wer"), F.when(n <= 5, F.col("l_quantity")).alias("section_recall"),
        F.col("l_tax").alias("id_f1"), F.when(n == 1, "both").otherwise("none").alias("clip"), F.col("l_discount").alias("kept_ratio"), (n == 2).alias("xsd_valid"), F.col("l_quantity").alias("seconds"), n.alias("pages"), F.when(n == 3, F.col("l_quantity")).alias("judge"),
    )
    m = report.run_matrix(b)
    rounded = ["mean_cer", "median_cer", "mean_wer", "section_recall", "id_f1", "seconds_per_page", "judge_mean"]
    return m.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in m.columns])


@query("""
with t as (select distinct * from unit_results) select split_part(profile, ':', 1) variant, profile engine, 'B' tier, '?' era, count(*) units, coalesce(sum(pages) filter (status <> 'failed'), 0)::bigint pages,
  round(sum(seconds) filter (status <> 'failed') / nullif(sum(pages) filter (status <> 'failed'), 0), 6) wall_per_page, count(*) filter (status = 'failed') failed from t group by 1, 2""")
def timing_notes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "unit_results").distinct()
    null = F.lit(None)
    t = t.select(
        ids.profile_family(F.col("profile")).alias("variant"), F.col("profile").alias("engine"), null.cast("string").alias("tier"), null.cast("string").alias("era"), "status", "pages", "seconds", null.cast("double").alias("model_seconds"), null.cast("bigint").alias("tokens"),
        null.cast("array<struct<page:int,seconds:double,tokens:bigint,stop_reason:string>>").alias("page_times"), null.cast("bigint").alias("max_new_tokens"), null.cast("bigint").alias("synthesized"), null.cast("string").alias("host"),
    )
    return report.timing_notes(t).select("variant", "engine", "tier", "era", "units", "pages", F.round("wall_per_page", 6).alias("wall_per_page"), "failed")


@query("with t as (select distinct * from unit_results) select count(*) filter (status = 'success') success, count(*) filter (status = 'skipped') skipped, count(*) filter (status = 'failed') failed, count(*) filter (status = 'success' and not xsd_valid) invalid from t")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.status_counts(table(spark, d, "unit_results").distinct())


@query("""
with s as (select g.granule_id, max(s.slice_id) reference, bool_or(s.matched) converted, case when g.granule_class is null then 'no class' end unpaired from (select * from granules qualify row_number() over (partition by granule_id order by updated_at desc) = 1) g
  left join slices s on s.granule_id = g.granule_id group by g.granule_id, g.granule_class)
select granule_id, case when unpaired is not null then 'skipped' when reference is null or not coalesce(converted, false) then 'failed' else 'scored' end status,
  case when unpaired is not null then 'no one-to-one reference (' || unpaired || ')' when reference is null then 'no reference slice' when not coalesce(converted, false) then 'not converted' end reason from s""")
def route_pairs(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "slices").groupBy("granule_id").agg(F.max("slice_id").alias("reference"), F.bool_or("matched").alias("converted"))
    w = _granules(spark, d).select("granule_id", F.when(F.col("granule_class").isNull(), "no class").alias("unpaired_reason")).join(s, "granule_id", "left")
    return report.route_pairs(w).select("granule_id", "status", "reason")


@query("""
with t as (select distinct * from unit_results) select unit_id, coalesce(max(case when profile = 'digital' then status end), null) digital, max(case when profile = 'scanned' then status end) scanned, max(case when profile = 'vlm:small' then status end) "vlm:small" from t
where profile in ('digital', 'scanned', 'vlm:small') group by 1""")
def pivoted_status(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "unit_results").where(F.col("profile").isin("digital", "scanned", "vlm:small"))
    return t.groupBy("unit_id").pivot("profile", ["digital", "scanned", "vlm:small"]).agg(F.max("status"))


#: The profiles of unit_results; others, with an input's tag (`digital@clean`) too, go to `rest`.
PROFILES = ["digital", "scanned", "scanned:psm6", "tesseract:psm4", "vlm:small", "vlm:large", "hybrid:scanned"]


@query(f"""
with t as (select unit_id, profile, max(status) status from unit_results group by 1, 2), r as (select *, coalesce(profile, '?') || '=' || coalesce(status, '?') said from t)
select unit_id, {", ".join(f"""max(case when profile = '{p}' then status end) "{p}" """ for p in PROFILES)},
  string_agg(said, '; ' order by said) filter (profile is null or profile not in ({", ".join(f"'{p}'" for p in PROFILES)})) rest from r group by 1""")
def pivoted_status_all(spark: SparkSession, d: str) -> DataFrame:
    """A row for every unit with its status under each profile; under any other one as `profile=status` in `rest`. pivoted_status has three of the profiles, as its SQL does."""
    t = table(spark, d, "unit_results").groupBy("unit_id", "profile").agg(F.max("status").alias("status"))
    other = ~F.coalesce(F.col("profile").isin(PROFILES), F.lit(False))
    said = F.concat_ws("=", F.coalesce("profile", F.lit("?")), F.coalesce("status", F.lit("?")))
    rest = F.array_join(F.array_sort(F.collect_list(F.when(other, said))), "; ")
    return t.groupBy("unit_id").agg(*[F.max(F.when(F.col("profile") == p, F.col("status"))).alias(p) for p in PROFILES], F.when(rest != "", rest).alias("rest"))


@query("select l_returnflag, l_linestatus, round(avg(l_discount), 4) mean_cer, '| ' || l_returnflag || ' | ' || l_linestatus || ' | ' || printf('%.3f', round(avg(l_discount), 4)) || ' |' \"row\" from lineitem group by 1, 2")
def markdown_report(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.avg("l_discount"), 4).alias("mean_cer"))
    return report.markdown_rows(g, {"mean_cer": 3})


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) k from events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""
with t as (select distinct result_id, coalesce(seconds, 0) as seconds, coalesce(pages, 0) pages, status = 'success' ok from unit_results)
select count(*) pages, round(sum(case when ok then seconds else 0 end), 2) as seconds, round(sum(round(0.8 * case when ok then seconds else 0 end / 3600, 4)), 4) cost from t""")
def machine_cost(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.functions.costs import machine_cost as cost

    t = table(spark, d, "unit_results").select("result_id", F.coalesce("seconds", F.lit(0.0)).alias("seconds"), "status", "pages").distinct()
    used = F.when(F.col("status") == "success", F.col("seconds")).otherwise(0.0)
    return t.agg(F.count("*").alias("pages"), F.round(F.sum(used), 2).alias("seconds"), F.round(F.sum(cost(F.lit(0.8), used)), 4).alias("cost"))


@query()
def streamed_status(spark: SparkSession, d: str) -> DataFrame:
    """Latest status per unit, folded from a stream of the result files; the same rows as latest_status over the table, once the stream has ended."""
    import uuid

    from lexmill.session import ensure_checkpoint_dir
    from lexmill.streaming.sync import incoming, latest_status

    name = f"status_{uuid.uuid4().hex}"
    schema = table(spark, d, "unit_results").schema
    folder = f"{ensure_checkpoint_dir(spark)}/{name}"
    out = latest_status(incoming(spark, f"{d}/unit_results.parque[t]", schema))

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    return latest(rows, ["unit_id"], ["batch"], ["status", "finished_at", "attempts"])


# ---- more sequences, ranges and rates


@query("""
with l as (select distinct granule_id, page_no, item_no, item_id, regexp_matches(coalesce(text, orig), '(?i)^(sec(tion)?[.]? ?[0-9]|an act|joint resolution|a proclamation)') m from page_items where granule_id is not null),
b as (select *, m and not coalesce(lag(m) over (partition by granule_id order by page_no, item_no, item_id), false) b from l),
n as (select *, sum(b::int) over (partition by granule_id order by page_no, item_no, item_id rows unbounded preceding) run from b) select item_id, run::bigint run from n where b""")
def marker_runs(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "page_items").where("granule_id is not null").select("granule_id", "page_no", "item_no", "item_id", F.coalesce("text", "orig").alias("text")).distinct()
    marker = F.col("text").rlike(r"(?i)^(sec(tion)?[.]? ?[0-9]|an act|joint resolution|a proclamation)")
    return layout.marker_runs(lines, "granule_id", ["page_no", "item_no", "item_id"], marker).select("item_id", "run")


@query("""
with l as (select distinct granule_id, page_no, item_no, item_id, coalesce(text, orig) t from page_items where granule_id is not null), m as (select *, t like '%.' m from l),
n as (select *, sum(m::int) over w n from m window w as (partition by granule_id order by page_no, item_no, item_id rows unbounded preceding)),
a as (select *, lag(case when m then n end) over (partition by granule_id order by page_no, item_no, item_id) k from n) select item_id from a where k = 2""")
def after_second_ending(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "page_items").where("granule_id is not null").select("granule_id", "page_no", "item_no", "item_id", F.coalesce("text", "orig").alias("text")).distinct()
    return layout.after_markers(lines, "granule_id", ["page_no", "item_no", "item_id"], F.col("text").endswith("."), F.lit(2)).select("item_id")


@query("""
with i as (select distinct item_id, granule_id, page_no page, item_no pos from page_items where granule_id is not null and page_no is not null),
s as (select *, row_number() over (partition by granule_id, page order by pos, item_id) - 1 n, 0.87::double * 792 / count(*) over (partition by granule_id, page) slot from i)
select item_id, round(0.95::double * 792 - n * slot, 4) t, round(0.95::double * 792 - n * slot - slot, 4) b from s""")
def filled_geometry(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "page_items").where("granule_id is not null and page_no is not null").select("item_id", "granule_id", F.col("page_no").alias("page"), F.struct("item_no", "item_id").alias("pos")).distinct()
    zero = i.select("*", *[F.lit(0.0).alias(c) for c in "ltrb"], F.lit(612.0).alias("width"), F.lit(792.0).alias("height"))
    return layout.fill_geometry(zero).select("item_id", F.round("t", 4).alias("t"), F.round("b", 4).alias("b"))


@query("""
with f as (select distinct hub_path, size, size % 5 k from hub_entries where size is not null) select hub_path, case when k = 0 then 'missing' when k = 1 then 'complete' when k = 2 then 'oversize' else 'partial' end status from f""")
def part_status(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "hub_entries").where("size is not null").select("hub_path", "size").distinct()
    k = F.col("size") % 5
    got = F.when(k == 0, F.lit(None).cast("bigint")).when(k == 1, F.col("size")).when(k == 2, F.col("size") + 1).otherwise(F.col("size") - 1)
    return f.select("hub_path", ids.part_status(got, F.col("size")).alias("status"))


@query("""
with a as (select distinct user_id congress, event_id number, event_type <> 'click' found from events),
r as (select *, sum(case when not found then 1 else 0 end) over (partition by congress order by number rows between 2 preceding and current row) run from a)
select congress, min(number) - 3 + 1 ends_at from r where run = 3 group by 1""")
def gap_end(spark: SparkSession, d: str) -> DataFrame:
    return catalog.gap_end(table(spark, d, "events").select(F.col("user_id").alias("congress"), F.col("event_id").alias("number"), (F.col("event_type") != "click").alias("found")).distinct())


@query("""
with t as (select distinct result_id, profile, coalesce(pages, 0) pages, coalesce(seconds, 0) as seconds from unit_results)
select count(*) pages, sum(pages)::bigint input_tokens, sum(result_id)::bigint output_tokens, round(sum(pages) * 0.001, 6) cost, round(sum(pages) * 0.001 / count(*), 6) cost_per_page, round(sum(seconds) / count(*), 6) seconds_per_page from t""")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "unit_results").select("result_id", "profile", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("seconds", F.lit(0.0)).alias("seconds")).distinct()
    u = report.usage_totals(t.select(F.col("pages").alias("input_tokens"), F.col("result_id").alias("output_tokens"), (F.col("pages") * 0.001).alias("cost"), "seconds"))
    return u.select("pages", "input_tokens", "output_tokens", *[F.round(c, 6).alias(c) for c in ("cost", "cost_per_page", "seconds_per_page")])


@query("""
with t as (select distinct result_id, profile, pages from unit_results where pages is not null)
select result_id, round((pages * 1000 * case profile when 'vlm:small' then 1.0 when 'vlm:large' then 10.0 else 3.0 end + 500 * case profile when 'vlm:small' then 5.0 when 'vlm:large' then 50.0 else 15.0 end) / 1000000, 6) cost from t""")
def model_costs(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.functions.costs import usage_cost

    prices = {"vlm:small": (1.0, 5.0, 0.1, 1.25), "vlm:large": (10.0, 50.0, 1.0, 12.5), "other": (3.0, 15.0, 0.3, 3.75)}
    t = table(spark, d, "unit_results").where("pages is not null").select("result_id", "profile", "pages").distinct()
    return t.select("result_id", F.round(usage_cost(F.col("profile"), F.col("pages") * 1000, F.lit(500), F.lit(None).cast("int"), F.lit(None).cast("int"), prices, "other"), 6).alias("cost"))


@query("""
with p as (select distinct granule_id, page_no pdf_page from page_items where granule_id is not null and page_no is not null), t as (select distinct granule_id, page_start pdf_page, title body from granules qualify row_number() over (partition by granule_id order by updated_at desc) = 1),
h as (select distinct granule_id from t) select p.granule_id, p.pdf_page, case when t.granule_id is not null then 'text' when h.granule_id is not null then 'page missing' else 'no output' end source from p left join t on t.granule_id = p.granule_id and t.pdf_page = p.pdf_page left join h on h.granule_id = p.granule_id""")
def candidate_texts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_items").where("granule_id is not null and page_no is not null").select("granule_id", F.col("page_no").alias("pdf_page")).distinct()
    t = _granules(spark, d).select("granule_id", F.col("page_start").alias("pdf_page"), F.col("title").alias("body"), F.lit("").alias("sidenote"))
    return report.candidate_texts(p, t).select("granule_id", "pdf_page", "source")


@query("""
with a as (select distinct granule_id from granules), b as (select distinct granule_id from slices where granule_id is not null)
select granule_id, 'no slice' reason from a where granule_id not in (select granule_id from b) union all select granule_id, 'slice without a listed granule' from b where granule_id not in (select granule_id from a)""")
def unpaired_slices(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.operators.split import unpaired

    listing = table(spark, d, "granules").select(F.lit(0).alias("volume"), "granule_id", F.lit(None).cast("string").alias("granule_class")).distinct()
    cut = table(spark, d, "slices").where("granule_id is not null").select(F.lit(0).alias("volume"), "granule_id", F.lit(None).cast("string").alias("granule_class")).distinct()
    return unpaired(cut, listing).select("granule_id", "reason")


@query("select doc_id, sha256(text) sha256 from documents where text is not null")
def content_digests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
