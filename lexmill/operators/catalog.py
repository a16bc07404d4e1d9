"""The package and granule ledger: upserts, file decisions, reconciliation, summaries to rows, metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import ids
from lexmill.functions.text import strip
from lexmill.session import latest

# ---- upserts: a table with one row per key and a batch of new rows with one row per key

OVERWRITE, COALESCE, KEEP = "overwrite", "coalesce", "keep"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], policy: dict[str, str] | str = OVERWRITE) -> DataFrame:
    """The target with the source's rows merged in, by a full outer join.

    A matched row's column is overwritten (also with NULL), coalesced (NULL keeps the old value) or kept, as the policy says per column;
    columns the source lacks are kept. New keys are inserted as they are.
    """
    rules = {c: policy for c in target.columns} if isinstance(policy, str) else policy
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    on = reduce(Column.__and__, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    both = t.join(s, on, "full_outer")
    is_new, touched = F.col("t._t").isNull(), F.col("s._s").isNotNull()

    def merged(c: str) -> Column:
        if c in keys:
            return F.when(touched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if c not in source.columns:
            return F.col(f"t.{c}")
        rule = rules.get(c, OVERWRITE)
        value = {OVERWRITE: F.col(f"s.{c}"), COALESCE: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")), KEEP: F.col(f"t.{c}")}[rule]
        return F.when(is_new, F.col(f"s.{c}")).when(touched, value).otherwise(F.col(f"t.{c}"))

    return both.select(*[merged(c).alias(c) for c in target.columns])


def replace_rows(target: DataFrame, source: DataFrame, key: dict[str, Column]) -> DataFrame:
    """Delete and insert: source rows replace target rows of equal (computed, null-safe) key."""
    keyed = source.select(*[e.alias(f"_k{i}") for i, e in enumerate(key.values())]).distinct()
    on = reduce(Column.__and__, [e.eqNullSafe(F.col(f"_k{i}")) for i, e in enumerate(key.values())])
    return target.join(keyed, on, "left_anti").unionByName(source)


def conversion_key(granule: Column, package: Column, page_range: Column, module: Column) -> dict[str, Column]:
    return {"document": F.coalesce(granule, package), "page_range": F.coalesce(page_range, F.lit("")), "module": module}


def latest_conversions(conversions: DataFrame, keep: Sequence[str], order: str = "conversion_date") -> DataFrame:
    """The newest row per document, page range and module."""
    return latest(conversions, conversion_key(*[F.col(c) for c in ("granule_id", "package_id", "page_range", "module_used")]), [order], list(keep))


def apply_file_events(packages: DataFrame, events: DataFrame, key: str, order: str, columns: Sequence[str], clear: dict[str, str] | None = None) -> DataFrame:
    """Partial updates: each column takes its latest non-NULL value of the events, else what it had. `clear` maps a column to a
    BOOLEAN event column that empties it, unless a later event sets it again."""
    clear = clear or {}

    def last_set(c: str) -> Column:
        sets = F.col(c).isNotNull() | F.coalesce(F.col(clear[c]), F.lit(False)) if c in clear else F.col(c).isNotNull()
        return F.max(F.when(sets, F.struct(F.col(order).alias("o"), F.col(c).alias("v")))).alias(c)

    done = events.groupBy(key).agg(*[last_set(c) for c in columns])
    p, e = packages.alias("p"), done.alias("e")
    value = {c: F.when(F.col(f"e.{c}").isNotNull(), F.col(f"e.{c}.v")).otherwise(F.col(f"p.{c}")) for c in columns}
    return p.join(e, F.col(f"p.{key}") == F.col(f"e.{key}"), "left").select(*[value.get(c, F.col(f"p.{c}")).alias(c) for c in packages.columns])


def apply_migrations(available: list[str], applied: list[str]) -> list[str]:
    """Migrations to run, of files `NNN_name.sql`: in order, each once; gaps, duplicates and other names are errors."""
    import re

    numbers = []
    for name in sorted(available):
        if not (m := re.fullmatch(r"(\d{3})_[a-z0-9_]+\.sql", name)):
            raise ValueError(f"not a migration: {name}")
        numbers.append(int(m[1]))
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError(f"migrations are not numbered from 1 without gaps: {numbers}")
    return [name for name in sorted(available) if name not in set(applied)]


def memo_hits(work: DataFrame, memo: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work whose result is recorded under the same keys (with the digest as one of them)."""
    return work.join(memo.select(*keys).distinct(), list(keys), "left_semi")


def skippable(outputs_exist: Column, status: Column, previous_sha: Column, sha: Column, force: bool = False) -> Column:
    """Whether a unit needs no conversion: outputs there, last attempt a success on the same input, not forced."""
    return F.lit(False) if force else F.coalesce(outputs_exist & (status == "success") & (previous_sha == sha), F.lit(False))


# ---- decisions per package


def file_predicates(expected: Column, hub: Column, local: Column) -> dict[str, Column]:
    """State of one file by its sizes (NULL: absent or unknown)."""
    no = F.lit(False)
    complete = F.coalesce(local == expected, no)
    return {
        "on_hub": hub.isNotNull() & F.coalesce(hub == expected, expected.isNull()),
        "hub_mismatch": F.coalesce(hub != expected, no),
        "local_complete": complete,
        "local_partial": local.isNotNull() & ~complete,
    }


def decide(files: DataFrame, upload_enabled: bool = True) -> DataFrame:
    """What to do about each package, of files `package_id, pos, hub_path, expected, hub, local`: `package_id, action, reason`.

    Files without an expected size don't count. Paths in a reason are in listing order (pos).
    """
    state = file_predicates(F.col("expected"), F.col("hub"), F.col("local"))
    known = F.col("expected").isNotNull()
    f = files.select("package_id", "pos", "hub_path", known.alias("known"), *[c.alias(n) for n, c in state.items()])

    def paths(cond: Column) -> Column:
        listed = F.array_sort(F.collect_list(F.when(F.col("known") & cond, F.struct("pos", "hub_path"))))
        return F.array_join(F.transform(listed, lambda x: x["hub_path"]), ", ")

    at_hand = F.col("local_complete") | F.col("on_hub") if upload_enabled else F.col("local_complete")
    per = f.groupBy("package_id").agg(
        F.count_if("known").alias("n"), F.count_if(F.col("known") & F.col("on_hub")).alias("hub"), F.count_if(F.col("known") & at_hand).alias("have"),
        paths(F.col("hub_mismatch")).alias("mismatched"), paths(~at_hand).alias("missing"),
    )
    none, all_have = F.col("n") == 0, F.col("have") == F.col("n")
    if not upload_enabled:
        action = F.when(none | all_have, "skip").otherwise("download")
        reason = F.when(all_have, "complete locally (uploads disabled)").otherwise(F.concat(F.lit("missing or incomplete locally: "), "missing"))
    else:
        all_hub = F.col("hub") == F.col("n")
        action = F.when(none | all_hub, "skip").when(all_have, "upload-only").otherwise("download")
        bad = F.when(F.col("mismatched") != "", F.concat(F.lit("Hub size mismatch for "), "mismatched", F.lit("; "))).otherwise("")
        plain = F.when(F.col("mismatched") != "", "complete locally").otherwise("complete locally, missing from Hub")
        reason = F.when(all_hub, "on Hub with matching sizes").when(all_have, F.concat(bad, plain)).otherwise(F.concat(bad, F.lit("missing or incomplete: "), "missing"))
    return per.select("package_id", action.alias("action"), F.when(none, "no files are listed for this package").otherwise(reason).alias("reason"))


# ---- reconciliation

CATEGORIES = ["local-only", "hub-only", "size-mismatch", "missing"]


def reconcile(files: DataFrame) -> DataFrame:
    """Differences of files `package_id, path, expected, hub, local`: `package_id, path, category, detail`; a file can have two."""
    expected, hub, local = F.col("expected"), F.col("hub"), F.col("local")

    def entry(cond: Column, category: str, detail: Column) -> Column:
        return F.when(cond, F.struct(F.lit(category).alias("category"), detail.alias("detail")))

    off = F.coalesce(local != expected, F.lit(True))
    found = F.array_compact(F.array(
        entry(hub != expected, "size-mismatch", F.format_string("Hub %d, expected %d", hub, expected)),
        entry(local != expected, "size-mismatch", F.format_string("local %d, expected %d", local, expected)),
        entry(hub.isNull() & ~off, "local-only", F.format_string("%d bytes", expected)),
        entry(hub.isNull() & off, "missing", F.lit("not on Hub, not complete locally")),
    ))
    return files.where(expected.isNotNull()).select("package_id", "path", F.inline(found))


def hub_only(hub: DataFrame, packages: DataFrame, folders: Sequence[str] = ("pdfs/", "xmls/")) -> DataFrame:
    """Hub files in the folders whose package is unknown."""
    inside = reduce(Column.__or__, [F.col("path").startswith(x) for x in folders])
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    mine = hub.where(inside).select(stem.alias("package_id"), "path")
    out = mine.join(packages.select("package_id").distinct(), "package_id", "left_anti")
    return out.select("package_id", "path", F.lit("hub-only").alias("category"), F.lit("no package for this file").alias("detail"))


def category_counts(entries: DataFrame) -> DataFrame:
    """Entries per category, in the fixed order, also where there are none: `pos, category, n`."""
    spark = entries.sparkSession
    names = spark.createDataFrame(list(enumerate(CATEGORIES)), "pos int, category string")
    return names.join(entries.groupBy("category").agg(F.count("*").alias("n")), "category", "left").select("pos", "category", F.coalesce("n", F.lit(0)).alias("n"))


def verify(files: DataFrame) -> DataFrame:
    """Problems of expected files `path, size, sha256, hub_size, hub_sha256` (NULL hub_size: missing): `path, ok, problems`."""
    there = F.col("hub_size").isNotNull()
    problems = F.array_compact(F.array(
        F.when(~there, "missing from Hub"),
        F.when(there & (F.col("hub_size") != F.col("size")), F.format_string("Hub has %d bytes, expected %d", "hub_size", "size")),
        F.when(there & (F.col("hub_sha256") != F.col("sha256")), F.concat(F.lit("Hub sha256 "), F.substring("hub_sha256", 1, 12), F.lit(" != local "), F.substring("sha256", 1, 12))),
    ))
    return files.select("path", (F.size(problems) == 0).alias("ok"), problems.alias("problems"))


def same_content(a: Column, b: Column) -> Column:
    """Whether two binary copies are equal; NULL if either is missing."""
    return F.sha2(a, 256) == F.sha2(b, 256)


# ---- summaries to rows

SUMMARY = (
    "packageId string, collectionCode string, volume string, congress string, session string, dateIssued string, pages string, title string, "
    "download struct<pdfLink:string,uslmLink:string>, "
    "references array<struct<collectionCode:string,contents:array<struct<title:string,pages:array<string>,sections:array<string>>>>>"
)


def parse_summary(payload: Column) -> Column:
    return F.from_json(payload, SUMMARY)


def _statute_contents(s: Column) -> Column:
    """What the summary cites of the collection of statutes, in order."""
    refs = F.filter(F.coalesce(s["references"], F.array().cast("array<struct<collectionCode:string,contents:array<struct<title:string,pages:array<string>,sections:array<string>>>>>")), lambda r: r["collectionCode"] == "STATUTE")
    return F.flatten(F.transform(refs, lambda r: F.coalesce(r["contents"], F.array().cast("array<struct<title:string,pages:array<string>,sections:array<string>>>"))))


def package_row(s: Column) -> list[Column]:
    """Ledger columns of a parsed package summary. A law's volume is that of the last cited statutes entry."""
    collection = F.coalesce(F.nullif(s["collectionCode"], F.lit("")), F.substring_index(s["packageId"], "-", 1))
    cited = F.try_element_at(_statute_contents(s), F.lit(-1))["title"]
    volume = F.coalesce(ids.integer(s["volume"]), F.when(collection == "PLAW", ids.integer(cited)))
    return [
        s["packageId"].alias("package_id"), collection.alias("collection"), volume.alias("volume"), ids.integer(s["congress"]).alias("congress"),
        ids.integer(s["session"]).alias("session"), ids.iso_date(s["dateIssued"]).alias("date_issued"), ids.integer(s["pages"]).alias("pages"), s["title"].alias("title"),
        F.when((collection == "STATUTE") & volume.isNotNull(), ids.is_scanned(volume)).alias("scanned"), s["download"]["pdfLink"].alias("pdf_url"), s["download"]["uslmLink"].alias("xml_url"),
    ]


def law_pages(s: Column) -> Column:
    """Volume and page span of a law, from its summary: the cited entry with as many pages as the law has, else the one with most (the first of equals)."""
    items = F.transform(_statute_contents(s), lambda c, i: F.struct(ids.integer(c["title"]).alias("volume"), F.array_compact(F.transform(F.coalesce(c["pages"], F.array().cast("array<string>")), lambda p: ids.integer(p))).alias("pages"), i.alias("pos")))
    exact = F.filter(items, lambda c: F.size(c["pages"]) == ids.integer(s["pages"]))
    longest = F.array_sort(items, lambda a, b: F.when(F.size(a["pages"]) != F.size(b["pages"]), F.size(b["pages"]) - F.size(a["pages"])).otherwise(a["pos"] - b["pos"]))
    best = F.coalesce(F.when(ids.integer(s["pages"]) > 0, F.try_element_at(exact, F.lit(1))), F.try_element_at(longest, F.lit(1)))
    return F.struct(best["volume"].alias("volume"), F.array_min(best["pages"]).alias("start_page"), F.array_max(best["pages"]).alias("end_page"))


def law_pages_of_xml(xml: Column) -> Column:
    """The same from a law's XML: its citation and the highest page marker of that volume, never before the start."""
    cite = r"<citableAs>\s*(\d+)\s+Stat\.\s+(\d+)\s*</citableAs>"
    volume, start = ids.group(xml, cite, 1).cast("int"), ids.group(xml, cite, 2).cast("int")
    marks = F.regexp_extract_all(xml, F.lit(r'<page[^>]*identifier="/us/stat/(\d+/\d+)"'), F.lit(1))
    mine = F.transform(F.filter(marks, lambda m: F.substring_index(m, "/", 1).cast("int") == volume), lambda m: F.substring_index(m, "/", -1).cast("int"))
    return F.struct(volume.alias("volume"), start.alias("start_page"), F.greatest(start, F.array_max(mine)).alias("end_page"))


def statute_row(s: Column, xml: Column) -> list[Column]:
    """Ledger columns of a law; volume and pages come from its XML if that has a citation, else all three from the summary."""
    x, y = law_pages_of_xml(xml), law_pages(s)
    where = F.when(x["volume"].isNotNull(), x).otherwise(y)
    pid = s["packageId"]
    return [
        ids.pl_number(pid).alias("pl_number"), ids.plaw_congress(pid).alias("congress"), ids.plaw_number(pid).alias("law_number"), s["title"].alias("title"), ids.iso_date(s["dateIssued"]).alias("date_enacted"),
        *[where[c].alias(c) for c in ("volume", "start_page", "end_page")],
    ]


def granule_row(summary: DataFrame, mods: DataFrame) -> DataFrame:
    """Granule rows of summaries (granule_id, package_id, granule_class, title, number, granule_date, date_issued, has_file) and parsed MODS
    records: descriptive fields from the summary first, the date from MODS first, pages, citation and congress from MODS only."""
    s, m = summary.alias("s"), mods.alias("m")
    both = s.join(m, F.col("s.granule_id") == F.col("m.granule_id"), "left")
    first = lambda c: F.coalesce(F.nullif(F.col(f"s.{c}"), F.lit("")), F.col(f"m.{c}")).alias(c)
    return both.select(
        "s.granule_id", "s.package_id", *[first(c) for c in ("granule_class", "title", "number")],
        F.coalesce("m.granule_date", "s.granule_date", "s.date_issued").alias("date_issued"), *[F.col(f"m.{c}") for c in ("page_start", "page_end", "page_range", "total_pages", "citation", "congress")],
        F.when(F.coalesce("s.has_file", F.lit(False)), "downloaded").otherwise("pending").alias("status"),
    )


def missing_parents(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Parent keys to create before the children can be inserted."""
    return children.select(key).where(F.col(key).isNotNull()).distinct().join(parents.select(key), key, "left_anti")


# ---- reads and metadata


def list_packages(packages: DataFrame, collection: str = "STATUTE") -> DataFrame:
    return packages.where(F.col("collection") == collection).orderBy(F.asc_nulls_last("volume"), "package_id")


def select_packages(listing: DataFrame, floor: Column | None = None, limit: int | None = None) -> DataFrame:
    """Listed laws with a readable id from a date on, in listing order (pos), at most `limit`."""
    ok = listing.where(ids.plaw_number(F.col("package_id")).isNotNull())
    ok = ok if floor is None else ok.where(ids.issued_on_or_after(F.col("date_issued"), floor))
    return ok if limit is None else ok.orderBy("pos").limit(limit)


UPLOADED = ["uploaded", "verified"]


def metadata_rows(packages: DataFrame) -> DataFrame:
    """Public metadata of uploaded volumes, columns by name; order by volume (NULL as 0) and id when writing."""
    mine = packages.where((F.col("collection") == "STATUTE") & F.col("pdf_status").isin(UPLOADED))
    pid = F.col("package_id")
    columns = {
        "file_name": F.concat(F.lit("pdfs/"), pid, F.lit(".pdf")), "package_id": pid, "date_issued": F.date_format("date_issued", "yyyy-MM-dd"),
        "xml_file": F.when(F.col("xml_status").isin(UPLOADED), F.concat(F.lit("xmls/"), pid, F.lit(".xml"))),
        **{c: F.col(c) for c in ("volume", "congress", "session", "pages", "scanned", "pdf_bytes", "pdf_sha256", "xml_bytes", "xml_sha256")},
    }
    return mine.select(*[columns[c].alias(c) for c in sorted(columns)])


def rows_digest(rows: DataFrame) -> DataFrame:
    """One digest of a table that doesn't depend on row order, to tell whether it changed: `rows, digest`."""
    h = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    word = lambda i: F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)"))
    return rows.select(h.alias("h")).agg(F.count("*").alias("rows"), F.concat_ws("-", *[word(i).cast("string") for i in range(8)]).alias("digest"))


def work_units(spec: DataFrame, granules: DataFrame) -> DataFrame:
    """Units of a spec with their granules' rows; `found` tells unlisted ones. The spec is the small side; Spark broadcasts it if it is."""
    g = granules.withColumn("found", F.lit(True))
    return spec.join(g, "granule_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def law_units(laws: DataFrame, statutes: DataFrame) -> DataFrame:
    """Laws with their ledger rows, joined on the law number made of the package id."""
    s = statutes.withColumnRenamed("pl_number", "_pl")
    return laws.withColumn("pl_number", ids.pl_number(F.col("package_id"))).join(s, F.col("pl_number") == F.col("_pl"), "left").drop("_pl")


def select_units(units: DataFrame, keep_ids: DataFrame | None = None, classes: Sequence[str] = (), max_pages: int | None = None, limit: int | None = None) -> DataFrame:
    """Units by requested ids, classes and length, the first `limit` by position."""
    out = units if keep_ids is None else units.join(keep_ids, "granule_id", "left_semi")
    out = out.where(F.col("granule_class").isin(list(classes))) if classes else out
    out = out if max_pages is None else out.where(F.coalesce(F.col("est_pages") <= max_pages, F.lit(True)))
    return out if limit is None else out.orderBy("pos").limit(limit)


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    """`value, n`: the distinct values of a column (not NULL) with their rows, such as granules or profiles."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def combine_units(*parts: DataFrame) -> DataFrame:
    """All units of several lists, with repeated ones; columns missing in a list are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def identity_of_granule(row: dict[str, Column]) -> Column:
    """What a document builder must know, from a granule's columns (granule_class, number, congress, package_id, page_start, granule_id, date_issued, title)."""
    cls = F.coalesce(F.nullif(row["granule_class"], F.lit("")), F.lit("PUBLICLAW"))
    kind = F.when(cls.isin("PROCLAMATION", "TREATY"), "presidentialDoc").when(cls.isin("HCONRES", "SCONRES"), "resolution").otherwise("pLaw")
    number = F.when(kind == "pLaw", ids.group(row["number"].cast("string"), r"^(\d+)$").cast("int"))
    return F.struct(
        kind.alias("doc_type"), row["congress"].cast("int").alias("congress"), number.alias("law_number"), (cls == "PRIVATELAW").alias("is_private"),
        ids.group(row["package_id"], r"^STATUTE-(\d+)").cast("int").alias("volume"), row["page_start"].cast("int").alias("start_page"), row["granule_id"].alias("granule_id"),
        row["package_id"].alias("package_id"), F.nullif(row["date_issued"].cast("string"), F.lit("")).alias("date_issued"), row["title"].alias("title"),
    )


def identity_of_law(package_id: Column, volume: Column, start_page: Column, date: Column, title: Column) -> Column:
    return F.struct(
        F.lit("pLaw").alias("doc_type"), ids.plaw_congress(package_id).alias("congress"), ids.plaw_number(package_id).alias("law_number"), F.coalesce(ids.plaw_is_private(package_id), F.lit(False)).alias("is_private"),
        volume.cast("int").alias("volume"), start_page.cast("int").alias("start_page"), F.lit(None).cast("string").alias("granule_id"), package_id.alias("package_id"), F.nullif(date.cast("string"), F.lit("")).alias("date_issued"), title.alias("title"),
    )


def gap_end(attempts: DataFrame, misses: int = 3) -> DataFrame:
    """Where a numbered fetch ends: per congress the first number after which `misses` in a row were not found (`congress, number, found`)."""
    w = Window.partitionBy("congress").orderBy("number")
    run = F.sum(F.when(~F.col("found"), 1).otherwise(0)).over(w.rowsBetween(-(misses - 1), 0))
    return attempts.withColumn("_run", run).where(F.col("_run") == misses).groupBy("congress").agg((F.min("number") - misses + 1).alias("ends_at"))


def tidy(c: Column) -> Column:
    return strip(c)
