"""Readers and writers of the corpus's files: listings, specs, layouts, gold pages, timing sidecars, XML, binary trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import ids

LINE = "array<struct<role:string,text:string>>"
USAGE = "struct<input_tokens:bigint,output_tokens:bigint,cache_read_input_tokens:bigint,cache_creation_input_tokens:bigint>"
GOLD = (
    "granule_id string, package_id string, volume int, period string, granule_class string, title string, date_issued string, pdf_page int, pdf_pages int, stat_page string, image string, image_sha256 string, "
    f"dpi int, model string, models array<string>, transcriptions struct<A:struct<lines:{LINE}>,B:struct<lines:{LINE}>>, lines {LINE}, disagreement_count int, tokens {USAGE}, cost_usd double, seconds double, created string"
)
LISTING = "granuleId string, granuleClass string, title string, dateIssued string"
TIMING = (
    "stem string, variant string, engine string, status string, pages int, seconds double, model_seconds double, tokens bigint, "
    "page_times array<struct<page:int,seconds:double,tokens:bigint,stop_reason:string>>, errors array<string>, "
    "stats struct<items:bigint,text_chars:bigint,synthesized_geometry:bigint,granule_class:string,era:string,tier:string>, spec struct<max_new_tokens:bigint>, host struct<node:string>"
)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Saved granule listings (one JSON array per volume): `volume, granule_id, granule_class, title, date_issued`."""
    raw = spark.read.schema(LISTING).json(path, multiLine=True).withColumn("_path", F.col("_metadata.file_path"))
    volume = F.coalesce(ids.granule_volume(F.col("granuleId")), F.regexp_extract("_path", r"STATUTE-(\d+)", 1).try_cast("int"))
    return raw.select(volume.alias("volume"), F.col("granuleId").alias("granule_id"), F.col("granuleClass").alias("granule_class"), "title", F.col("dateIssued").alias("date_issued"))


def cached_listing(spark: SparkSession, path: str, fetch) -> DataFrame:
    """The saved listing, else what `fetch` (to a DataFrame) gives, which is then saved."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        fetch().write.parquet(path)
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """Gold page records, sorted by period, volume, page and number. Unreadable files are left out."""
    raw = spark.read.schema(GOLD).json(path, multiLine=True, mode="PERMISSIVE").where("granule_id is not null")
    raw = raw if period is None else raw.where(F.col("period") == period)
    return raw.orderBy("period", "volume", ids.page_sort_key(F.col("granule_id")), "pdf_page")


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """Timing sidecars as rows for report.timing_notes; corrupt ones are left out."""
    raw = spark.read.schema(TIMING).json(path, multiLine=True, mode="PERMISSIVE").where("variant is not null")
    return raw.select("stem", "variant", "engine", "status", "pages", "seconds", "model_seconds", "tokens", "page_times", "errors", F.col("stats.tier").alias("tier"), F.col("stats.era").alias("era"), F.col("stats.synthesized_geometry").alias("synthesized"), F.col("spec.max_new_tokens").alias("max_new_tokens"), F.col("host.node").alias("host"))


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """A sample spec in YAML: `pos, granule_id, package_id, era`; entries are ids or mappings, the first of an id counts. A spec is a small, hand-checked file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        entries = (yaml.safe_load(f) or {}).get("granules") or []
    rows = [(i, *((e, None, None) if isinstance(e, str) else (e["granule_id"], e.get("package_id"), e.get("era")))) for i, e in enumerate(entries)]
    df = spark.createDataFrame(rows, "pos int, granule_id string, package_id string, era string")
    first = F.row_number().over(Window.partitionBy("granule_id").orderBy("pos"))
    return df.withColumn("_n", first).where("_n = 1").drop("_n").withColumn("package_id", F.coalesce("package_id", ids.package_of_granule(F.col("granule_id"))))


def write_spec(rows: DataFrame, path: str, header: dict) -> None:
    """A spec's rows (a sample, so few) as YAML under a header."""
    import yaml

    entries = [r.asDict(recursive=True) for r in rows.collect()]
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump({**header, "granules": entries}, f, sort_keys=False, allow_unicode=True, width=120)


def read_documents(spark: SparkSession, path: str, name: str = "granule_id") -> DataFrame:
    """XML or JSON files as rows of stem and text."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias(name), F.col("value").alias("text"))
    return raw


def file_tree(spark: SparkSession, path: str, with_digest: bool = False) -> DataFrame:
    """Files below a folder: `path, size`, and sha256 if asked for; without it contents aren't read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rel = F.regexp_replace(F.col("path"), r"^file:/*", "/")
    return raw.select(rel.alias("path"), F.col("length").alias("size"), *([F.sha2("content", 256).alias("sha256")] if with_digest else []))


def write_json_lines(rows: DataFrame, path: str, order: list[str]) -> None:
    """Rows as JSON lines in order, columns by name, NULLs kept: as many part files as a range shuffle has, to be read or joined in the order of their names."""
    rows.select(*sorted(rows.columns)).orderBy(*order).write.option("ignoreNullFields", False).mode("overwrite").json(path)


def write_documents(docs: DataFrame, path: str, profile: str = "profile") -> None:
    """Documents and their statistics as a table, a folder per profile."""
    docs.write.partitionBy(profile).mode("append").parquet(path)


def is_valid(xml: Column, xsd: str) -> Column:
    """Whether documents are valid by a schema file that all executors have; NULL for NULL. It is the XML reader's own validation: yes or no, without the errors."""
    read = F.from_xml(xml, "_corrupt_record string, _other string", {"rowValidationXSDPath": xsd, "mode": "PERMISSIVE"})
    return F.when(xml.isNotNull(), read["_corrupt_record"].isNull())
