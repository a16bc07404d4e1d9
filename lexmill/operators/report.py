"""Aggregates of benchmark runs, gold-set scores and conversion logs, and their rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Parts of 1 into which values are sorted for medians.
MEDIAN_BINS = 1000


def medians(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """`by, median`: exact medians per group, also of very large ones; NULL values don't count, groups without any are left out.

    Equal values are counted, counts summed per bin, and the bin of the middle ranks found; only that bin's distinct values are sorted. No task has more than a
    group's bins or one bin's distinct values.
    """
    per = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n")).withColumn("bin", F.floor(F.col("v") * MEDIAN_BINS))
    bins = per.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    group, upto = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = bins.select(*by, "bin", (F.sum("n").over(upto) - F.col("n")).alias("before"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = run.where((F.col("before") < high) & (F.col("upto") >= low)).select(*[F.col(c).alias(f"_{c}") for c in [*by, "bin"]], "before", "total")
    inside = per.join(middle, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "bin"]])
    rank = F.col("before") + F.sum("n").over(Window.partitionBy(*by, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    at = inside.withColumn("rank", rank).groupBy(*by).agg(F.min(F.when(F.col("rank") >= low, F.col("v"))).alias("lo"), F.min(F.when(F.col("rank") >= high, F.col("v"))).alias("hi"))
    return at.select(*by, ((F.col("lo") + F.col("hi")) / 2).alias("median"))


def _with_medians(stats: DataFrame, rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    m = medians(rows, by, value).select(*[F.col(c).alias(f"_m_{c}") for c in by], F.col("median").alias(name))
    return stats.join(m, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in by], "left").drop(*[f"_m_{c}" for c in by])


def _some(c: str) -> Column:
    return F.sum(F.when(F.col(c) != 0, F.col(c)))


_STATISTICS = ["n", "mean_cer", "median_cer", "mean_wer", "section_recall", "id_f1", "clip_both", "kept_ratio", "xsd_valid", "seconds_per_page", "judged", "judge_mean"]


def run_statistics(rows: DataFrame, by: list[str]) -> DataFrame:
    """Statistics of benchmark rows (cer, wer, section_recall, id_f1, clip, kept_ratio, xsd_valid, seconds, pages, judge) per group; NULL groups are `?`.

    Medians are exact. Seconds per page divides the sum of the seconds there are by the sum of the pages there are; zeros and NULLs count in neither.
    """
    named = rows.withColumns({c: F.coalesce(F.col(c), F.lit("?")) for c in by})
    stats = named.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("cer").alias("mean_cer"), F.avg("wer").alias("mean_wer"), F.avg("section_recall").alias("section_recall"),
        F.avg("id_f1").alias("id_f1"), F.count_if(F.col("clip") == "both").alias("clip_both"), F.min("kept_ratio").alias("kept_ratio"), F.count_if("xsd_valid").alias("xsd_valid"),
        F.try_divide(_some("seconds"), _some("pages")).alias("seconds_per_page"), F.count("judge").alias("judged"), F.avg("judge").alias("judge_mean"),
    )
    return _with_medians(stats, named, by, "cer", "median_cer").select(*by, *_STATISTICS)


def run_matrix(rows: DataFrame) -> DataFrame:
    """Statistics by profile, tier and era, and by era alone (profile and tier `all`)."""
    r = rows.withColumn("tier", F.coalesce("tier", F.lit("B")))
    every = F.lit("all")
    parts = run_statistics(r, ["profile", "tier", "era"]), run_statistics(r, ["era"]).select(every.alias("profile"), every.alias("tier"), "era", *_STATISTICS)
    return parts[0].unionByName(parts[1])


def summarize_scores(scores: DataFrame, group: str = "period") -> DataFrame:
    """Gold-set scores (cer, sidenote_cer) per group and for `all`. The total is told by its own aggregate, never by a NULL group."""

    def of(rows: DataFrame) -> DataFrame:
        stats = rows.groupBy(group).agg(
            F.count("*").alias("pages"), F.count("cer").alias("scored"), (F.count("*") - F.count("cer")).alias("missing"),
            F.avg("cer").alias("mean_cer"), F.count("sidenote_cer").alias("sidenote_pages"), F.avg("sidenote_cer").alias("sidenote_cer"),
        )
        return _with_medians(stats, rows, [group], "cer", "median_cer")

    return of(scores).unionByName(of(scores.withColumn(group, F.lit("all"))))


def candidate_texts(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """Gold pages with a candidate's page texts (granule_id, pdf_page, body, sidenote); `source` tells a page without text from a granule without any output."""
    has = texts.select("granule_id").distinct().withColumn("_any", F.lit(True))
    t = texts.select("granule_id", "pdf_page", "body", F.col("sidenote").alias("sidenote"), F.lit(True).alias("_page"))
    out = pages.join(t, ["granule_id", "pdf_page"], "left").join(has, "granule_id", "left")
    return out.withColumn("source", F.when(F.col("_page"), "text").when(F.col("_any"), "page missing").otherwise("no output")).drop("_any", "_page")


def first_available(pages: DataFrame, volume_texts: DataFrame, slice_texts: DataFrame) -> DataFrame:
    """Publisher texts of pages by label: from the volume, else from the granule's slice, else the reason why there is none."""
    label = F.lower("stat_page")
    p = pages.withColumn("_label", label)
    v = volume_texts.select("volume", F.col("label").alias("_label"), F.struct("body", "sidenote").alias("_v"))
    s = slice_texts.select("granule_id", F.col("label").alias("_label"), F.struct("body", "sidenote").alias("_s"))
    out = p.join(v, ["volume", "_label"], "left").join(s, ["granule_id", "_label"], "left").withColumn("_t", F.coalesce("_v", "_s"))
    why = F.when(F.col("_label").isNull(), "no page label").when(F.col("_v").isNotNull(), "volume").when(F.col("_s").isNotNull(), "slice").otherwise("no text for the page")
    return out.withColumn("body", F.col("_t.body")).withColumn("sidenote", F.col("_t.sidenote")).withColumn("source", why).drop("_v", "_s", "_t", "_label")


def page_by_candidate(scores: DataFrame, candidates: list[str]) -> DataFrame:
    """Pages by candidates: the error rate, as text, or why there is none."""
    cell = F.coalesce(fixed(F.col("cer"), 3), F.col("source"), F.lit("-"))
    return scores.withColumn("_cell", cell).groupBy("granule_id", "pdf_page").pivot("candidate", candidates).agg(F.first("_cell"))


def timing_notes(timings: DataFrame) -> DataFrame:
    """Model time per variant, engine, tier and era, of timing sidecars. Failed units count only as such."""
    ok = F.col("status") != "failed"
    part = lambda c: F.sum(F.when(ok, F.col(c)))
    capped = F.sum(F.when(ok, capped_pages(F.col("page_times"), F.col("max_new_tokens"))))
    per = lambda c: F.try_divide(part(c), part("pages"))
    hosts = F.array_join(F.array_sort(F.collect_set(F.coalesce("host", F.lit("?")))), ", ")
    return timings.groupBy("variant", "engine", F.coalesce("tier", F.lit("B")).alias("tier"), F.coalesce("era", F.lit("?")).alias("era")).agg(
        F.count("*").alias("units"), F.coalesce(part("pages"), F.lit(0)).alias("pages"), per("seconds").alias("wall_per_page"), per("model_seconds").alias("model_per_page"), per("tokens").alias("tokens_per_page"),
        F.coalesce(capped, F.lit(0)).alias("capped"), F.count_if(F.col("status") == "partial").alias("partial"), F.count_if(~ok).alias("failed"), F.coalesce(part("synthesized"), F.lit(0)).alias("synthesized"), hosts.alias("hosts"),
    )


def capped_pages(page_times: Column, limit: Column) -> Column:
    """Pages whose text was cut: by their stop reason, or with as many tokens as allowed."""
    cut_off = lambda p: F.coalesce(p["stop_reason"] == "length", F.lit(False)) | F.coalesce((limit > 0) & (p["tokens"] >= limit) & (p["tokens"] > 0), F.lit(False))
    return F.coalesce(F.size(F.filter(page_times, cut_off)), F.lit(0))


def usage_totals(pages: DataFrame) -> DataFrame:
    """Sums of transcription usage, cost and seconds per page (of at least one page)."""
    n = F.greatest(F.count("*"), F.lit(1))
    return pages.agg(F.count("*").alias("pages"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost").alias("cost"), (F.coalesce(F.sum("cost"), F.lit(0.0)) / n).alias("cost_per_page"), (F.coalesce(F.sum("seconds"), F.lit(0.0)) / n).alias("seconds_per_page"))


def corpus_totals(records: DataFrame) -> DataFrame:
    """Totals of a gold set: pages, tokens, cost, models, pages with disagreements and their mean number."""
    models = F.array_sort(F.array_distinct(F.flatten(F.collect_set("models"))))
    return records.agg(F.count("*").alias("pages"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost_usd").alias("cost_usd"), models.alias("models"), F.count_if(F.col("disagreement_count") > 0).alias("disputed"), F.avg("disagreement_count").alias("mean_disagreements"))


def status_counts(results: DataFrame) -> DataFrame:
    """Units by outcome; `invalid` are successes that fail the schema."""
    return results.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "failed")], F.count_if((F.col("status") == "success") & ~F.col("xsd_valid")).alias("invalid"))


def route_pairs(work: DataFrame) -> DataFrame:
    """What becomes of each unit, of columns reference, unpaired_reason, converted: scored, skipped or failed, with the reason."""
    skipped = F.col("unpaired_reason").isNotNull()
    status = F.when(skipped, "skipped").when(F.col("reference").isNull() | ~F.coalesce("converted", F.lit(False)), "failed").otherwise("scored")
    reason = F.when(skipped, F.concat(F.lit("no one-to-one reference ("), "unpaired_reason", F.lit(")"))).when(F.col("reference").isNull(), "no reference slice").when(~F.coalesce("converted", F.lit(False)), "not converted")
    return work.withColumn("status", status).withColumn("reason", reason)


def character_accounts(source_chars: Column, kept_chars: Column) -> Column:
    """Share of the source's characters that a document keeps; 1 if there are none."""
    return F.when(source_chars > 0, F.round(kept_chars / source_chars, 4)).otherwise(1.0)


def profiles_with_output(outputs: DataFrame, granules: DataFrame) -> DataFrame:
    return outputs.join(granules.select("granule_id"), "granule_id", "left_semi").select("profile").distinct()


def judge_scores(text: Column, structure: Column, tagging: Column) -> Column:
    """Judge scores within 0 to 100 and their mean."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(100.0), c.cast("double")))
    parts = [clamp(c) for c in (text, structure, tagging)]
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("text", "structure", "tagging"), strict=True)], F.bround((parts[0] + parts[1] + parts[2]) / 3, 2).alias("overall"))


# ---- rows that run over


def merge_paragraphs(lines: DataFrame, page: list[str], pos: str = "pos") -> DataFrame:
    """Transcribed lines (role, text, starts_paragraph) as items: a line that starts no paragraph goes on in the latest item of its role
    on the page, whatever stands between; a role's first line starts one. `<page>, role, first_pos, text, lines`."""
    rows = lines.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    w = Window.partitionBy(*page, "role").orderBy(pos)
    opens = F.when(F.coalesce("starts_paragraph", F.lit(True)) | (F.row_number().over(w) == 1), 1).otherwise(0)
    item = rows.withColumn("_o", opens).withColumn("_item", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("text").alias("t"))))
    return item.groupBy(*page, "role", "_item").agg(F.min(pos).alias("first_pos"), F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias("text"), F.count("*").alias("lines")).drop("_item")


def forward_fill(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The latest non-NULL value so far within the group, as of each row."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def number_runs(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str = "run") -> DataFrame:
    """Number of the run of equal values each row is in, from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    starts = F.when(F.lag(value).over(w).eqNullSafe(value) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return rows.withColumn("_s", starts).withColumn(name, F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


# ---- rendering


def fixed(c: Column, digits: int) -> Column:
    """A number with fixed digits; NULL stays NULL."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c.cast("double")))


def markdown_rows(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """One markdown table row per row: `row`; NULL is `-`."""
    digits = digits or {}
    cells = [F.coalesce(fixed(F.col(c), digits[c]) if c in digits else F.col(c).cast("string"), F.lit("-")) for c in df.columns]
    return df.select(*df.columns, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("row"))


def markdown_table(df: DataFrame, order: list[str], digits: dict[str, int] | None = None) -> str:
    """A report's table; only a report's few rows reach the driver."""
    rows = markdown_rows(df, digits).orderBy(*order).select("row").collect()
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *[r.row for r in rows]])


def replace_section(text: str, heading: str, body: str) -> str:
    """A report with its section (to the end) replaced, or added."""
    return text.split(f"\n{heading}\n")[0].rstrip() + f"\n\n{heading}\n\n{body.strip()}\n"
