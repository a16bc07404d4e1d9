"""Page estimates, seeded stratified samples, quotas and budgets.

Draws order rows by a digest of seed and id. So they depend on nothing else: not on partitions, other rows or the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import ids


def draw(seed: int | str, *keys: Column) -> Column:
    """The order of a seeded draw."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def estimate_pages(granules: DataFrame, granule: str = "granule_id", volume: str = "volume") -> DataFrame:
    """`est_pages` of each granule with a page: pages to the next granule of the same lettered part, at least 1; 1 for the last."""
    key = ids.page_sort_key(F.col(granule))
    on = granules.withColumn("_k", key).where(ids.granule_page(F.col(granule)).isNotNull())
    w = Window.partitionBy(volume, "_k.prefix").orderBy("_k.page", "_k.position", granule)
    ahead = F.lead("_k.page").over(w) - F.col("_k.page")
    return on.withColumn("est_pages", F.greatest(F.lit(1), F.coalesce(ahead, F.lit(1)))).drop("_k")


def granule_pool(granules: DataFrame, max_pages: int, granule_class: str | None = "PUBLICLAW") -> DataFrame:
    """Candidates of a sample: allowed in their era, at most `max_pages` by estimate."""
    est = estimate_pages(granules).withColumn("era", ids.era(F.col("volume"))).withColumn("period", ids.period(F.col("volume")))
    cls = F.col("granule_class")
    ok = cls == granule_class if granule_class else F.col("era").isNotNull() & ids.class_allowed(F.col("era"), cls)
    return est.where(ok & (F.col("est_pages") <= max_pages)).withColumn("title", F.substring(F.coalesce("title", F.lit("")), 1, 200))


def stratified_sample(pool: DataFrame, strata: list[str], key: str, per_cell: int, seed: int | str) -> DataFrame:
    """`per_cell` rows of each stratum. Spark limits each partition's strata before the shuffle, so a large stratum isn't gathered."""
    w = Window.partitionBy(*strata).orderBy(draw(seed, F.col(key)), key)
    return pool.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_cell).drop("_n")


def choose_volumes(volumes: DataFrame, group: str, per_group: int, seed: int | str) -> DataFrame:
    return stratified_sample(volumes.select(group, "volume").distinct(), [group], "volume", per_group, seed)


def choose_pages(granules: DataFrame, granule: str, pages: str, seed: int | str, per_granule: int) -> DataFrame:
    """Up to `per_granule` pages of each granule, independent of other granules: `pdf_page`."""
    every = granules.where(F.col(pages) > 0).withColumn("pdf_page", F.explode(F.sequence(F.lit(1), F.col(pages))))
    w = Window.partitionBy(granule).orderBy(draw(seed, F.col(granule), F.col("pdf_page")))
    return every.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_granule).drop("_n")


def interleave(rows: DataFrame, group: str, order: list[Column], by: Column | None = None) -> DataFrame:
    """`turn`, the position of each row in a round robin of the groups, which go in the order of `by` (default: the group itself)."""
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.withColumn("_by", F.col(group) if by is None else by).withColumn("turn", F.struct("_r", "_by")).drop("_r", "_by")


def plan_pages(pool: DataFrame, seed: int | str, per_period: int, per_granule: int, volumes: int) -> DataFrame:
    """Pages of a gold set: per period the first drawn volumes that have candidates, their granules in round robin, a few pages of each
    granule, up to a quota; one row per page with `pdf_page`."""
    chosen = choose_volumes(pool, "period", volumes, seed)
    mine = pool.join(chosen, ["period", "volume"], "left_semi")
    turns = interleave(mine, "volume", [draw(seed, F.col("period"), F.col("granule_id")), F.col("granule_id")])
    pages = choose_pages(turns, "granule_id", "est_pages", seed, per_granule)
    w = Window.partitionBy("period").orderBy("turn", "granule_id", "pdf_page")
    return pages.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_period).drop("_n", "turn")


def choose_review(records: DataFrame, seed: int | str, n: int, group: str = "period", key: tuple[str, str] = ("granule_id", "pdf_page"), groups: int | None = None) -> DataFrame:
    """Equal shares of each group for a check by people, `n` at most in all."""
    groups = groups or max(1, records.select(group).distinct().count())
    w = Window.partitionBy(group).orderBy(draw(f"{seed}:review", *[F.col(k) for k in key]), *key)
    return records.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max(1, n // groups)).drop("_n").limit(n)


def budget_stop(costs: DataFrame, order: list[str], cost: str, total: int, limit: float, spent: float = 0.0, done: int = 0, least: int = 5, by: list[str] | None = None) -> DataFrame:
    """Running budget over the ordered log of each run (`by`): `spent_so_far, projected, stops`. It stops when more than the limit is
    spent, or, after `least` pages, when the rest at the run's mean cost would exceed it."""
    w = Window.partitionBy(*(by or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n, so_far = F.count("*").over(w), F.sum(cost).over(w)
    projected = F.lit(spent) + so_far + (F.lit(total - done) - n) * (so_far / n)
    over = (F.lit(spent) + so_far > limit) | ((n >= least) & (F.lit(least) > 0) & (projected > limit))
    return costs.withColumn("spent_so_far", F.lit(spent) + so_far).withColumn("projected", projected).withColumn("stops", over)


def sample_counts(sample: DataFrame) -> DataFrame:
    """Granules and estimated pages per era and class."""
    return sample.groupBy("era", "granule_class").agg(F.count("*").alias("granules"), F.sum("est_pages").alias("pages"))


def regroup_pages(pages: DataFrame) -> DataFrame:
    """A spec's rows: one per granule with its sorted pages."""
    return pages.groupBy("granule_id").agg(F.array_sort(F.collect_list("pdf_page")).alias("pages"))


def volume_dates(granules: DataFrame, granule_class: str = "PUBLICLAW") -> DataFrame:
    """First and last date of a volume's public laws."""
    mine = granules.where((F.col("granule_class") == granule_class) & F.col("date_issued").isNotNull())
    return mine.groupBy("volume").agg(F.min("date_issued").alias("first_date"), F.max("date_issued").alias("last_date"))
