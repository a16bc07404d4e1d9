"""References to records that do not exist.

References and parents are hash-partitioned by the same normalised key and sorted by it; Spark's
sort-merge join then walks both streams once. Parents are reduced to one validity interval per key
before the shuffle, so the merge never buffers more than one parent row. References to a hot parent are spread
over salts, and its single interval is repeated for each of them, so no task gets all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import latest


def validity_intervals(parents: DataFrame, key: Column, updated: str, created: str, deleted: str) -> DataFrame:
    """One row `ref_key, valid_from, valid_to` per parent, from its latest version.

    `valid_to` is NULL while the parent lives. Rows with a NULL key are no parents. A NULL `updated` is
    older than any other. Repeated rows and ties give one interval.
    """
    rows = parents.withColumn("_k", key).where(F.col("_k").isNotNull())
    one = latest(rows, {"ref_key": F.col("_k")}, [updated], [created, deleted])
    return one.select("ref_key", F.col(created).alias("valid_from"), F.col(deleted).alias("valid_to"))


#: References to one parent that a task takes before they are spread, and keys that may be spread. A key beyond the commonest HOT_KEYS
#: has less than a HOT_KEYS-th of all references, so what reaches the driver and is broadcast has this bound at any size.
ROWS_PER_TASK, HOT_KEYS = 1 << 18, 1024


def hot_keys(keys: DataFrame, key: Column, rows_per_task: int = ROWS_PER_TASK) -> dict[str, int]:
    """The number of salts of each key with more than `rows_per_task` rows, among the HOT_KEYS commonest."""
    common = keys.select(key.alias("k")).where("k is not null").groupBy("k").count().where(F.col("count") > rows_per_task)
    return {r.k: r["count"] // rows_per_task + 1 for r in common.orderBy(F.desc("count"), "k").limit(HOT_KEYS).collect()}


def orphan_references(refs: DataFrame, intervals: DataFrame, hot: dict[str, int] | None = None) -> DataFrame:
    """Orphans among `refs` (child_table, child_key, ref_key, child_created), with reason and period; `hot` as from hot_keys.

    * ref_key NULL: no reference, no row.
    * `missing`: no interval has the key; `deleted`: the interval is closed; `late`: it begins after the
      child's creation (a NULL on either side is never late). The first that holds is reported.
    * period is the child's month, NULL if its creation time is NULL.
    * repeated children give one row; empty inputs give none (all `missing` if only parents are empty).
    """
    # only the columns needed cross the shuffle; other columns may have any name
    left = refs.select("child_table", "child_key", "ref_key", "child_created").where(F.col("ref_key").isNotNull())
    right = intervals.select(F.col("ref_key").alias("_pk"), "valid_from", "valid_to")
    on = F.col("ref_key") == F.col("_pk")
    if hot:
        salts = F.broadcast(refs.sparkSession.createDataFrame(list(hot.items()), "_hot string, _salts long"))
        left = left.join(salts, F.col("ref_key") == F.col("_hot"), "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("child_key"), "_salts"), F.lit(0))).drop("_hot", "_salts")
        right = right.join(salts, F.col("_pk") == F.col("_hot"), "left").withColumn("_psalt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot", "_salts")
        on = on & (F.col("_salt") == F.col("_psalt"))
    merged = left.join(right.hint("merge"), on, "left")
    reason = (
        F.when(F.col("_pk").isNull(), "missing")
        .when(F.col("valid_to").isNotNull(), "deleted")
        .when(F.col("valid_from") > F.col("child_created"), "late")
    )
    return (
        merged.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("child_table", "child_key", "reason", F.date_format("child_created", "yyyy-MM").alias("period"))
        .distinct()
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans counted per table, period and reason."""
    return orphans.groupBy("child_table", "period", "reason").agg(F.count("*").alias("orphans"))
