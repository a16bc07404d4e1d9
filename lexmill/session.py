"""Session helpers shared by every operator: table loading, checkpoints, latest-row selection."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that count as outer blanks of keys, paths and digests (fixed values).
BLANKS = " \t\r\n\xa0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to. A cluster names it in spark.checkpoint.dir, shared by all its machines; only a local session
    without that setting (tests, a notebook) gets a temporary one, which is deleted at the end of the process."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        wanted = tempfile.mkdtemp(prefix="lexmill-ckpt-")
        atexit.register(shutil.rmtree, wanted, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(wanted)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that it is computed once and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def blank_trim(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def entity_key(c: Column) -> Column:
    """Comparable form of a granule or package id: trimmed, lower case, no `@...` suffix; blank is NULL."""
    k = blank_trim(F.lower(F.regexp_replace(c, r"@.*$", "")))
    return F.when(k != "", k)


def digest_key(c: Column) -> Column:
    """Comparable form of a sha256 digest: lower case, no outer blanks, no `sha256:` prefix; blank is NULL."""
    d = blank_trim(F.regexp_replace(blank_trim(F.lower(c)), r"^sha256:", ""))
    return F.when(d != "", d)


def latest(df: DataFrame, keys: dict[str, Column] | Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per key: the row with the largest `order` (NULLs smallest). Ties are broken by the kept
    columns, so the result doesn't depend on row order. Partial aggregation runs before the shuffle.

    `keys` are column names, or new names with their expressions; the result has the keys and `keep`.
    """
    keys = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order, *keep])])
    picked = df.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(F.max(rank).alias("_m"))
    return picked.select(*keys, *[F.col(f"_m.o{i + len(order)}").alias(c) for i, c in enumerate(keep)])
