"""Differences between two copies of data, row by row and field by field."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIFFS = "array<struct<field:string,left_value:string,right_value:string>>"


@dataclass(frozen=True)
class Field:
    """A compared field: its normalised value on either side. With `within`, both values come from the left copy."""

    name: str
    left: Column
    right: Column
    within: bool = False


def diff_copies(left: DataFrame, right: DataFrame, key: str, fields: list[Field], left_only: str, right_only: str) -> DataFrame:
    """Null-safe full outer join of two copies with one row per key; `key, diffs` where they differ.

    `left` and `right` have the key in column `key`; field expressions refer to columns as `l.x` and `r.x`, so
    equal column names on both sides don't clash. A key on one side only gets the single difference
    `left_only` or `right_only`, besides the differences within the left copy. NULL keys equal each other. A NULL value never differs.
    An empty side reports every key of the other one.
    """
    l, r = left.withColumn("_in_l", F.lit(True)).alias("l"), right.withColumn("_in_r", F.lit(True)).alias("r")
    both = l.join(r, F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")), "full_outer")
    in_l, in_r = F.col("l._in_l").isNotNull(), F.col("r._in_r").isNotNull()

    def diff(when: Column, name: str, a: Column, b: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("field"), a.cast("string").alias("left_value"), b.cast("string").alias("right_value")))

    null = F.lit(None)
    found = [diff(in_l & ~in_r, left_only, null, null), diff(in_r & ~in_l, right_only, null, null)]
    found += [diff((in_l if f.within else in_l & in_r) & (f.left != f.right), f.name, f.left, f.right) for f in fields]
    out = both.select(F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key), F.array_compact(F.array(*found)).cast(DIFFS).alias("diffs"))
    return out.where(F.size("diffs") > 0)


def diff_fields(diffs: DataFrame, key: str) -> DataFrame:
    """One row per difference: `key, field, left_value, right_value`."""
    return diffs.select(key, F.inline("diffs"))
