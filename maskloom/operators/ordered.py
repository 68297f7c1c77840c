"""Numbering and looking back within groups of any size.

A plain window runs one group in one task. Here a group is cut into buckets of its order column:
rows are ordered inside a bucket, and only one small row per bucket is ordered across the group.
The order column must be a whole number, unique in its group; ``width`` is what a bucket spans of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 16_384


def _bucketed(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(order) / F.lit(width)))


def _earlier(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``: 1, 2, … within the keys (none NULL) by ``order``."""
    keys = list(keys)
    rows = _bucketed(df, order, width)
    buckets = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    buckets = buckets.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(_earlier(keys, "_bucket")), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order))
    return rows.join(buckets, [*keys, "_bucket"]).select(
        *[F.col(c) for c in df.columns], (F.col("_before") + inside).alias(name)
    )


def as_of(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``: the last non-NULL ``value`` before the row; if there is none, the first after it."""
    keys = list(keys)
    rows = _bucketed(df.withColumn("_value", value), order, width)
    dated = F.when(F.col("_value").isNotNull(), F.struct(F.col(order).alias("at"), F.col("_value").alias("value")))
    buckets = rows.groupBy(*keys, "_bucket").agg(F.max(dated).alias("_last"), F.min(dated).alias("_first"))
    buckets = buckets.select(
        *keys, "_bucket", F.max("_last").over(_earlier(keys, "_bucket"))["value"].alias("_before"),
        F.min("_first").over(Window.partitionBy(*keys))["value"].alias("_else"),
    )
    inside = F.last("_value", ignorenulls=True).over(_earlier([*keys, "_bucket"], order))
    return rows.join(buckets, [*keys, "_bucket"]).select(
        *[F.col(c) for c in df.columns], F.coalesce(inside, "_before", "_else").alias(name)
    )
