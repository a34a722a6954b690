"""Ordered scans over groups of any size.

A window per group puts a whole group into one task. These helpers split each group into shards by an order bucket,
scan the shards locally, scan one summary row per shard, and join the carried values back, so that the largest task
holds one shard or one row per shard of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"__j_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        one = left[c].eqNullSafe(renamed[f"__j_{c}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, "left").drop(*[f"__j_{c}" for c in on])


def distinct_in_shard(df: DataFrame, shard: Sequence[str], key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per ``key`` (equal keys share a shard), found by a window whose partitioning later shard scans reuse."""
    w = Window.partitionBy(*shard).orderBy(*key, *order)
    changed = F.lit(False)
    for c in key:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    return df.withColumn("__new", changed | (F.row_number().over(w) == 1)).filter("__new").drop("__new")


def lead_over(df: DataFrame, keys: Sequence[str], shard: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: ``value`` of the next row of the group in order of (shard, order); null after the last row."""
    w = Window.partitionBy(*keys, shard).orderBy(*order)
    box = F.struct(value.alias("v"))
    local = df.withColumn("__lead", F.lead(box).over(w))
    first = df.groupBy(*keys, shard).agg(F.min_by(box, F.struct(*order)).alias("__first"))
    carry = first.select(*keys, shard, F.lead("__first").over(Window.partitionBy(*keys).orderBy(shard)).alias("__carry"))
    out = _null_safe_join(local, carry, [*keys, shard])
    return out.withColumn(name, F.coalesce("__lead", "__carry")["v"]).drop("__lead", "__carry")


def fill_before(df: DataFrame, keys: Sequence[str], shard: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` strictly before the row in its group; null if there is none."""
    w = Window.partitionBy(*keys, shard).orderBy(*order)
    local = df.withColumn("__v", value).withColumn("__fill", F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    last = df.withColumn("__v", value).groupBy(*keys, shard).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__last"))
    carry = last.select(*keys, shard, F.last("__last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    out = _null_safe_join(local, carry, [*keys, shard])
    return out.withColumn(name, F.coalesce("__fill", "__carry")).drop("__v", "__fill", "__carry")


def running_sum(df: DataFrame, keys: Sequence[str], shard: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the group up to and including the row."""
    w = Window.partitionBy(*keys, shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("__v", value).withColumn("__sum", F.sum("__v").over(w))
    total = df.withColumn("__v", value).groupBy(*keys, shard).agg(F.sum("__v").alias("__total"))
    carry = total.select(*keys, shard, F.sum("__total").over(Window.partitionBy(*keys).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    out = _null_safe_join(local, carry, [*keys, shard])
    return out.withColumn(name, F.coalesce("__sum", F.lit(0)) + F.coalesce("__carry", F.lit(0))).drop("__v", "__sum", "__carry")
