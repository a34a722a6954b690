"""Merging overlapping intervals and listing gaps (problem 2).

Two-level merge. Each interval is clipped at the borders of fixed time shards into at most a head, a tail and one
middle that covers whole shards. Heads and tails merge locally per (group, shard). Local periods away from every border
are final; those that touch a border, and the middles, are stitched per group and coalesced. Of the middles that begin at
one shard only the longest stays, so the stitch sees at most two periods and one middle a shard, and no task holds all
intervals of a long entity.

Defined cases: a null time, NaN, or an end at or before its start is no interval; repeated rows and ties count once;
an empty table gives no rows; an interval of any length makes at most three pieces; other columns are ignored; a null
group is a group of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.sharding import _null_safe_join, lead_over

SHARD_MS = 600_000


def _islands(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge (s, e) intervals per key; touching intervals join."""
    w = Window.partitionBy(*keys).orderBy("s", "e")
    top = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.withColumn("__new", F.when(top.isNull() | (F.col("s") > top), 1).otherwise(0))
    numbered = flagged.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("__island")


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, shard_ms: int = SHARD_MS) -> DataFrame:
    """Continuous covered periods per ``keys``: columns ``keys``, ``s``, ``e`` (BIGINT ms)."""
    keys = list(keys)
    iv = df.select(*keys, F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")).filter("s is not null and e > s")
    width = F.lit(shard_ms).cast("bigint")
    iv = iv.withColumn("b0", F.expr(f"cast(floor(s / {shard_ms}D) as bigint)")).withColumn("b1", F.expr(f"cast(floor((e - 1) / {shard_ms}D) as bigint)"))
    head = F.struct(F.col("b0").alias("shard"), F.col("s").alias("s"), F.least(F.col("e"), (F.col("b0") + 1) * width).alias("e"), F.lit(False).alias("mid"))
    tail = F.struct(F.col("b1").alias("shard"), (F.col("b1") * width).alias("s"), F.col("e").alias("e"), F.lit(False).alias("mid"))
    middle = F.struct((F.col("b0") + 1).alias("shard"), ((F.col("b0") + 1) * width).alias("s"), (F.col("b1") * width).alias("e"), F.lit(True).alias("mid"))
    pieces = F.when(F.col("b0") == F.col("b1"), F.array(head)).when(F.col("b1") == F.col("b0") + 1, F.array(head, tail)).otherwise(F.array(head, middle, tail))
    clipped = iv.select(*keys, F.inline(pieces))

    local = _islands(clipped.filter("not mid").select(*keys, "shard", "s", "e"), [*keys, "shard"])
    middles = clipped.filter("mid").groupBy(*keys, "s").agg(F.max("e").alias("e"))  # the others of its start lie within

    # Shards that lie wholly under a middle: their local periods are covered. One row a shard and two a middle.
    marks = middles.select(*keys, F.inline(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("step"), F.lit(None).cast("bigint").alias("shard")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("step"), F.lit(None).cast("bigint").alias("shard")))))
    shards = local.select(*keys, "shard").distinct().select(*keys, (F.col("shard") * width).alias("at"), F.lit(0).alias("step"), "shard")
    sweep = marks.unionByName(shards).withColumn("depth", F.sum("step").over(Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)))
    under = sweep.filter("step = 0 and depth > 0").select(*keys, "shard", F.lit(True).alias("under"))
    local = _null_safe_join(local, under, [*keys, "shard"]).filter("under is null").drop("under")

    inner = (F.col("s") > F.col("shard") * width) & (F.col("e") < (F.col("shard") + 1) * width)
    border = local.filter(~inner).select(*keys, "s", "e").unionByName(middles)
    return local.filter(inner).select(*keys, "s", "e").unionByName(_islands(border, keys))


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, max_gap_ms: int | None = None, shard_ms: int = SHARD_MS) -> DataFrame:
    """Rows ``keys``, ``kind`` (``period`` or ``gap``), ``start_ms``, ``end_ms``; gaps only below ``max_gap_ms`` if given."""
    keys = list(keys)
    periods = merge_intervals(df, keys, start, end, shard_ms).withColumn("shard", F.expr(f"cast(floor(s / {shard_ms * 6}D) as bigint)"))
    linked = lead_over(periods, keys, "shard", ["s"], F.col("s"), "nxt")
    period = F.struct(F.lit("period").alias("kind"), F.col("s").alias("start_ms"), F.col("e").alias("end_ms"))
    gap = F.struct(F.lit("gap").alias("kind"), F.col("e").alias("start_ms"), F.col("nxt").alias("end_ms"))
    is_gap = F.col("nxt").isNotNull() & (F.col("nxt") > F.col("e"))
    if max_gap_ms is not None:
        is_gap = is_gap & (F.col("nxt") - F.col("e") < max_gap_ms)
    return linked.select(*keys, F.inline(F.when(is_gap, F.array(period, gap)).otherwise(F.array(period))))
