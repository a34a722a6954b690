"""Mixing sources to target weights (problem 9).

Capped water-filling: every source gets its weight of the total size; sources that would need more than their greatest
number of repetitions are clamped there and the excess goes to the others in proportion to their weights until it fits.
A source's share is then drawn as whole repetitions of all its documents plus a seeded fraction: documents in order of a
seeded hash up to the wanted size. The order is found by size per hash bin, then exactly inside the one bin that holds
the border, so no task sees a whole source.

Defined cases: sources without documents, weight or repetitions get nothing and their weight goes to the others; null
or unlisted sources take no part; documents of no tokens ride along with whole repetitions; repeated keys are one
document; repeated source rows keep the lowest weight; ties of the hash go by key; an empty side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096


def water_fill(weights: list[float], caps: list[float], total: float) -> list[float]:
    """Sizes of least distortion: weight-proportional, clamped at the caps, summing to ``total`` if the caps allow."""
    sizes, open_ = [0.0] * len(weights), {i for i, w in enumerate(weights) if w > 0 and caps[i] > 0}
    rest = min(total, sum(caps[i] for i in open_))
    while open_ and rest > 0:
        scale = rest / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * scale >= caps[i]}
        if not full:
            for i in open_:
                sizes[i] = weights[i] * scale
            break
        for i in full:
            sizes[i] = float(caps[i])
            rest -= caps[i]
        open_ -= full
    return sizes


def unclamped_total(weights: list[float], caps: list[float]) -> float:
    """The largest total at which every source that has anything gets its weight in full."""
    open_ = [(w, c) for w, c in zip(weights, caps) if w > 0 and c > 0]
    return min((c * sum(w for w, _ in open_) / w for w, c in open_), default=0.0)


def mix_plan(counted: DataFrame, targets: DataFrame, total: float | None = None, nearest: bool = False) -> DataFrame:
    """One row a source: source, target_share, max_repeats, size, wanted.

    ``total`` defaults to the listed sources' size; with ``nearest`` to the largest one at which no source is clamped, so that
    the shares come as near to their targets as they can.

    Reads one aggregated row per listed source to the driver; targets is a hand-written table (its size is checked).
    """
    spark = counted.sparkSession
    t = targets.filter("source is not null").groupBy("source").agg(F.min("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    sizes = counted.filter("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("docs"))
    rows = t.join(sizes, "source", "left").orderBy("source").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 sources in the target table")
    size = [float(r["size"] or 0) for r in rows]
    weights = [max(0.0, float(r["target_share"] or 0)) for r in rows]
    caps = [s * max(0, int(r["max_repeats"] or 0)) for s, r in zip(size, rows)]
    whole = float(total) if total is not None else unclamped_total(weights, caps) if nearest else sum(size)
    wanted = water_fill(weights, caps, whole)
    out = [(r["source"], r["target_share"], r["max_repeats"], int(s), float(w)) for r, s, w in zip(rows, size, wanted)]
    return spark.createDataFrame(out, "source string, target_share double, max_repeats int, size bigint, wanted double")


def sample_mix(counted: DataFrame, plan: DataFrame, key: str, seed: int = 17) -> DataFrame:
    """Rows ``key``, source, n_tokens, repeats (at least 1): how often each document is used."""
    fraction = plan.filter("size > 0 and wanted > 0").select("source", F.floor(F.col("wanted") / F.col("size")).cast("int").alias("whole"), (F.col("wanted") - F.floor(F.col("wanted") / F.col("size")) * F.col("size")).alias("extra"))
    docs = counted.filter(F.col(key).isNotNull()).join(F.broadcast(fraction), "source")  # one row a source, at most 10,000
    docs = docs.withColumn("h", F.xxhash64(F.col(key), F.lit(seed))).withColumn("bin", F.pmod("h", F.lit(BINS)).cast("int"))
    bins = docs.groupBy("source", "bin").agg(F.sum("n_tokens").alias("bin_size"), F.first("extra").alias("x"))
    upto = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    state = upto.select("source", "bin", "before", F.when(F.col("before") + F.col("bin_size") <= F.col("x"), 1).when(F.col("before") >= F.col("x"), -1).otherwise(0).alias("side"))
    placed = docs.join(state, ["source", "bin"])
    inside = placed.filter("side = 0").withColumn("sum", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("source", "bin").orderBy("h", key).rowsBetween(Window.unboundedPreceding, 0)))
    # The border document is taken if that comes nearer to the wanted size.
    edge = inside.withColumn("more", (F.col("sum") - F.col("n_tokens") / 2 <= F.col("extra")).cast("int")).drop("sum")
    rest = placed.filter("side <> 0").withColumn("more", (F.col("side") == 1).cast("int"))
    used = edge.unionByName(rest).withColumn("repeats", F.col("whole") + F.col("more"))
    return used.filter("repeats > 0").select(key, "source", "n_tokens", "repeats")


def reached_shares(sampled: DataFrame, plan: DataFrame) -> DataFrame:
    """Actual size and share of each source beside its target."""
    got = sampled.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.sum("repeats").cast("bigint").alias("records"), F.max("repeats").alias("most_repeats"))
    out = plan.join(got, "source", "left").fillna({"tokens": 0, "records": 0, "most_repeats": 0})
    return out.withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy())).select("source", "target_share", "max_repeats", "size", "tokens", "records", "most_repeats", "share")
