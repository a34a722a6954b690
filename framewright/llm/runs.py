"""Repeated consecutive events in sequences (problem 5).

Only boundary rows survive: events that differ from their predecessor. ``lead`` over the boundaries gives each run's
end; the difference of positions is its count, the previous event's order value and time are its last ones. All scans
are sharded (operators.sharding), so a huge sequence is no single task. The comparison with the predecessor is an edit
distance inside the JVM.

Defined cases: repeated keys are one record; a null or blank text breaks a run; events whose score is below the floor
prolong the run they follow and are passed over elsewhere; null scores count as 0; a null key takes no part; very long
texts are compared whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.sharding import distinct_in_shard, lead_over
from framewright.session import cut

SHARD_ROWS = 4096


def plain_line(text: Column) -> Column:
    """The line without tags, music signs, spaces and case."""
    t = F.regexp_replace(text, r"<[^<>]*>|\{\\[^{}]*\}", "")
    t = F.regexp_replace(t, r"[\s\p{Z}\p{Cf}♩-♯★☆#¶]+", "")
    return F.lower(t)


def same_line(a: Column, b: Column) -> Column:
    """Equal apart from slips: an edit distance of at most 4 and of at most a fifth of the shorter line (1 at least)."""
    room = F.least(F.lit(4), F.greatest(F.lit(1), F.floor(F.least(F.length(a), F.length(b)) / 5).cast("int")))
    near = (F.abs(F.length(a) - F.length(b)) <= 4) & (F.levenshtein(a, b, 4) >= 0) & (F.levenshtein(a, b, 4) <= room)
    return (a == b) | near


def collapse_runs(df: DataFrame, group: str, order: str, text: str, score: str | None = None, floor: float = 0.55, weight: str | None = None, at: str | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a run: group, first_no, last_no, n_records, n_weight, first_at, last_at.

    ``weight`` (default 1) is summed over the run's records; ``at`` gives first and last time (default: order).
    """
    low = (F.coalesce(F.nanvl(F.col(score), F.lit(0.0)), F.lit(0.0)) < floor) if score else F.lit(False)
    w = (F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(1)).cast("bigint")
    rows = df.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("raw"), F.col(at or order).alias("at"), w.alias("w"), low.alias("low"))
    rows = rows.filter("g is not null and o is not null").withColumn("shard", F.expr(f"cast(floor(o / {shard_rows}D) as bigint)"))
    rows = distinct_in_shard(rows, ["g", "shard"], ["g", "o"])
    # A blank record ends a run whatever its score; a faded one never begins a run.
    rows = rows.withColumn("fade", F.col("low") & F.col("raw").rlike(r"[^\s\p{Z}]")).drop("low")

    # One summary row a shard carries positions, weights, the last compared text and the last record to later shards.
    whole = rows.groupBy("g", "shard").agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"),
        F.max_by(F.struct("raw"), F.when(~F.col("fade"), F.col("o"))).alias("solid"), F.max_by(F.struct("o", "at"), "o").alias("end"),
    )
    by = Window.partitionBy("g").orderBy("shard")
    before, all_rows = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = whole.select(
        F.col("g").alias("cg"), F.col("shard").alias("cs"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("c_n"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("c_w"),
        F.last("solid", ignorenulls=True).over(before).alias("c_solid"), F.last("end").over(before).alias("c_end"),
        F.struct(F.sum("n").over(all_rows).alias("n"), F.sum("w").over(all_rows).alias("w"), F.last("end").over(all_rows).alias("end")).alias("total"),
    )

    w_shard = Window.partitionBy("g", "shard").orderBy("o")
    past = w_shard.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("line", plain_line(F.col("raw"))).drop("raw")
    local = rows.select(
        "g", "shard", "o", "at", "line", "fade",
        (F.row_number().over(w_shard) - 1).alias("l_n"), F.coalesce(F.sum("w").over(past), F.lit(0)).alias("l_w"),
        F.last(F.when(~F.col("fade"), F.struct("line")), ignorenulls=True).over(past).alias("l_solid"), F.lag(F.struct("o", "at")).over(w_shard).alias("l_end"),
    )
    seen = local.join(carry, (F.col("g") == F.col("cg")) & (F.col("shard") == F.col("cs")), "left")
    prev = F.coalesce(F.col("l_solid.line"), plain_line(F.col("c_solid.raw")))
    seen = seen.withColumn("prev", F.coalesce(prev, F.lit("")))
    start = (F.col("line") != "") & ((F.col("prev") == "") | ~same_line(F.col("line"), F.col("prev")))
    stop = (F.col("line") == "") & (F.col("prev") != "")
    edges = seen.filter(~F.col("fade") & (start | stop)).select(
        "g", "shard", "o", "at", start.alias("opens"), "total",
        F.struct((F.col("l_n") + F.col("c_n")).alias("n"), (F.col("l_w") + F.col("c_w")).alias("w"), F.coalesce("l_end", "c_end").alias("end")).alias("before"),
    )
    # The boundaries are read twice below; they are few and narrow, the comparisons behind them are not.
    linked = lead_over(cut(edges), ["g"], "shard", ["o"], F.col("before"), "nxt").filter("opens").withColumn("until", F.coalesce("nxt", "total"))
    return linked.select(
        F.col("g").alias(group), F.col("o").alias("first_no"), F.col("until.end.o").alias("last_no"),
        (F.col("until.n") - F.col("before.n")).alias("n_records"), (F.col("until.w") - F.col("before.w")).alias("n_weight"),
        F.col("at").alias("first_at"), F.col("until.end.at").alias("last_at"),
    )
