"""Matching records by nearest time (problem 7).

Expanding-ring joins: both sides are bucketed by a fine width; a left row meets its own and the adjacent buckets and
keeps its nearest right row if that is no farther than the width (everything nearer lies in those buckets, so the match
is proven). Unresolved left rows go on with doubled buckets up to the tolerance.

Defined cases: a null group, time or id takes no part; equal distances go to the lowest right id; repeated keys are one
record; an empty side gives no rows; times are integers, so distances are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.session import cut


def nearest_within(left: DataFrame, right: DataFrame, tolerance: int, first_width: int) -> DataFrame:
    """Columns g, id, match. Both inputs have g, id, t (BIGINT); ``tolerance`` and widths are in the unit of t."""
    todo = left.select("g", "id", "t").filter("g is not null and id is not null and t is not null")
    right = right.select("g", F.col("id").alias("rid"), F.col("t").alias("rt")).filter("g is not null and rid is not null and rt is not null")
    width, found = min(first_width, tolerance), None
    while True:
        b = lambda c, shift=0: F.expr(f"cast(floor({c} / {width}D) as bigint) + {shift}")  # noqa: E731, B023
        spread = todo.select("g", "id", "t", F.explode(F.array(b("t", -1), b("t"), b("t", 1))).alias("bucket"))
        ring = right.withColumn("bucket", b("rt"))
        met = spread.join(ring, ["g", "bucket"], "left")
        gap = F.abs(F.col("t") - F.col("rt"))
        best = met.groupBy("g", "id").agg(F.first("t").alias("t"), F.min(F.when(gap <= width, F.struct(gap.alias("d"), F.col("rid")))).alias("best"))
        last = width >= tolerance
        if not last:
            best = cut(best)
        hit = best.filter("best is not null").select("g", "id", F.col("best.rid").alias("match"))
        found = hit if found is None else found.unionByName(hit)
        if last:
            return found
        todo, width = best.filter("best is null").select("g", "id", "t"), min(2 * width, tolerance)
