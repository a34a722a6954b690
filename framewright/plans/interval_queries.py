"""Registered queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators.intervals import periods_and_gaps
from framewright.session import ms, table

MAX_GAP_MS = 600_000


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered periods and short gaps of both tracks of every episode."""

    def track(name: str, label: str) -> DataFrame:
        return table(spark, sf_dir, name).select("ep_id", F.lit(label).alias("track"), ms(F.col("start_s")).alias("a"), ms(F.col("end_s")).alias("b"))

    both = track("aligned_segment", "aligned").unionByName(track("ocr_segment", "ocr"))
    return periods_and_gaps(both, ["ep_id", "track"], "a", "b", MAX_GAP_MS).select("ep_id", "track", "kind", "start_ms", "end_ms")


P2_SQL = """
WITH iv AS (
  SELECT DISTINCT ep_id, track, s, e FROM (
    SELECT ep_id, 'aligned' AS track, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e FROM aligned_segment
    UNION ALL
    SELECT ep_id, 'ocr', CAST(round(start_s * 1000) AS BIGINT), CAST(round(end_s * 1000) AS BIGINT) FROM ocr_segment) x
  WHERE s IS NOT NULL AND e > s),
top AS (SELECT *, max(e) OVER (PARTITION BY ep_id, track ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM iv),
isl AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY ep_id, track ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM top),
per AS (SELECT ep_id, track, min(s) AS s, max(e) AS e FROM isl GROUP BY ep_id, track, g),
nx AS (SELECT *, lead(s) OVER (PARTITION BY ep_id, track ORDER BY s) AS n FROM per)
SELECT ep_id, track, 'period' AS kind, s AS start_ms, e AS end_ms FROM per
UNION ALL
SELECT ep_id, track, 'gap', e, n FROM nx WHERE n - e < 600000
"""

QUERIES = {"p2_found": p2_found}
ORACLE_SQL = {"p2_found": P2_SQL}
