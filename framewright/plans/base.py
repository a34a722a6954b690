"""Inputs of the registered queries: one record a key, times in whole milliseconds; and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.session import ms, table


def _timed(spark: SparkSession, sf_dir: str, name: str, key: list[str]) -> DataFrame:
    df = table(spark, sf_dir, name).dropDuplicates(key)
    return df.withColumns({"start_ms": ms(F.col("start_s")), "end_ms": ms(F.col("end_s"))}).drop("start_s", "end_s", "loaded_at")


def asr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir, "asr_segment", ["ep_id", "id"])


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir, "ocr_block", ["ep_id", "block_no"]).withColumn("conf", F.round(F.col("avg_confidence") * 10000).cast("bigint"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir, "ocr_segment", ["ep_id", "id"])


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir, "aligned_segment", ["ep_id", "idx"])


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "ocr_frame").dropDuplicates(["ep_id", "ordinal"])
    conf = F.round(F.coalesce(F.nanvl("avg_confidence", F.lit(0.0)), F.lit(0.0)) * 10000).cast("bigint")
    return df.withColumns({"t_ms": ms(F.col("frame_time")), "conf": conf}).drop("loaded_at", "frame_time")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").dropDuplicates(["doc_id"])


def ad_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ad_copy").dropDuplicates(["copy_id"])


def _cte(name: str, source: str, key: str, columns: str) -> str:
    return f"{name} AS (SELECT DISTINCT ON ({key}) {key}, CAST(round(start_s * 1000) AS BIGINT) AS start_ms, CAST(round(end_s * 1000) AS BIGINT) AS end_ms, {columns} FROM {source})"


ASR = _cte("asr", "asr_segment", "ep_id, id", "text, avg_probability, hallucination_risk, words")
BLK = _cte("blk", "ocr_block", "ep_id, block_no", "combined_text, avg_confidence, frame_count, CAST(round(avg_confidence * 10000) AS BIGINT) AS conf")
SEG = _cte("seg", "ocr_segment", "ep_id, id", "raw_text, normalized_text, avg_confidence, frame_count")
ALN = _cte("aln", "aligned_segment", "ep_id, idx", "segment_id, master_text, master_source, master_confidence, hallucination_risk, context_text, context_source, context_available")
FRM = "frm AS (SELECT DISTINCT ON (ep_id, ordinal) ep_id, ordinal, CAST(round(frame_time * 1000) AS BIGINT) AS t_ms, combined_text, CAST(round(coalesce(CASE WHEN isnan(avg_confidence) THEN 0 ELSE avg_confidence END, 0) * 10000) AS BIGINT) AS conf, frame_lines FROM ocr_frame)"
DOC = "doc AS (SELECT DISTINCT ON (doc_id) * FROM documents)"
ADS = "ads AS (SELECT DISTINCT ON (copy_id) * FROM ad_copy)"
