"""Subtitle documents: parse, validate, render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.timecode import parse_time, srt_time

STAMP = r"(\d{2,}:\d{2}:\d{2},\d{3}) --> (\d{2,}:\d{2}:\d{2},\d{3})"


def _blocks(text: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "^﻿", "")
    return F.filter(F.split(F.trim(F.regexp_replace(t, r"^\n+|\n+$", "")), r"\n\n+"), lambda x: x != "")


def parse_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Block grammar: blocks between blank lines, at least three lines, strict arrow; text keeps its lines."""
    rows = docs.select(key, F.posexplode(_blocks(F.col(text))).alias("pos", "block")).withColumn("lines", F.split("block", "\n"))
    rows = rows.filter((F.size("lines") >= 3) & F.get("lines", F.lit(1)).rlike(f"^{STAMP}$"))
    stamp = F.get("lines", F.lit(1))
    return rows.select(key, F.col("pos").alias("pos"), parse_time(F.regexp_extract(stamp, STAMP, 1)).alias("start_ms"), parse_time(F.regexp_extract(stamp, STAMP, 2)).alias("end_ms"), F.array_join(F.slice("lines", F.lit(3), F.size("lines")), "\n").alias("text"))


def scan_stamps(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Scan grammar: every time line anywhere, spaces around the arrow free, comma or point."""
    pattern = r"(\d{2,}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{2,}:\d{2}:\d{2}[,.]\d{3})"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("b"))
    rows = docs.select(key, F.posexplode(pairs).alias("pos", "x"))
    return rows.select(key, "pos", parse_time(F.col("x.a")).alias("start_ms"), parse_time(F.col("x.b")).alias("end_ms"))


def dialogue_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Lines that are no index, no time line and not blank."""
    lines = docs.select(key, F.posexplode(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")).alias("line_no", "line"))
    return lines.filter(~F.col("line").rlike(r"^\s*$|^\s*\d+\s*$|-->")).select(key, "line_no", F.trim("line").alias("line"))


def violation(text: Column) -> Column:
    """Code of the first violation of a subtitle document, null if there is none."""
    blocks = _blocks(text)

    def check(block: Column, at: Column) -> Column:
        lines = F.split(block, "\n")
        stamp = F.get(lines, F.lit(1))
        body = F.slice(lines, F.lit(3), F.greatest(F.lit(0), F.size(lines) - 2))
        first = F.trim(F.get(lines, F.lit(0)))
        return (
            F.when(~first.rlike(r"^\d+$"), "index_not_digits")
            .when((first.try_cast("bigint") != at + 1) | first.try_cast("bigint").isNull(), "index_out_of_order")
            .when(stamp.isNull() | ~stamp.contains("-->"), "no_timestamp")
            .when(~stamp.rlike(f"^{STAMP}\\s*$"), "bad_timestamp")
            .when(parse_time(F.regexp_extract(stamp, STAMP, 2)) <= parse_time(F.regexp_extract(stamp, STAMP, 1)), "end_not_after_start")
            .when(~F.exists(body, lambda x: F.trim(x) != ""), "no_text")
            .when(F.exists(body, lambda x: x.rlike(STAMP)), "stuck_block")
        )

    found = F.get(F.filter(F.transform(blocks, check), lambda c: c.isNotNull()), F.lit(0))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "document_empty").when(F.size(blocks) == 0, "no_blocks").otherwise(found)


def render(start: Column, end: Column, no: Column, text: Column) -> Column:
    return F.format_string("%d\n%s --> %s\n%s\n", no, srt_time(start), srt_time(end), text)
