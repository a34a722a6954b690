"""Sinks. The commit protocol makes each write atomic; guards keep good data from being replaced by nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.text import escape_markup
from framewright.functions.timecode import srt_time
from framewright.operators.sequence import number_rows


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_if_rows(df: DataFrame, path: str, form: str = "parquet") -> bool:
    """Overwrite only if there is a row; whether it was written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(form).save(path)
    return True


def write_if_absent(df: DataFrame, path: str, form: str = "json") -> None:
    df.write.mode("ignore").format(form).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; the first column name carries a byte order mark, for spreadsheet programs."""
    first = df.columns[0]
    df.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_subtitles(df: DataFrame, path: str, slice_rows: int = 2000) -> None:
    """Subtitle text per lang and ep_id from (lang, ep_id, pos, start_ms, end_ms, text): blanks out, dense numbers.

    Slices of an episode are joined apart and written in order, so a very long episode is no single row.
    """
    rows = number_rows(df.filter(F.trim(F.coalesce("text", F.lit(""))) != ""), ["lang", "ep_id"], "pos", "no")
    block = F.format_string("%d\n%s --> %s\n%s\n", "no", srt_time(F.col("start_ms")), srt_time(F.col("end_ms")), "text")
    part = F.floor((F.col("no") - 1) / slice_rows).cast("bigint")
    joined = rows.groupBy("lang", "ep_id", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("no", block.alias("b")))).alias("x"))
    text = joined.select("lang", "ep_id", "part", F.array_join(F.transform("x", lambda x: x["b"]), "\n").alias("value"))
    text.repartition("lang", "ep_id").sortWithinPartitions("lang", "ep_id", "part").drop("part").write.mode("overwrite").partitionBy("lang", "ep_id").text(path)


def merge_report(new: DataFrame, path: str) -> None:
    """Read, modify, write: the failures (key, reason) of ``new`` join those at ``path``; of one key and reason the first stays.

    Each state of the report is a folder of its own, complete before the next reader sees it: the highest number holds. A
    missing report begins empty.
    """
    spark = new.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath().getName() for s in fs.listStatus(fs_path)] if fs.exists(fs_path) else []
    numbers = [int(n.split("=")[1]) for n in done if n.startswith("state=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    rows = new.select("key", "reason")
    if numbers:
        rows = spark.read.json(f"{path}/state={max(numbers)}", schema="key string, reason string").unionByName(rows)
    rows.filter("key is not null").dropDuplicates(["key", "reason"]).write.mode("overwrite").json(f"{path}/state={max(numbers, default=-1) + 1}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report's latest complete state."""
    rows = spark.read.option("basePath", path).json(f"{path}/state=*", schema="key string, reason string, state int")
    return rows.filter(F.col("state") == rows.agg(F.max("state")).first()[0]).drop("state")


def write_page(df: DataFrame, path: str, title: str) -> None:
    """Rows as lines of an HTML table, every value escaped; parts of the table in order of the files, head and foot in the first and last line's place."""
    cells = F.concat(*[F.concat(F.lit("<td>"), escape_markup(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in df.columns])
    head = "<!doctype html><meta charset=utf-8><title>%s</title><table><tr>%s</tr>" % tuple(_escaped(x) if i == 0 else x for i, x in enumerate((title, "".join(f"<th>{_escaped(c)}</th>" for c in df.columns))))
    rows = df.select(F.lit(1).alias("part"), F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("value"))
    ends = df.sparkSession.createDataFrame([(0, head), (2, "</table>")], "part int, value string")
    rows.unionByName(ends).repartitionByRange("part").sortWithinPartitions("part").select("value").write.mode("overwrite").text(path)


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
