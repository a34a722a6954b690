"""Structured Streaming forms: frame runs by state, session runs, log windows, alignment of two live tracks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from framewright.functions.text import normalise_line
from framewright.operators.sequence import alike

RUN = StructType([StructField("ep_id", StringType()), StructField("start_ms", LongType()), StructField("end_ms", LongType()), StructField("text", StringType()), StructField("n_frames", IntegerType()), StructField("n_normal", IntegerType()), StructField("conf_sum", LongType())])
_STATE = "start_ms bigint, end_ms bigint, text string, n_frames int, n_normal int, conf_sum bigint, norm string, last_ord bigint"


class FrameRuns(StatefulProcessor):
    """The similarity fold over frames (ep_id, ordinal, t_ms, combined_text, conf, norm), one open run a key.

    Frames of a key must arrive in order across batches; inside a batch they are sorted. A record at or before the last
    ordinal seen (a late copy) is dropped. A run closes at a blank, at a different line, or at a record with ordinal -1.
    """

    def __init__(self, fps: int = 5, floor: int = 5500, near: float = 0.85) -> None:
        self.step, self.floor, self.near = 1000 // fps, floor, near

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows))
        got["__end"] = (got["ordinal"] < 0).astype(int)
        got = got.sort_values(["__end", "ordinal"])
        cur, last, out = None, -1, []
        if self.open.exists():
            s = list(self.open.get())
            last = s[7]
            cur = s[:7] if s[3] > 0 else None
        for o, t, txt, c, n, done in zip(got["ordinal"], got["t_ms"], got["combined_text"], got["conf"], got["norm"], got["__end"]):
            if not done and o <= last:
                continue
            last = last if done else int(o)
            blank = not isinstance(txt, str) or not txt.strip()
            if done or blank:
                if cur:
                    out.append([key[0], *cur[:6]])
                cur = None
            elif c < self.floor:
                if cur:
                    cur[1], cur[3] = int(t) + self.step, cur[3] + 1
            else:
                if cur and alike(n, cur[6], self.near):
                    cur[1] = int(t) + self.step
                    if c * cur[4] > cur[5]:
                        cur[2], cur[6] = txt, n
                    cur[3], cur[4], cur[5] = cur[3] + 1, cur[4] + 1, cur[5] + int(c)
                else:
                    if cur:
                        out.append([key[0], *cur[:6]])
                    cur = [int(t), int(t) + self.step, txt, 1, 1, int(c), n]
        self.open.update(tuple([*(cur or [0, 0, "", 0, 0, 0, ""]), last]))
        yield pd.DataFrame(out, columns=[f.name for f in RUN.fields])

    def close(self) -> None:
        pass


def frame_runs(frames: DataFrame, least_ms: int = 400) -> DataFrame:
    """Streaming twin of the batch similarity runs; needs the RocksDB state store."""
    rows = frames.select("ep_id", F.col("ordinal").cast("bigint").alias("ordinal"), "t_ms", "combined_text", "conf", normalise_line(F.col("combined_text")).alias("norm"))
    runs = rows.groupBy("ep_id").transformWithStateInPandas(statefulProcessor=FrameRuns(), outputStructType=RUN, outputMode="Append", timeMode="None")
    return runs.filter(F.col("end_ms") - F.col("start_ms") >= least_ms)


def session_runs(frames: DataFrame, at: str, gap: str = "2 seconds", late: str = "10 minutes") -> DataFrame:
    """Runs of one line as session windows: closed by time, not by another line."""
    rows = frames.withWatermark(at, late).withColumn("line", F.lower(F.trim("combined_text"))).filter("line <> ''")
    return rows.groupBy("ep_id", "line", F.session_window(at, gap)).agg(F.count(F.lit(1)).alias("n_frames")).select("ep_id", "line", F.col("session_window.start").alias("first_at"), F.col("session_window.end").alias("last_at"), "n_frames")


def log_windows(log: DataFrame, at: str, value: str, by: str, length: str = "24 hours", slide: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Sliding totals of an append-only log."""
    w = log.withWatermark(at, late).groupBy(F.window(at, length, slide), by)
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("from_at"), F.col("window.end").alias("to_at"), by, "n", "total")


def align_live(speech: DataFrame, screen: DataFrame, late: str = "10 minutes", longest: str = "6 hours") -> DataFrame:
    """Overlap join of two live tracks (ep_id, s_at, e_at, ...): event-time bounds let both sides' state be dropped.

    An interval must end within ``longest`` of its start; state is kept that long. Longer ones break that promise and make
    the query fail rather than lose their pairs.
    """
    within = lambda s, e: F.when(F.col(e) <= F.col(s) + F.expr(f"interval {longest}"), F.col(e)).when(F.col(e).isNotNull(), F.raise_error(F.lit("interval beyond the longest allowed")).cast("timestamp"))
    a = speech.withWatermark("s_at", late).select("ep_id", "id", "s_at", within("s_at", "e_at").alias("e_at"))
    k = screen.withWatermark("b_at", late).select(F.col("ep_id").alias("k_ep"), "block_no", "b_at", within("b_at", "f_at").alias("f_at"))
    cond = (F.col("ep_id") == F.col("k_ep")) & (F.col("s_at") < F.col("f_at")) & (F.col("b_at") < F.col("e_at"))
    bound = (F.col("b_at") >= F.col("s_at") - F.expr(f"interval {longest}")) & (F.col("b_at") <= F.col("s_at") + F.expr(f"interval {longest}"))
    return a.join(k, cond & bound).select("ep_id", "id", "block_no")


def write_once(df: DataFrame, path: str, checkpoint: str):
    """Start a query that writes each micro-batch idempotently under its batch id."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
