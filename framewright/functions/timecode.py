"""Time codes as whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(ms: Column) -> tuple[Column, Column, Column, Column]:
    t = F.greatest(F.lit(0), ms).cast("bigint")
    whole = lambda n: F.floor(t / n).cast("bigint")
    return whole(3_600_000.0), whole(60_000.0) % 60, whole(1000.0) % 60, t % 1000


def srt_time(ms: Column) -> Column:
    """``HH:MM:SS,mmm``; negative times are 0, hours may exceed 23, all carries are exact."""
    return F.format_string("%02d:%02d:%02d,%03d", *_parts(ms))


def cut_time(ms: Column) -> Column:
    """``HH:MM:SS.mmm``."""
    return F.format_string("%02d:%02d:%02d.%03d", *_parts(ms))


def parse_time(text: Column, default: int | None = None) -> Column:
    """Milliseconds of ``HH:MM:SS,mmm`` (or a point); ``default`` where the text is something else."""
    pattern = r"^\s*(\d+):(\d{2}):(\d{2})[,.](\d{3})\s*$"
    g = lambda i: F.regexp_extract(text, pattern, i).cast("bigint")
    return F.when(text.rlike(pattern), ((g(1) * 60 + g(2)) * 60 + g(3)) * 1000 + g(4)).otherwise(F.lit(default).cast("bigint"))
