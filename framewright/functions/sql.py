"""Functions for SQL text: a table function over subtitle documents and the similarity ratio."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from framewright.operators.sequence import similarity


class SubtitleBlocks:
    """``srt_blocks(text)``: position, times and text of each block, for LATERAL use."""

    def eval(self, text: str) -> Iterator[tuple]:
        blocks = [x for x in (text or "").replace("\r\n", "\n").replace("\r", "\n").strip("﻿\n").split("\n\n") if x.strip("\n")]
        for pos, block in enumerate(blocks):
            lines = block.strip("\n").split("\n")
            if len(lines) >= 3 and " --> " in lines[1]:
                start, end = lines[1].split(" --> ", 1)
                yield pos, start, end, "\n".join(lines[2:])


def register(spark: SparkSession) -> None:
    """Make ``srt_blocks`` and ``text_ratio`` known to SQL in this session."""
    spark.udtf.register("srt_blocks", udtf(SubtitleBlocks, returnType="pos int, start string, end string, text string"))
    spark.udf.register("text_ratio", similarity)
