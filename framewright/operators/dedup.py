"""One row a key without moving the other columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_REPEATED = 100_000  # repeated keys that are still broadcast


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with distinct non-null ``keys``; of equal keys one row stays.

    Keys are counted first, which reads and shuffles nothing but the keys. Mostly none repeats and the rows stay where
    they are; up to ``MOST_REPEATED`` repeated keys are broadcast and only their rows are shuffled; beyond that all rows are.
    """
    keys = list(keys)
    rows = df
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    repeated = rows.groupBy(*keys).count().filter("count > 1").select(*keys)
    n = repeated.limit(MOST_REPEATED + 1).count()
    if n == 0:
        return rows
    if n > MOST_REPEATED:
        return rows.dropDuplicates(keys)
    few = F.broadcast(repeated)
    return rows.join(few, keys, "left_anti").unionByName(rows.join(few, keys, "left_semi").dropDuplicates(keys).select(*rows.columns))
