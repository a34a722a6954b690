"""Entity maps: normalise, merge, overlay, last wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_entries(df: DataFrame) -> DataFrame:
    """Aliases without nulls, blanks, the name itself and doubles, sorted; an empty English name becomes null."""
    keep = F.filter(F.coalesce("aliases", F.array()), lambda x: x.isNotNull() & (x != "") & (x != F.col("canonical")))
    return df.withColumns({"aliases": F.array_sort(F.array_distinct(keep)), "canonical_en": F.nullif("canonical_en", F.lit(""))})


def merge_entities(df: DataFrame, keys: Sequence[str] = ("drama", "canonical"), order: str = "batch_index") -> DataFrame:
    """One row an entity: united sorted aliases and variants, the first English name in batch order.

    Aliases are made distinct before they are collected, so a name repeated in many batches stays small.
    """
    keys = list(keys)
    rows = normalise_entries(df)
    first = rows.groupBy(*keys).agg(F.min_by("canonical_en", F.when(F.col("canonical_en").isNotNull(), F.col(order))).alias("canonical_en"))
    out = first
    for c in ("aliases", "ocr_en_variants"):
        united = rows.select(*keys, F.explode(c).alias("x")).filter("x is not null").distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("x")).alias(c))
        out = out.join(united, keys, "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out


def overlay(df: DataFrame, keys: Sequence[str], value: str, priority: str) -> DataFrame:
    """The value of the highest priority per key; ties go to the greater value."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(priority, value)).alias(value))


def last_wins(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    box = F.max_by(F.struct(*values), order).alias("x")
    return df.groupBy(*keys).agg(box).select(*keys, *[F.col(f"x.{v}").alias(v) for v in values])
