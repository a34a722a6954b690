"""Visually identical text with different characters (problem 1).

``canonical_form`` brings text to one form: compatibility normalisation in composed form, look-alike letters mapped
wherever they stand (so that a word compares equal however its letters are mixed; the form is for comparison, not for
reading), full case folding, white space mapped to a plain space, default-ignorable characters removed. ``look_key`` keeps what a viewer sees (case, accents, raised and circled digits, signs) and drops only what a
viewer cannot see, so equal keys mean equal looks. Both run once per distinct value of a batch.

Defined cases: null gives null; an empty or blank text gives an empty text; texts of any length are processed whole;
repeated rows give the same form.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from framewright.operators.sharding import distinct_in_shard

# Default-ignorable code points (fixed values, Unicode DerivedCoreProperties).
IGNORABLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￸\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
_IGNORABLE = re.compile(f"[{IGNORABLE}]")
_SPACE = re.compile(r"[\s   -     　]+")

# Letters of other scripts drawn like Latin letters (fixed values).
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ү": "y", "ɡ": "g", "ɑ": "a", "ı": "ı",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T", "Ꮪ": "S", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "զ": "q", "ց": "g", "Տ": "S", "Օ": "O",
    "‐": "-", "‑": "-", "‒": "-", "−": "-", "ʼ": "’",
}
_LOOK = str.maketrans(LOOKALIKES)
# Compatibility forms with the look of their target: width forms, radicals, ligatures, presentation forms, ideographs.
_SAME_LOOK = re.compile("[⺀-⿟　ﬀ-ﬆ︰-﹏！-￮豈-﫿\U0002f800-\U0002fa1fΩKÅ․‥…Ǆ-ǌĲĳ\U0001d400-\U0001d7ff]+")


def _strip(text: str) -> str:
    return _SPACE.sub(" ", _IGNORABLE.sub("", text)).strip()


def canonical_value(text: str) -> str:
    """The consistent form used for comparisons regardless of case."""
    t = unicodedata.normalize("NFKC", _IGNORABLE.sub("", text))
    t = unicodedata.normalize("NFC", unicodedata.normalize("NFD", t.translate(_LOOK)).translate(_LOOK))
    t = unicodedata.normalize("NFKC", t.casefold())
    return _strip(t)


def look_value(text: str) -> str:
    """What a viewer sees: equal for texts that differ only in invisible characters or in how a look is encoded."""
    t = _SAME_LOOK.sub(lambda m: unicodedata.normalize("NFKC", m.group()), _IGNORABLE.sub("", text))
    t = unicodedata.normalize("NFD", t).translate(_LOOK)
    return _strip(unicodedata.normalize("NFC", t))


def per_distinct(values: pd.Series, f: Callable[[str], str]) -> pd.Series:
    """Apply ``f`` once to each distinct value of a batch; nulls stay null."""
    codes, uniques = pd.factorize(values, use_na_sentinel=True)
    done = [f(u) for u in uniques]
    return pd.Series([done[c] if c >= 0 else None for c in codes], index=values.index, dtype=object)


@F.pandas_udf(StringType())
def _canonical(values: pd.Series) -> pd.Series:
    return per_distinct(values, canonical_value)


@F.pandas_udf(StringType())
def _look(values: pd.Series) -> pd.Series:
    return per_distinct(values, look_value)


def canonical_form(text: Column) -> Column:
    return _canonical(text)


def look_key(text: Column) -> Column:
    return _look(text)


def same_look_pairs(df: DataFrame, group: str, id_col: str, at: str, text: str, within_ms: int, chunk: int = 1000) -> DataFrame:
    """Pairs (group, id_a, id_b) of different texts with one look whose times are at most ``within_ms`` apart.

    Records meet by (group, look, time bucket) and only across different texts: the right side holds, per text, lists of
    at most ``chunk`` consecutive ids, so a text repeated without variants makes no candidates at all.
    """
    rows = df.select(F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(at).cast("bigint").alias("t"), F.col(text).alias("raw"))
    rows = rows.filter("t is not null and raw is not null").withColumn("shard", F.expr(f"cast(floor(id / {chunk}D) as bigint)"))
    rows = distinct_in_shard(rows, ["g", "shard"], ["g", "id"]).withColumn("look", look_key(F.col("raw"))).filter("look <> ''")
    rows = rows.withColumn("bucket", F.expr(f"cast(floor(t / {within_ms}D) as bigint)"))
    lists = rows.groupBy("g", "look", "bucket", "raw", "shard").agg(F.collect_list(F.struct("t", "id")).alias("items"))
    left = rows.select("g", "look", "raw", "id", "t", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket"))
    right = lists.select("g", "look", "bucket", F.col("raw").alias("other"), "items")
    met = left.join(right, ["g", "look", "bucket"]).filter("raw <> other")
    pairs = met.select("g", "id", "t", F.explode("items").alias("o")).filter((F.col("id") < F.col("o.id")) & (F.abs(F.col("t") - F.col("o.t")) <= within_ms))
    return pairs.select(F.col("g").alias(group), F.col("id").alias("id_a"), F.col("o.id").alias("id_b"))
