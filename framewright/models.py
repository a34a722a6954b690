"""The model boundary: speech recognition, text recognition and language models are tables in, tables out.

A provider maps a batch of prompts to answers. It is called once an Arrow batch inside the executors, with retries for
passing faults; the default provider is a deterministic stub.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Provider = Callable[[list[str], list[str]], list[str]]


class PassingFault(Exception):
    """A fault worth another try: too many requests, a lost connection, a server fault."""


def stub(system: list[str], user: list[str]) -> list[str]:
    return [hashlib.sha256(f"{s}\n{u}".encode()).hexdigest()[:16] for s, u in zip(system, user)]


def complete(df: DataFrame, key: str, system: str, user: str, provider: Provider = stub, attempts: int = 5, first_wait: float = 1.0) -> DataFrame:
    """``key``, answer and n_tries for every row; an answer is null after the last try of a passing fault, other faults fail the task."""
    kind = dict(df.dtypes)[key]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, tries = [None] * len(b), 0
            while tries < attempts:
                tries += 1
                try:
                    out = provider(b["s"].tolist(), b["u"].tolist())
                    break
                except PassingFault:
                    if tries < attempts:
                        time.sleep(min(60.0, first_wait * 2 ** (tries - 1)))
            yield pd.DataFrame({"k": b["k"], "answer": out, "n_tries": tries})

    rows = df.selectExpr(f"`{key}` as k", f"`{system}` as s", f"`{user}` as u")
    return rows.mapInPandas(ask, f"k {kind}, answer string, n_tries int").withColumnRenamed("k", key)


def map_then_reduce(parts: DataFrame, group: str, part: str, text: str, map_prompt: str, reduce_prompt: str, provider: Provider = stub) -> DataFrame:
    """One answer a part, then one a group over the answers of its parts in order: columns ``group``, n_parts, answer.

    A part without an answer is left out of the reduction. A group's answers are one prompt, so they are bounded by what a
    model can read.
    """
    asked = parts.select(F.struct(group, part).alias("key"), F.lit(map_prompt).alias("system"), F.col(text).alias("user"))
    answers = complete(asked, "key", "system", "user", provider).filter("answer is not null")
    joined = answers.groupBy(F.col(f"key.{group}").alias(group)).agg(F.array_sort(F.collect_list(F.struct(F.col(f"key.{part}").alias("p"), "answer"))).alias("x"))
    joined = joined.select(group, F.size("x").alias("n_parts"), F.array_join(F.transform("x", lambda r: r["answer"]), "\n").alias("user"), F.lit(reduce_prompt).alias("system"))
    return joined.select(group, "n_parts").join(complete(joined, group, "system", "user", provider).select(group, "answer"), group)


def refine_steps(df: DataFrame, key: str, text: str, steps: Sequence[str], provider: Provider = stub) -> DataFrame:
    """Each step's prompt is asked about the answer before; a missing answer falls back to the text it was asked about. Columns ``key``, text."""
    rows = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    for prompt in steps:
        answers = complete(rows.withColumn("system", F.lit(prompt)), key, "system", "text", provider)
        rows = rows.join(answers.select(key, "answer"), key).select(key, F.coalesce("answer", "text").alias("text"))
    return rows


def translate(df: DataFrame, key: str, text: str, languages: Sequence[str], skeleton: str, refine: str, minor: str, provider: Provider = stub) -> DataFrame:
    """A skeleton and its refinement, then every further language from the refined text, in long form: ``key``, lang, text."""
    first = refine_steps(df, key, text, [skeleton, refine], provider)
    each = first.select(key, "text", F.explode(F.array(*map(F.lit, languages))).alias("lang"))
    asked = each.select(F.struct(key, "lang").alias("key"), F.concat(F.lit(minor + " "), "lang").alias("system"), F.col("text").alias("user"))
    answers = complete(asked, "key", "system", "user", provider)
    return answers.select(F.col(f"key.{key}").alias(key), F.col("key.lang").alias("lang"), F.coalesce("answer", F.lit("")).alias("text")).unionByName(first.select(key, F.lit("en").alias("lang"), "text"))


def fill_names(names: DataFrame, key: str, name: str, known: str, prompt: str, provider: Provider = stub) -> DataFrame:
    """Names that already have a form keep it, the others are asked: ``key``, form, asked."""
    open_ones = names.filter(F.trim(F.coalesce(F.col(known), F.lit(""))) == "").select(key, F.col(name).alias("user"), F.lit(prompt).alias("system"))
    answers = complete(open_ones, key, "system", "user", provider).select(key, F.coalesce("answer", F.lit("")).alias("form"), F.lit(True).alias("asked"))
    kept = names.filter(F.trim(F.coalesce(F.col(known), F.lit(""))) != "").select(key, F.col(known).alias("form"), F.lit(False).alias("asked"))
    return kept.unionByName(answers)
