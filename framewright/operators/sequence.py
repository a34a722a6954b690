"""Ordered-sequence operators over groups of any size: runs, clipping, numbering, guards, budgets, splits, folds."""

from __future__ import annotations

import difflib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from framewright.functions.text import normalise_line
from framewright.operators.sharding import fill_before, lead_over, running_sum

SHARD = 4096


def with_shard(df: DataFrame, order: str, rows: int = SHARD) -> DataFrame:
    return df.withColumn("__s", F.expr(f"cast(floor({order} / {rows}D) as bigint)"))


def number_rows(df: DataFrame, keys: Sequence[str], order: str, name: str, first: int = 1) -> DataFrame:
    """Dense numbers in order within each group."""
    return running_sum(with_shard(df, order), keys, "__s", [order], F.lit(1), name).withColumn(name, (F.col(name) - 1 + first).cast("bigint")).drop("__s")


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    return running_sum(with_shard(df, order), keys, "__s", [order], value, name).drop("__s")


def previous(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """``value`` of the row before, as a struct field v (null before the first row)."""
    return fill_before(with_shard(df, order), keys, "__s", [order], F.struct(value.alias("v")), name).drop("__s")


def following(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    return lead_over(with_shard(df, order), keys, "__s", [order], value, name).drop("__s")


def chains(df: DataFrame, keys: Sequence[str], order: str, starts: Column, name: str) -> DataFrame:
    """Number the islands that begin where ``starts`` holds."""
    return running_total(df, keys, order, F.when(starts, 1).otherwise(0), name)


CHAINS_A_GROUP = 256


def fold_chains(rows: DataFrame, keys: Sequence[str], order: str, fold: Callable[[pd.DataFrame], list[list]], schema: str) -> DataFrame:
    """Run ``fold`` over each chain (``__c``) of rows in order; neighbouring chains share a group, as a group has a cost."""
    names = [part.strip().split(" ")[0].strip("`") for part in schema.split(",")]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["__c", order])
        edges = [0, *(np.flatnonzero(np.diff(g["__c"].to_numpy())) + 1), len(g)]
        return pd.DataFrame([r for a, z in zip(edges, edges[1:]) for r in fold(g.iloc[a:z])], columns=names)

    grouped = rows.withColumn("__g", F.floor(F.col("__c") / CHAINS_A_GROUP).cast("bigint")).groupBy(*keys, "__g")
    return grouped.applyInPandas(run, schema)


def equality_runs(df: DataFrame, keys: Sequence[str], order: str, at: str, text: str, conf: str, step_ms: int = 500) -> DataFrame:
    """Runs of equal text (trimmed, lower case); a blank record breaks a run. First text, first and last time plus a step, mean score."""
    keys = list(keys)
    rows = df.withColumn("__line", F.lower(F.trim(F.coalesce(text, F.lit("")))))
    rows = previous(rows, keys, order, F.col("__line"), "__p")
    rows = chains(rows, keys, order, F.col("__p").isNull() | (F.col("__p.v") != F.col("__line")), "__run").filter("__line <> ''")
    out = rows.groupBy(*keys, "__run").agg(
        F.min(at).alias("start_ms"), (F.max(at) + step_ms).alias("end_ms"), F.min_by(text, order).alias("text"), F.count(F.lit(1)).alias("n_frames"), (F.sum(conf) / F.count(F.lit(1))).alias("mean_conf")
    )
    return out.withColumn("mean_conf", F.round("mean_conf", 2)).drop("__run")


def clip_overlaps(df: DataFrame, keys: Sequence[str], order: str, start: str, end: str) -> DataFrame:
    """No end after the next start."""
    nxt = following(df, keys, order, F.col(start), "__n")
    return nxt.withColumn(end, F.least(end, F.coalesce("__n", end))).drop("__n")


def budget_prefix(df: DataFrame, keys: Sequence[str], order: str, size: Column, budget: int) -> DataFrame:
    """Rows while the running size fits; lengths are not negative, so the first overflow ends the group."""
    return running_total(df, keys, order, size, "__used").filter(F.col("__used") <= budget).drop("__used")


def adjacent_distinct(df: DataFrame, keys: Sequence[str], order: str, text: str) -> DataFrame:
    """Blank rows out; of neighbouring equal texts (trimmed) the first stays."""
    rows = df.filter(F.trim(F.coalesce(text, F.lit(""))) != "")
    prev = previous(rows, keys, order, F.trim(text), "__p")
    return prev.filter(F.col("__p").isNull() | (F.col("__p.v") != F.trim(F.col(text)))).drop("__p")


def occurrence_number(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """How many earlier rows of the group hold the same value; shards of the value's rows keep a hot value apart."""
    return running_sum(with_shard(df, order), [*keys, value], "__s", [order], F.lit(1), name).withColumn(name, F.col(name) - 1).drop("__s")


def long_split(text: Column, start: Column, end: Column, limit: int = 25, margin: int = 4, least_ms: int = 400) -> Column:
    """Array of (text, start_ms, end_ms): one part, or two around the punctuation nearest the middle.

    A split needs more than ``limit`` characters, ``margin`` on either side and ``least_ms`` for both halves; newlines go.
    """
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(""))
    n = F.length(t)
    marks = F.filter(F.sequence(F.lit(margin), n - margin), lambda i: F.substring(t, i, F.lit(1)).rlike(r"[,，.。!！?？;；:：、…]"))
    best = F.array_min(F.transform(marks, lambda i: F.struct(F.abs(2 * i - n).alias("d"), i.alias("i"))))["i"]
    cut_ms = start + F.floor((end - start) * best / n).cast("bigint")
    whole = F.array(F.struct(t.alias("text"), start.alias("start_ms"), end.alias("end_ms")))
    two = F.array(F.struct(F.substring(t, F.lit(1), best).alias("text"), start.alias("start_ms"), cut_ms.alias("end_ms")), F.struct(F.substring(t, best + 1, n).alias("text"), cut_ms.alias("start_ms"), end.alias("end_ms")))
    fits = (n > limit) & (n >= 2 * margin) & best.isNotNull() & (cut_ms - start >= least_ms) & (end - cut_ms >= least_ms)
    return F.when(F.when(n > limit, fits).otherwise(False), two).otherwise(whole)


def merge_artifacts(df: DataFrame, keys: Sequence[str], order: str, start: str, end: str, text: str, short_ms: int = 200, gap_ms: int = 3000) -> DataFrame:
    """Neighbours of one text become one if either is short or the gap small; the merged end is the later row's.

    Neighbours of one text that are close, or of which the later is short, join whatever came before; such stretches are
    aggregated first. Only the borders between stretches ask how long the merged row is by then: the fold sees one row a stretch.
    """
    keys = list(keys)
    rows = previous(df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()), keys, order, F.struct(F.col(text).alias("t"), F.col(end).alias("e")), "__p")
    other = F.col("__p").isNull() | ~F.col("__p.v.t").eqNullSafe(F.col(text))
    joins = (F.col(end) - F.col(start) < short_ms) | (F.col(start) - F.col("__p.v.e") <= gap_ms)
    rows = chains(rows.withColumn("__o", other), keys, order, F.col("__o") | ~joins, "__h")
    parts = rows.groupBy(*keys, "__h").agg(F.first(text).alias(text), F.min_by(start, order).alias(start), F.max_by(end, order).alias(end), F.count(F.lit(1)).cast("int").alias("n_merged"), F.max("__o").alias("__o"))
    parts = chains(parts, keys, "__h", F.col("__o"), "__c")
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + f", {start} bigint, {end} bigint, {text} string, n_merged int"

    def fold(g: pd.DataFrame) -> list[list]:
        key, out = [g[k].iloc[0] for k in keys], []
        for s, e, t, n in zip(g[start], g[end], g[text], g["n_merged"]):
            last = out[-1] if out else None
            if last and last[1] - last[0] < short_ms:
                last[1], last[3] = e, last[3] + n
            else:
                out.append([s, e, t, n])
        return [key + r for r in out]

    return fold_chains(parts.select(*keys, "__c", "__h", start, end, text, "n_merged"), keys, "__h", fold, schema)


def ratio(a: str, b: str) -> float:
    """Sequence-matcher ratio; order matters. Both empty 1, one empty 0."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    return difflib.SequenceMatcher(None, a, b).ratio()


def alike(a: str, b: str, near: float) -> bool:
    """Whether ``ratio`` is at least ``near``; its cheap upper bounds are asked first."""
    if a == b:
        return True
    if not a or not b or 2.0 * min(len(a), len(b)) / (len(a) + len(b)) < near:
        return False
    m = difflib.SequenceMatcher(None, a, b)
    return m.quick_ratio() >= near and m.ratio() >= near


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def similarity_runs(df: DataFrame, keys: Sequence[str], order: str, at: str, text: str, conf: str, fps: int = 5, floor: int = 5500, near: float = 0.85, least_ms: int = 400) -> DataFrame:
    """Fuzzy frame runs: blank ends, faded (below ``floor``) prolongs, similar (by the normalised line) extends, better-scored text replaces.

    State feeds back only inside stretches without blanks, so those are the groups of the fold.
    """
    keys = list(keys)
    rows = df.withColumn("__blank", F.trim(F.coalesce(text, F.lit(""))) == "")
    rows = chains(rows, keys, order, F.col("__blank"), "__c").filter("not __blank").withColumn("__norm", normalise_line(F.col(text)))
    step = 1000 // fps
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + ", start_ms bigint, end_ms bigint, text string, n_frames int, n_normal int, conf_sum bigint"

    def fold(g: pd.DataFrame) -> list[list]:
        key, out, cur = [g[k].iloc[0] for k in keys], [], None
        for t, txt, c, n in zip(g[at], g[text], g[conf], g["__norm"]):
            if c < floor:
                if cur:
                    cur[1], cur[3] = t + step, cur[3] + 1
                continue
            if cur and alike(n, cur[6], near):
                cur[1] = t + step
                if c * cur[4] > cur[5]:
                    cur[2], cur[6] = txt, n
                cur[3], cur[4], cur[5] = cur[3] + 1, cur[4] + 1, cur[5] + c
            else:
                if cur:
                    out.append(key + cur[:6])
                cur = [t, t + step, txt, 1, 1, c, n]
        if cur:
            out.append(key + cur[:6])
        return out

    runs = fold_chains(rows.select(*keys, "__c", order, at, text, conf, "__norm"), keys, order, fold, schema)
    return runs.filter(F.col("end_ms") - F.col("start_ms") >= least_ms)


def dedup_blocks(df: DataFrame, keys: Sequence[str], order: str, start: str, end: str, text: str, conf: str, gap_ms: int = 600, near: float = 0.80) -> DataFrame:
    """Blocks in order of start: a close and similar block joins the one before; its end counts, the better text stays.

    The active end is always the previous block's, so chains break at wide gaps and the fold runs inside them.
    """
    keys = list(keys)
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    rows = previous(rows, keys, order, F.col(end), "__p")
    rows = chains(rows, keys, order, F.col("__p").isNull() | (F.col(start) - F.col("__p.v") > gap_ms), "__c")
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + f", {start} bigint, {end} bigint, {text} string, {conf} bigint, n_merged int"

    def fold(g: pd.DataFrame) -> list[list]:
        key, out = [g[k].iloc[0] for k in keys], []
        for s, e, t, c in zip(g[start], g[end], g[text], g[conf]):
            t = t or ""
            last = out[-1] if out else None
            if last and alike(last[2], t, near):
                last[1], last[4] = e, last[4] + 1
                if c > last[3]:
                    last[2], last[3] = t, c
            else:
                out.append([s, e, t, c, 1])
        return [key + r for r in out]

    return fold_chains(rows.select(*keys, "__c", order, start, end, text, F.coalesce(conf, F.lit(0)).alias(conf)), keys, order, fold, schema)


def merge_short(df: DataFrame, keys: Sequence[str], order: str, start: str, end: str, text: str, short_ms: int = 300) -> DataFrame:
    """Blocks below ``short_ms`` join their follower pass by pass until nothing changes; equal texts are not doubled.

    A block can only take part while it or its predecessor is short, so chains break after blocks that are long and
    follow a long one; the passes run inside chains.
    """
    keys = list(keys)
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    rows = previous(rows, keys, order, F.col(end) - F.col(start), "__p")
    rows = chains(rows, keys, order, F.col("__p").isNull() | (F.col("__p.v") >= short_ms), "__c")
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + f", {start} bigint, {end} bigint, {text} string, n_merged int"

    def join(a: str, b: str) -> str:
        if a == b:
            return a
        return a + (" " if a[-1:].isascii() and b[:1].isascii() and a and b else "") + b

    def fold(g: pd.DataFrame) -> list[list]:
        key = [g[k].iloc[0] for k in keys]
        cur = [[s, e, t or "", 1] for s, e, t in zip(g[start], g[end], g[text])]
        changed = True
        while changed:
            changed, out, i = False, [], 0
            while i < len(cur):
                a = cur[i]
                if i + 1 < len(cur) and a[1] - a[0] < short_ms:
                    b = cur[i + 1]
                    out.append([a[0], b[1], join(a[2], b[2]), a[3] + b[3]])
                    changed, i = True, i + 2
                else:
                    out.append(a)
                    i += 1
            cur = out
        return [key + r for r in cur]

    return fold_chains(rows.select(*keys, "__c", order, start, end, text), keys, order, fold, schema)


NEGATIONS = "isn|doesn|don|can|won|wouldn|couldn|shouldn|didn|wasn|weren|hasn|haven"
CONTINUES = "^(?:To (?!be )|(?:" + "|".join(f"[{w[0].upper()}{w[0]}]{w[1:]}" for w in NEGATIONS.split("|")) + ")'t )"


def continuation_repair(df: DataFrame, keys: Sequence[str], order: str, start: str, end: str, text: str, gap_ms: int = 500) -> DataFrame:
    """Sentences split over two rows: the first row's full stop goes and the second row begins in lower case.

    The second begins with an infinitive (not "To be ") or a negation and ends in ? or !; the first ends in a full stop at
    most ``gap_ms`` before. Edits never feed back, as one row must end in a stop and the other in ? or !.
    """
    keys = list(keys)
    rows = previous(df.select(*keys, order, start, end, text), keys, order, F.struct(F.col(text).alias("t"), F.col(end).alias("e")), "__p")
    second = F.col(text).rlike(CONTINUES) & F.col(text).rlike(r"[?!]\z") & F.col("__p.v.t").endswith(".") & (F.col(start) - F.col("__p.v.e") <= gap_ms)
    rows = rows.withColumn("__second", F.coalesce(second, F.lit(False)))
    rows = following(rows, keys, order, F.col("__second"), "__n")
    whole = F.when(F.col("__second"), F.concat(F.lower(F.substring(text, 1, 1)), F.expr(f"substring(`{text}`, 2)"))).when(F.coalesce("__n", F.lit(False)), F.expr(f"left(`{text}`, length(`{text}`) - 1)"))
    return rows.select(*keys, order, whole.otherwise(F.col(text)).alias(text), whole.isNotNull().alias("changed"))


def stale_context(df: DataFrame, keys: Sequence[str], order: str, master: str, context: str, available: str, risk: str, back: int = 5, chunk: int = 2000) -> DataFrame:
    """Context that repeats one of the last ``back`` masters or surviving contexts is suppressed (it then counts as empty).

    Feedback reaches ``back`` rows, so what a chunk of ``chunk`` rows (at least ``back``) takes over is which of the ``back``
    contexts before it survived. Each chunk says what it hands on for every such state, one row a chunk is scanned a group,
    and the chunks are folded from the state that holds: the result does not depend on their borders.
    """
    keys = list(keys)
    rows = number_rows(df, keys, order, "__n", first=0)
    rows = rows.withColumn("__c", F.explode(F.array_distinct(F.array(F.floor(F.col("__n") / chunk).cast("bigint"), F.floor((F.col("__n") + back) / chunk).cast("bigint")))))
    rows = rows.select(*keys, "__c", "__n", order, master, context, F.coalesce(available, F.lit(False)).alias(available))
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    named = ", ".join(f"`{k}` {fields[k]}" for k in keys)

    def parts(g: pd.DataFrame, c: int) -> tuple[pd.DataFrame, list[str], list[str], list[tuple[str, str]], int]:
        """The group in order, masters and usable contexts of the rows before the chunk, those of its rows, number of the former."""
        g = g.sort_values("__n")
        pairs = [(m or "", (x or "") if ok else "") for m, x, ok in zip(g[master], g[context], g[available])]
        n = int((g["__n"] < c * chunk).sum())
        return g, [m for m, _ in pairs[:n]], [x for _, x in pairs[:n]], pairs[n:], n

    def taken(before: list[str], state: int) -> list[str]:
        return [x if state >> (len(before) - 1 - i) & 1 else "" for i, x in enumerate(before)]

    def decide(masters: list[str], kept: list[str], body: list[tuple[str, str]], known: list[str] | None = None) -> list[str]:
        """Surviving contexts, ``kept`` before them; taken from ``known``, another run's, once ``back`` of them agree."""
        masters, kept, same = list(masters), list(kept), 0
        for i, (m, x) in enumerate(body):
            if x and x != m and (x in masters[-back:] or x in kept[-back:]):
                x = ""
            masters.append(m)
            kept.append(x)
            if known is not None:
                same = same + 1 if known[len(kept) - 1] == x else 0
                if same >= back:
                    return kept + known[len(kept) :]
        return kept

    def hands_on(g: pd.DataFrame) -> pd.DataFrame:
        c = int(g["__c"].iloc[0])
        g, masters, before, body, _ = parts(g, c)
        first = decide(masters, taken(before, 0), body)
        done: dict[tuple[str, ...], int] = {}
        out = []
        for state in range(1 << len(before)):
            start = taken(before, state)
            if tuple(start) not in done:
                end = decide(masters, start, body, first)[-back:]
                done[tuple(start)] = sum(1 << (len(end) - 1 - i) for i, x in enumerate(end) if x)
            out.append(done[tuple(start)])
        return pd.DataFrame([[*(g[k].iloc[0] for k in keys), c, out]], columns=[*keys, "__c", "to"])

    def scan(g: pd.DataFrame) -> pd.DataFrame:
        g, state, out = g.sort_values("__c"), 0, []
        for c, to in zip(g["__c"], g["to"]):
            out.append([*(g[k].iloc[0] for k in keys), c, state])
            state = int(to[state])
        return pd.DataFrame(out, columns=[*keys, "__c", "state"])

    def fold(g: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        c = int(g["__c"].iloc[0])
        g, masters, before, body, n = parts(g, c)
        kept = decide(masters, taken(before, int(s["state"].iloc[0])), body)[n:]
        return pd.DataFrame([[*(g[k].iloc[0] for k in keys), o, x] for o, x in zip(g[order].iloc[n:], kept)], columns=[*keys, order, "context_kept"])

    maps = rows.groupBy(*keys, "__c").applyInPandas(hands_on, f"{named}, __c bigint, to array<int>")
    states = maps.groupBy(*keys).applyInPandas(scan, f"{named}, __c bigint, state int")
    return rows.groupBy(*keys, "__c").cogroup(states.groupBy(*keys, "__c")).applyInPandas(fold, f"{named}, {order} {fields[order]}, context_kept string")
