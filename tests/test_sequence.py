from __future__ import annotations

import random

from pyspark.sql import functions as F

from framewright.operators import sequence as sq
from framewright.operators import sharding as sh


def test_sharded_scans(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), k, rnd.choice([None, 1, 2, 5])) for k in range(80)]
    df = spark.createDataFrame(rows, "g string, o int, v int").withColumn("s", F.expr("o div 7"))
    got = {r.o: r for r in sh.running_sum(sh.fill_before(sh.lead_over(df, ["g"], "s", ["o"], F.col("o"), "nxt"), ["g"], "s", ["o"], F.col("v"), "prev"), ["g"], "s", ["o"], F.col("v"), "tot").collect()}
    for g in "ab":
        mine = [r for r in rows if r[0] == g]
        for i, (_, o, v) in enumerate(mine):
            before = [x for _, _, x in mine[:i] if x is not None]
            assert got[o].nxt == (mine[i + 1][1] if i + 1 < len(mine) else None)
            assert got[o].prev == (before[-1] if before else None)
            assert got[o].tot == sum(x or 0 for _, _, x in mine[: i + 1])


def merged(spark, f, rows, **kw):
    df = spark.createDataFrame([("e", k, *r, 0) for k, r in enumerate(rows)], "ep string, n int, s long, e long, t string, c long")
    return sorted((r.s, r.e, r.t) for r in f(df, ["ep"], "n", "s", "e", "t", **kw).collect())


def test_artifacts(spark):
    assert merged(spark, sq.merge_artifacts, [(1000, 1100, "a"), (1200, 3000, "a")]) == [(1000, 3000, "a")]
    assert merged(spark, sq.merge_artifacts, [(1000, 2000, "a"), (4500, 5500, "a")]) == [(1000, 5500, "a")]
    assert merged(spark, sq.merge_artifacts, [(1000, 2000, "a"), (5001, 6000, "a"), (6000, 7000, "b")]) == [(1000, 2000, "a"), (5001, 6000, "a"), (6000, 7000, "b")]


def test_short_fragments(spark):
    assert merged(spark, sq.merge_short, [(1000, 1200, "你"), (1200, 3000, "好世界")]) == [(1000, 3000, "你好世界")]
    assert merged(spark, sq.merge_short, [(0, 100, "A"), (100, 200, "B"), (200, 2000, "C")]) == [(0, 2000, "A B C")]
    assert merged(spark, sq.merge_short, [(0, 100, "A"), (100, 200, "A"), (200, 300, "B"), (300, 2100, "C")]) == [(0, 2100, "A B C")]


def test_blocks(spark):
    got = merged(spark, sq.dedup_blocks, [(0, 1000, "hello there"), (1200, 2000, "hello there!"), (2601, 3000, "hello there"), (3000, 4000, "other")], conf="c")
    assert [(a, e) for a, e, _ in got] == [(0, 2000), (2601, 3000), (3000, 4000)]


def test_similarity_runs(spark):
    rows = [("e", 0, 0, "zz", 3000), ("e", 1, 200, "Hello world", 8000), ("e", 2, 400, "hel", 3000), ("e", 3, 600, "Hello wor1d", 9900), ("e", 4, 800, None, 0), ("e", 5, 1000, "Hello world", 8000), ("e", 6, 1200, "Bye", 9000), ("e", 7, 1400, "Bye", 9000)]
    df = spark.createDataFrame(rows, "ep string, o int, t long, x string, c long")
    got = sorted((r.start_ms, r.end_ms, r.text, r.n_frames, r.n_normal) for r in sq.similarity_runs(df, ["ep"], "o", "t", "x", "c").collect())
    assert got == [(200, 800, "Hello wor1d", 3, 2), (1200, 1600, "Bye", 2, 2)]


def test_stale_context(spark):
    rnd = random.Random(6)
    rows = [("e", k, rnd.choice("abcdefgh"), rnd.choice(["", "a", "b", "c", "d"]), rnd.random() < 0.9, False) for k in range(300)]
    masters, contexts, want = [], [], {}
    for _, k, m, x, ok, _ in rows:
        keep = ok and x != ""
        if keep and x != m and (x in masters[-5:] or x in [y for y in contexts[-5:] if y]):
            keep = False
        masters.append(m)
        contexts.append(x if keep else "")
        want[k] = x if keep else ""
    df = spark.createDataFrame(rows, "ep string, idx int, m string, c string, a boolean, r boolean")
    got = {r.idx: r.context_kept for r in sq.stale_context(df, ["ep"], "idx", "m", "c", "a", "r", chunk=70).collect()}
    assert got == want


def test_stale_context_ends_of_chunks(spark):
    rnd = random.Random(8)
    rows = [("e", k, rnd.choice("xyz"), "w", True, False) for k in range(700)] + [("f", k, rnd.choice("abw"), rnd.choice(["w", "w", "w", "a", None]), rnd.random() < 0.95, False) for k in range(500)]
    rows += [(None, k, "x", "w", True, False) for k in range(45)]
    want = {}
    for ep in ("e", "f", None):
        masters, contexts = [], []
        for _, k, m, x, ok, _ in [r for r in rows if r[0] == ep]:
            x = (x or "") if ok else ""
            if x and x != m and (x in masters[-5:] or x in contexts[-5:]):
                x = ""
            masters.append(m)
            contexts.append(x)
            want[ep, k] = x
    df = spark.createDataFrame(rows, "ep string, idx int, m string, c string, a boolean, r boolean")
    for chunk in (20, 200, 2000):
        assert {(r.ep, r.idx): r.context_kept for r in sq.stale_context(df, ["ep"], "idx", "m", "c", "a", "r", chunk=chunk).collect()} == want


def test_continuation_repair(spark):
    said = ["Are you planning.", "To give the company away for free?", "I know.", "To be honest, why?", "You came.", "Don't you see me!", "Go.", "To stop him.", "He left.", "And why?", "She can.", "can't she?", "Late.", "Won't you?", "Stay.", None, "Isn't it?"]
    gaps = {13: 501, 11: 500}
    rows, at = [], 0
    for k, t in enumerate(said):
        at += gaps.get(k, 100)
        rows.append(("e", k, at, at + 1000, t))
        at += 1000
    rows += [("f", 0, None, None, "So."), ("f", 1, 10, 20, "To go?")]
    df = spark.createDataFrame(rows, "ep string, id int, s long, e long, t string")
    got = {(r.ep, r.id): r.t for r in sq.continuation_repair(df, ["ep"], "id", "s", "e", "t").collect()}
    want = {(r[0], r[1]): r[4] for r in rows} | {("e", 0): "Are you planning", ("e", 1): "to give the company away for free?", ("e", 4): "You came", ("e", 5): "don't you see me!", ("e", 10): "She can"}
    assert got == want
