from __future__ import annotations

import random

from framewright.operators.intervals import periods_and_gaps


def brute(rows, cap):
    out = []
    for key in {r[0] for r in rows}:
        iv = sorted((s, e) for k, s, e in rows if k == key and s is not None and e is not None and e > s)
        merged = []
        for s, e in iv:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(key, "period", s, e) for s, e in merged]
        out += [(key, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:]) if b[0] - a[1] < cap]
    return sorted(out, key=repr)


def test_random_intervals(spark):
    rnd = random.Random(7)
    for size in (3, 40):
        rows = []
        for k in range(220):
            s = rnd.randrange(-300, 4000)
            rows.append((rnd.choice("abc"), s, s + rnd.choice([0, -4, 1, 5, 9, 20, 21, 60]) if rnd.random() < 0.97 else s + 900))
        rows += [("a", None, 5), ("b", 3, None), ("d", 1, 2), ("e", 0, 10**12)] + rows[:10]
        df = spark.createDataFrame([(*r, "x") for r in rows], "k string, s bigint, e bigint, shard string")
        got = sorted((tuple(r) for r in periods_and_gaps(df, ["k"], "s", "e", 15, shard_ms=size).collect()), key=repr)
        assert got == brute(rows, 15)
    assert periods_and_gaps(df.limit(0), ["k"], "s", "e").count() == 0
