from __future__ import annotations

import random

import pytest

from framewright.llm.nearest import nearest_within


@pytest.mark.parametrize("width", [3, 16, 64])
def test_brute_force(spark, width):
    rnd = random.Random(4)
    left = [("a" if rnd.random() < 0.7 else "b", k, rnd.randrange(-500, 3000)) for k in range(150)] + [(None, 1, 5), ("a", 999, None)]
    right = [("a" if rnd.random() < 0.7 else "b", k, rnd.randrange(-500, 3000)) for k in range(90)]
    right += [("a", 90, right[0][2])]
    schema = "g string, id int, t bigint"
    got = sorted(tuple(r) for r in nearest_within(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 40, width).collect())
    want = []
    for g, i, t in left:
        near = sorted((abs(t - rt), rid) for rg, rid, rt in right if rg == g and abs(t - rt) <= 40) if t is not None else []
        if near:
            want.append((g, i, near[0][1]))
    assert got == sorted(want) and got
    assert nearest_within(spark.createDataFrame([], schema), spark.createDataFrame(right, schema), 40, width).count() == 0
