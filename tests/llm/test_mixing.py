from __future__ import annotations

from framewright.llm.mixing import mix_plan, reached_shares, sample_mix, water_fill, unclamped_total


def test_water_fill():
    assert water_fill([0.5, 0.5], [10, 100], 100) == [10, 90]
    assert water_fill([1, 1, 2], [100, 100, 100], 100) == [25, 25, 50]
    assert water_fill([1, 0], [5, 5], 100) == [5, 0] and water_fill([], [], 3) == []


def test_mix(spark):
    docs = [(k, "abc"[k % 3] if k % 17 else None, 5 + k % 7) for k in range(600)] + [(10_000, "a", 0), (10_001, "zz", 9)]
    counted = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.1, 1), ("b", 0.2, 4), ("c", 0.6, 2), ("none", 0.1, 3), ("a", 0.1, 1)], "source string, target_share double, max_repeats int")
    plan = mix_plan(counted, targets)
    sampled = sample_mix(counted, plan, "doc_id")
    assert sorted(map(tuple, sampled.collect())) == sorted(map(tuple, sample_mix(counted, plan, "doc_id").collect()))
    shares = {r.source: r for r in reached_shares(sampled, plan).collect()}
    wanted = {r.source: r.wanted for r in plan.collect()}
    for s, r in shares.items():
        assert r.most_repeats <= r.max_repeats and abs(r.tokens - wanted[s]) <= 11
    assert shares["none"].tokens == 0 and abs(sum(r.share for r in shares.values()) - 1) < 1e-9
    assert sample_mix(counted.limit(0), mix_plan(counted.limit(0), targets), "doc_id").count() == 0


def test_nearest_total_clamps_no_source():
    weights, caps = [0.5, 0.3, 0.2, 0.1], [100.0, 900.0, 10.0, 0.0]
    total = unclamped_total(weights, caps)
    sizes = water_fill(weights, caps, total)
    assert abs(total - 50) < 1e-9 and [round(x, 6) for x in sizes] == [25.0, 15.0, 10.0, 0.0]
    assert unclamped_total([1.0], [0.0]) == 0.0
