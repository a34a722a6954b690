from __future__ import annotations

from framewright.operators.planning import extend_plans


def test_extension(spark):
    scenes = spark.createDataFrame([("e", k, k * 30_000, k * 30_000 + 25_000) for k in range(20)] + [("f", 0, 400_000, 500_000)], "ep_id string, pos int, s long, e long")
    plans = spark.createDataFrame([("e", 1, 0, 25_000), ("e", 2, 0, 170_000), ("f", 1, 0, 10_000), ("f", 2, None, 5)], "ep_id string, plan_id int, s long, e long")
    got = extend_plans(plans, scenes)
    assert sorted((r.ep_id, r.plan_id, r.s, r.e, r.n_added, r.reached) for r in got.collect()) == [("e", 1, 0, 175_000, 5, True), ("e", 2, 0, 170_000, 0, True), ("f", 1, 0, 10_000, 0, False)]
    again = extend_plans(got.select("ep_id", "plan_id", "s", "e"), scenes)
    assert sorted((r.plan_id, r.e) for r in again.collect()) == sorted((r.plan_id, r.e) for r in got.collect())
