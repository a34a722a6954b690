"""Greedy extension of spans over an ordered timeline, one group a plan, after the timeline is cut to its reach."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extend_plans(plans: DataFrame, scenes: DataFrame, target_ms: int = 165_000, over_ms: int = 50_000) -> DataFrame:
    """Extend each plan (ep_id, plan_id, s, e) by the scenes (ep_id, pos, s, e) that follow, in order of position.

    Spans count from first start to last end, gaps included. Extension stops once the target is reached or before the
    ceiling (target + over) would be passed. A plan reaches at most the ceiling, so only scenes that begin within it
    after the plan's end are joined, and a group holds a bounded stretch of time. A plan at its target is unchanged, so
    extending twice changes nothing.
    """
    p = plans.filter("s is not null and e >= s").select("ep_id", "plan_id", F.col("s").alias("p_s"), F.col("e").alias("p_e"))
    width = float(target_ms + over_ms)
    left = p.withColumn("b", F.explode(F.array(F.floor(F.col("p_e") / width), F.floor(F.col("p_e") / width) + 1)))
    right = scenes.filter("s is not null and e > s").select("ep_id", "pos", F.col("s").alias("c_s"), F.col("e").alias("c_e")).withColumn("b", F.floor(F.col("c_s") / width))
    near = left.join(right, ["ep_id", "b"], "left").drop("b").withColumn("ok", (F.col("c_s") >= F.col("p_e")) & (F.col("c_e") - F.col("p_s") <= width))

    def extend(g: pd.DataFrame) -> pd.DataFrame:
        first = g.iloc[0]
        end, n, reached = int(first["p_e"]), 0, False
        rows = g[g["ok"] == True].sort_values("pos")  # noqa: E712
        for e in rows["c_e"]:
            if end - first["p_s"] >= target_ms:
                reached = True
                break
            if int(e) - first["p_s"] > target_ms + over_ms:
                break
            end, n = max(end, int(e)), n + 1
        reached = reached or end - first["p_s"] >= target_ms
        return pd.DataFrame([[first["ep_id"], first["plan_id"], int(first["p_s"]), end, n, reached]], columns=["ep_id", "plan_id", "s", "e", "n_added", "reached"])

    kind = dict(plans.dtypes)["plan_id"]
    return near.groupBy("ep_id", "plan_id").applyInPandas(extend, f"ep_id string, plan_id {kind}, s bigint, e bigint, n_added int, reached boolean")


AUTOMATIC = "[auto-extended]"


def extend_again(segments: DataFrame, scenes: DataFrame, target_ms: int = 165_000, over_ms: int = 50_000) -> DataFrame:
    """Plans given as segments (ep_id, plan_id, s, e, note): earlier automatic segments go, then each short plan is extended by one.

    Running it on its own result changes nothing.
    """
    own = segments.filter(F.coalesce("note", F.lit("")) != AUTOMATIC).select("ep_id", "plan_id", "s", "e", "note")
    plans = own.filter("s is not null and e >= s").groupBy("ep_id", "plan_id").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    longer = extend_plans(plans, scenes, target_ms, over_ms).filter("n_added > 0").select("ep_id", "plan_id", F.col("e").alias("to_ms"))
    added = plans.join(longer, ["ep_id", "plan_id"]).select("ep_id", "plan_id", F.col("e").alias("s"), F.col("to_ms").alias("e"), F.lit(AUTOMATIC).alias("note"))
    return own.unionByName(added)
