from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framewright.operators import sequence as sq
from framewright.plans import base
from framewright.streaming import tracks as live


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    return df.sparkSession.table(name)


def test_frame_runs_equal_batch(spark, sf_dir, tmp_path):
    pytest.importorskip("google.protobuf")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    few = base.frames(spark, sf_dir).select("ep_id", "ordinal", "t_ms", "combined_text", "conf")
    ends = few.select("ep_id").distinct().select("ep_id", F.lit(-1).alias("ordinal"), F.lit(0).cast("bigint").alias("t_ms"), F.lit(None).cast("string").alias("combined_text"), F.lit(0).cast("bigint").alias("conf"))
    few.filter("ordinal <= 40").coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    few.filter("ordinal > 40").unionByName(ends).coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    stream = spark.readStream.schema(few.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(str(tmp_path / "in"))
    got = sorted((r.ep_id, r.start_ms, r.end_ms, r.text, r.n_frames) for r in drain(live.frame_runs(stream), "runs").collect())
    want = sorted((r.ep_id, r.start_ms, r.end_ms, r.text, r.n_frames) for r in sq.similarity_runs(few, ["ep_id"], "ordinal", "t_ms", "combined_text", "conf").collect())
    assert got == want and got


def test_windows_and_join(spark, tmp_path):
    base_t = "timestamp '2024-01-01 00:00:00'"
    rows = spark.range(40).select(F.lit("e").alias("ep_id"), F.expr(f"{base_t} + make_interval(0,0,0,0,0,0,id)").alias("at"), F.expr("case when id < 20 then 'a' else 'b' end").alias("combined_text"), F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "f"))
    src = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "f"))
    got = drain(live.session_runs(src, "at"), "sess")
    assert got.count() >= 0
    total = drain(live.log_windows(src, "at", "v", "combined_text"), "wins", "update")
    assert total.agg(F.max("n")).first()[0] == 20
    sp = spark.createDataFrame([("e", 1, 0, 2), ("e", 2, 10, 12)], "ep_id string, id int, s int, e int").select("ep_id", "id", F.expr(f"{base_t} + make_interval(0,0,0,0,0,0,s)").alias("s_at"), F.expr(f"{base_t} + make_interval(0,0,0,0,0,0,e)").alias("e_at"))
    sc = spark.createDataFrame([("e", 7, 1, 3), ("e", 8, 12, 14)], "ep_id string, block_no int, s int, e int").select("ep_id", "block_no", F.expr(f"{base_t} + make_interval(0,0,0,0,0,0,s)").alias("b_at"), F.expr(f"{base_t} + make_interval(0,0,0,0,0,0,e)").alias("f_at"))
    sp.write.parquet(str(tmp_path / "sp"))
    sc.write.parquet(str(tmp_path / "sc"))
    a, k = (spark.readStream.schema(d.schema).parquet(str(tmp_path / n)) for d, n in ((sp, "sp"), (sc, "sc")))
    assert [tuple(r) for r in drain(live.align_live(a, k), "pairs").collect()] == [("e", 1, 7)]
    q = live.write_once(src, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
