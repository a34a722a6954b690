"""Queries with the reference's whole rule, beside given queries with a reduced one."""

from __future__ import annotations

import __spark_entry__ as entry


def speech(spark, tmp_path, rows):
    rows = [("e", k, s, e, t, None) for k, (s, e, t) in enumerate(rows)]
    spark.createDataFrame(rows, "ep_id string, id int, start_s double, end_s double, text string, loaded_at timestamp").write.parquet(f"{tmp_path}/asr_segment.parquet")
    return str(tmp_path)


def test_over_long(spark, tmp_path):
    sf = speech(spark, tmp_path, [(0.0, 4.0, "a"), (10.0, 14.001, "b"), (20.0, 28.0, "c"), (30.0, 38.001, "d"), (None, 1.0, "e")])
    assert sorted(r.id for r in entry.queries()["flt_03_within_8_seconds"](spark, sf).collect()) == [0, 1, 2]


def test_prompt_head(spark, tmp_path):
    sf = speech(spark, tmp_path, [(0.0, 1.0, "a" * 799 + "\nrest"), (1.0, 2.0, "b" * 90)])
    assert {r.id: r.prompt for r in entry.queries()["fn_25_prompt_head_800"](spark, sf).collect()} == {0: "a" * 799 + "\\n", 1: "b" * 90}
