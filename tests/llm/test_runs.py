"""Runs against a sequential brute force."""

from __future__ import annotations

import re

import pandas as pd
import pytest

from framewright.llm.queries import p5_found
from framewright.llm.runs import collapse_runs


def plain(t):
    t = re.sub(r"<[^<>]{0,40}>|\{\\[^{}]{0,40}\}", "", t or "")
    return re.sub(r"[\s  -‏  　♩-♯★☆#¶]+", "", t).lower()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def same(a, b):
    return a == b or abs(len(a) - len(b)) <= 4 and distance(a, b) <= min(4, max(1, min(len(a), len(b)) // 5))


def brute(df, order, score=None, weight=None):
    out = []
    for ep, g in df.drop_duplicates(["ep_id", order]).sort_values(order).groupby("ep_id"):
        run, prev = [], ""
        def close():
            if len(run) >= 2:
                out.append((ep, run[0][0], run[-1][0], sum(w for _, w in run)))
        for r in g.to_dict("records"):
            line, conf = plain(r["combined_text"]), r[score] if score and r[score] == r[score] and r[score] is not None else 0
            w = int(r[weight]) if weight else 1
            if not (r["combined_text"] or "").strip():
                close()
                run, prev = [], ""
            elif score and conf < 0.55:
                if run:
                    run.append((r[order], w))
            else:
                if not (run and same(line, prev)):
                    close()
                    run = []
                run.append((r[order], w))
                prev = line
        close()
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_against_brute_force(spark, sf_dir, shard_rows):
    frames = pd.read_parquet(f"{sf_dir}/ocr_frame.parquet")
    got = collapse_runs(spark.read.parquet(f"{sf_dir}/ocr_frame.parquet"), "ep_id", "ordinal", "combined_text", score="avg_confidence", shard_rows=shard_rows)
    got = sorted((r.ep_id, r.first_no, r.last_no, r.n_weight) for r in got.filter("n_records >= 2").collect())
    assert got == brute(frames, "ordinal", "avg_confidence")
    assert got


def test_query_covers_both_tracks(spark, sf_dir):
    got = sorted((r.ep_id, r.first_no, r.last_no, r.n_frames) for r in p5_found(spark, sf_dir).filter("track = 'block'").collect())
    assert got == brute(pd.read_parquet(f"{sf_dir}/ocr_block.parquet"), "block_no", weight="frame_count")


def test_edge_cases(spark):
    schema = "ep_id string, ordinal int, combined_text string, avg_confidence double, g string"
    rows = [("a", 1, None, None, "x"), ("a", 2, "Hello there", 0.9, "x"), ("a", 2, "Hello there", 0.9, "x"), ("a", 3, "zz", 0.1, "x"), ("a", 5, "<i>HELLO  there</i>", 0.9, "x"), ("a", 6, " ", 0.9, "x"), ("a", 7, "zz", 0.1, "x"), ("a", 8, "y" * 50000, 0.8, "x"), ("a", 9, "y" * 50000, 0.8, "x"), (None, 1, "q", 0.9, "x")]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.first_no, r.last_no, r.n_records) for r in collapse_runs(df, "ep_id", "ordinal", "combined_text", score="avg_confidence").collect())
    assert got == [(2, 5, 3), (8, 9, 2)]
    assert collapse_runs(df.limit(0), "ep_id", "ordinal", "combined_text").count() == 0


def test_durations_of_both_tracks(spark, tmp_path):
    from framewright.llm.queries import p5_durations

    spark.createDataFrame([("e", 0, 0.0, "Hello there", 0.9), ("e", 1, 0.2, "Hello there", 0.9), ("e", 2, 0.4, "Bye now", 0.9)], "ep_id string, ordinal int, frame_time double, combined_text string, avg_confidence double").write.parquet(f"{tmp_path}/ocr_frame.parquet")
    spark.createDataFrame([("e", 1, 1.0, 2.0, "Hello there", 3), ("e", 2, 2.5, 4.25, "Hello there", 4), ("e", 3, 5.0, 6.0, "Bye now", 2)], "ep_id string, block_no int, start_s double, end_s double, combined_text string, frame_count int").write.parquet(f"{tmp_path}/ocr_block.parquet")
    got = sorted((r.track, r.first_no, r.last_no, r.n_frames, r.start_ms, r.duration_ms) for r in p5_durations(spark, str(tmp_path)).collect())
    assert got == [("block", 1, 2, 7, 1000, 3250), ("block", 3, 3, 2, 5000, 1000), ("frame", 0, 1, 2, 0, 200), ("frame", 2, 2, 1, 400, 0)]
