from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from framewright import models
from framewright.sources import sinks, tracks


def test_track_documents(spark, tmp_path):
    doc = {"episode": "e1", "segments": [{"id": 3, "start": 0.5, "end": 1.0, "text": "hi", "words": [{"word": "hi", "low_confidence": True}]}]}
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "e1.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "a" / "e2.json").write_text('{"episode": "e2"}')
    got = tracks.read_speech(spark, str(tmp_path / "a")).collect()
    assert [(r.ep_id, r.pos, r.id, r.text, r.words[0].low_confidence) for r in got] == [("e1", 0, 3, "hi", True)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "e1.json").write_text(json.dumps({"episode": "e1", "mode": "same_lang", "blocks": [{"start": 1, "end": 2, "combined_text": "x", "frame_count": 4}]}))
    assert tracks.read_screen(spark, str(tmp_path / "b"), "same_lang").first().frame_count == 4
    with pytest.raises(Exception, match="not of mode"):
        tracks.read_screen(spark, str(tmp_path / "b"), "cross_lang").collect()
    (tmp_path / "c").mkdir()
    row = {"segment_id": "s", "start": 1.0, "master_text": "m"}
    (tmp_path / "c" / "e1_aligned.json").write_text(json.dumps([row]))
    (tmp_path / "c" / "e2_aligned.json").write_text(json.dumps({"segments": [row, row]}))
    (tmp_path / "c" / "e3_aligned.json").write_text("{broken")
    assert tracks.read_aligned(spark, str(tmp_path / "c")).groupBy("ep_id").count().orderBy("ep_id").collect() == [("e1", 1), ("e2", 2)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "batch_2.json").write_text(json.dumps({"A": {"canonical": "A", "aliases": ["x"]}, "B": {}}))
    (tmp_path / "d" / "batch_3.json").write_text("[1]")
    assert sorted((r.batch_index, r.canonical, len(r.aliases)) for r in tracks.read_entity_batches(spark, str(tmp_path / "d")).collect()) == [(2, "A", 1), (2, "B", 0)]


def test_listing_logs_subtitles(spark, tmp_path):
    (tmp_path / "show" / "s1").mkdir(parents=True)
    for n in ("ep10.mp4", "ep2.MKV", "note.txt"):
        (tmp_path / "show" / "s1" / n).write_bytes(b"x")
    assert [r.ep_id for r in tracks.list_files(spark, str(tmp_path / "show" / "s1")).orderBy("sort_key").collect()] == ["ep2", "ep10"]
    assert [r.name for r in tracks.list_folders(spark, str(tmp_path / "show")).collect()] == ["s1"]
    (tmp_path / "log.jsonl").write_text('{"a": 1}\n\nnope\n{"a": 2}\n')
    assert sorted(r.a for r in tracks.read_log(spark, str(tmp_path / "log.jsonl"), "a int").collect()) == [1, 2]
    (tmp_path / "x.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nhi\n")
    assert tracks.read_subtitles(spark, str(tmp_path / "x.srt")).first().ep_id == "x"
    df = spark.range(100).withColumn("g", F.expr("id % 3"))
    a, b = (sorted(r.id for r in tracks.sample_per_group(df, "g", "id", 5).collect()) for _ in range(2))
    assert a == b and len(a) == 15


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("en", "e1", 1, 0, 1000, "a"), ("en", "e1", 4, 1000, 2000, " "), ("en", "e1", 5, 2000, 3000, "b")], "lang string, ep_id string, pos int, start_ms long, end_ms long, text string")
    sinks.write_subtitles(df, str(tmp_path / "srt"))
    text = spark.read.text(str(tmp_path / "srt" / "lang=en" / "ep_id=e1"), wholetext=True).first().value
    assert text.startswith("1\n00:00:00,000 --> 00:00:01,000\na\n\n2\n00:00:02,000 --> 00:00:03,000\nb")
    assert sinks.write_if_rows(df, str(tmp_path / "g")) and not sinks.write_if_rows(df.limit(0), str(tmp_path / "g")) and spark.read.parquet(str(tmp_path / "g")).count() == 3
    sinks.write_if_absent(df, str(tmp_path / "w"))
    sinks.write_if_absent(df.limit(1), str(tmp_path / "w"))
    sinks.append_log(df, str(tmp_path / "l"))
    sinks.append_log(df, str(tmp_path / "l"))
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "w")).count() == 3 and spark.read.json(str(tmp_path / "l")).count() == 6
    assert tracks.read_corpus(spark, str(tmp_path / "g"), "parquet", ["text"]).columns == ["text"]


def test_model_boundary(spark):
    df = spark.createDataFrame([(1, "s", "u"), (2, "s", "v")], "k int, s string, u string")
    got = models.complete(df, "k", "s", "u").collect()
    assert {r.k: r.answer for r in got} == {1: models.stub(["s"], ["u"])[0], 2: models.stub(["s"], ["v"])[0]} and all(r.n_tries == 1 for r in got)

    def down(system, user):
        raise models.PassingFault

    assert all(r.answer is None and r.n_tries == 2 for r in models.complete(df, "k", "s", "u", provider=down, attempts=2, first_wait=0.01).collect())
