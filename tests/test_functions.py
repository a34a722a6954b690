from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import json_text as js
from framewright.functions import text as tx
from framewright.functions import timecode as tc
from framewright.operators import subtitles as st


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_times(spark):
    assert one(spark, tc.srt_time(F.lit(59_999)), tc.srt_time(F.lit(-10_000)), tc.cut_time(F.lit(90_061_001)), tc.parse_time(F.lit("25:01:01,001")), tc.parse_time(F.lit("x"), 0)) == ("00:00:59,999", "00:00:00,000", "25:01:01.001", 90_061_001, 0)


def test_validator(spark):
    cases = {
        "": "document_empty", "1\n00:00:01,000 --> 00:00:02,000\nhi": None, "x\n00:00:01,000 --> 00:00:02,000\nhi": "index_not_digits", "2\n00:00:01,000 --> 00:00:02,000\nhi": "index_out_of_order",
        "1\nhi": "no_timestamp", "1\n00:00:01 --> 00:00:02\nhi": "bad_timestamp", "1\n00:00:02,000 --> 00:00:02,000\nhi": "end_not_after_start", "1\n00:00:01,000 --> 00:00:02,000": "no_text",
        "1\r\n00:00:01,000 --> 00:00:02,000\r\nhi\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nyo": None, "1\n00:00:01,000 --> 00:00:02,000\nhi\n2\n00:00:03,000 --> 00:00:04,000\nyo": "stuck_block",
    }
    for text, want in cases.items():
        assert one(spark, st.violation(F.lit(text)))[0] == want, text


def test_parse_and_render(spark):
    rows = spark.createDataFrame([(1, "1\n00:00:01,000 --> 00:00:02,500\na\nb\n\n2\n00:00:03,000 --> 00:00:04,000\nc")], "d int, t string")
    got = sorted((r.pos, r.start_ms, r.end_ms, r.text) for r in st.parse_blocks(rows, "d", "t").collect())
    assert got == [(0, 1000, 2500, "a\nb"), (1, 3000, 4000, "c")]
    back = "\n".join(one(spark, st.render(F.lit(s), F.lit(e), F.lit(n + 1), F.lit(t)))[0] for n, s, e, t in got)
    assert one(spark, st.violation(F.lit(back)))[0] is None


def test_json():
    assert js.first_object('say {"a": 1,} ok') == '{"a": 1}' and js.first_object("none {") is None
    assert js.complete_members('{"a": {"x": "}"}, "b": [1, 2], "c": {"y": 1') == '{"a": {"x": "}"}, "b": [1, 2]}'
    assert js.complete_members('{"a": tru') is None


def test_text(spark):
    assert one(spark, tx.normalise_line(F.lit("<i>A  b</i> ♪ C")), tx.natural_key(F.lit("Ep2b10"), 3), tx.clean_field(F.lit(" a\nb c "), 4), tx.file_name(F.lit("a/b: c")), tx.script_ratio(F.lit("ab你好"))) == ("a b c", "ep002b010", "a b", "a_b_ c", 0.5)
    assert one(spark, tx.strip_fence(F.lit("```srt\nx\n```")), tx.drop_trailing_commas(F.lit("[1,]")), tx.human_count(F.lit(1500)), tx.fits_screen(F.lit("x" * 41))) == ("x", "[1]", "1.5K", False)


def test_sql_functions(spark):
    from framewright.functions.sql import register

    register(spark)
    spark.createDataFrame([(1, "1\n00:00:01,000 --> 00:00:02,000\na\nb\n\n2\nbroken"), (2, None)], "d int, t string").createOrReplaceTempView("subs")
    assert [tuple(r) for r in spark.sql("SELECT d, b.* FROM subs, LATERAL srt_blocks(t) b").collect()] == [(1, 0, "00:00:01,000", "00:00:02,000", "a\nb")]
    assert spark.sql("SELECT text_ratio('cacabb', 'cabaca') r, text_ratio('cabaca', 'cacabb') s, text_ratio('', '') z").first()[:] == (0.6666666666666666, 0.5, 1.0)
