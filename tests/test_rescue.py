from __future__ import annotations

from pyspark.sql import functions as F

from framewright import models
from framewright.functions import text as tx
from framewright.operators.intervals import merge_intervals
from framewright.operators.planning import AUTOMATIC, extend_again
from framewright.operators.sequence import alike, merge_artifacts, ratio
from framewright.operators.temporal import align_with_rescue, overlap_pairs
from framewright.sources.sinks import merge_report, read_report, write_page


def test_both_rescues(spark):
    speech = [("lead", k, 40_000 + k * 2000, 41_500 + k * 2000, f"line {k}") for k in range(12)] + [("sparse", 1, 1000, 9000, "said")]
    screen = [("lead", 0, 10_000, 12_000, "hello there", 9000), ("lead", 1, 12_300, 14_000, "hello thera", 9500), ("lead", 2, 30_000, 39_500, "too near", 9000), ("lead", 3, 40_000, 41_500, "line 0", 9000)]
    screen += [("sparse", k, k * 3000, k * 3000 + 2500, f"{'abcdefg'[k] * 9}", 9000) for k in range(6)] + [("few", 0, 0, 1000, "alone", 9000)]
    a = spark.createDataFrame(speech, "ep_id string, id int, start_ms long, end_ms long, text string")
    k = spark.createDataFrame(screen, "ep_id string, block_no int, start_ms long, end_ms long, combined_text string, conf long")
    got = {r.segment_id: r for r in align_with_rescue(a, k).collect()}
    lead = got["lead_lead_0000"]
    assert (lead.start_ms, lead.end_ms, lead.master_text, lead.master_source, lead.context_available) == (10_000, 14_000, "hello thera", "ocr_leading", False)
    assert "lead_lead_0001" not in got and got["lead_0000"].context_text == "line 0" and got["lead_0011"].master_source == "asr"
    assert [got[f"sparse_{n:04d}"].master_source for n in range(6)] == ["ocr"] * 6 and got["sparse_0001"].context_text == "said" and got["sparse_0005"].context_text == ""
    assert sum(r.ep_id == "few" for r in got.values()) == 0 and len(got) == 13 + 6


def test_extending_again_changes_nothing(spark):
    scenes = spark.createDataFrame([("e", k, k * 30_000, k * 30_000 + 25_000) for k in range(20)], "ep_id string, pos int, s long, e long")
    plans = spark.createDataFrame([("e", 1, 0, 25_000, None), ("e", 1, 25_000, 60_000, AUTOMATIC), ("e", 2, 0, 170_000, "")], "ep_id string, plan_id int, s long, e long, note string")
    once = extend_again(plans, scenes)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(once) == sorted([("e", 1, 0, 25_000, None), ("e", 1, 25_000, 175_000, AUTOMATIC), ("e", 2, 0, 170_000, "")], key=repr)
    assert rows(extend_again(once, scenes)) == rows(once)


def test_titles_and_names(spark):
    rows = [("The king proclaims Lillian Blackwood as the Luna Princess today", "Lillian Blackwood"), ("Nobody is known as Luna Princess", "Lillian Blackwood"), ("lillian becomes One Two Three Four Five", "Lillian Xu")]
    got = spark.createDataFrame(rows, "t string, n string").select(tx.title_phrases(F.col("t"), tx.name_tokens(F.col("n"))).alias("x"), tx.name_tokens(F.col("n")).alias("k")).collect()
    assert [r.x for r in got] == [["luna princess"], [], []] and got[2].k == ["lillian"]


def test_lines_and_keys(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(tx.normalise_line(F.lit("<i>Unbe- \n lievable</i> ♪◆  News　now "))) == "unbelievable news now"
    keys = [one(tx.natural_key(F.lit(x))) for x in ("ep2", "ep10", "ep999999999999", "ep1234567890123", "ep1234567890129", "ep99999999999999")]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert one(tx.episode_norm(F.lit("02"))) == "2" and one(tx.episode_norm(F.lit("x2"))) == "x2"
    assert one(tx.escape_markup(F.lit('<a href="x">&'))) == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(tx.opens_tension(F.lit("你敢走"))) and one(tx.closes_tension(F.lit("走!"))) and not one(tx.closes_tension(F.lit("Go!")))


def test_cheap_bounds_do_not_change_the_ratio():
    words = ["", "a", "hello there", "hello thera", "there hello", "x" * 30, "hello", "ab" * 15]
    for a in words:
        for b in words:
            for near in (0.5, 0.8, 0.85, 1.0):
                assert alike(a, b, near) == (ratio(a, b) >= near)


def test_artifacts_by_brute_force(spark):
    import random

    rnd = random.Random(4)
    rows, t = [], 0
    for k in range(400):
        t += rnd.choice([0, 100, 2900, 3100, 3500])
        d = rnd.choice([50, 150, 199, 200, 900, -10])
        rows.append(("e", k, t, t + d, rnd.choice("aab")))
        t += max(d, 0)
    want = []
    for _, _, s, e, x in rows:
        last = want[-1] if want else None
        if last and last[2] == x and (last[1] - last[0] < 200 or e - s < 200 or s - last[1] <= 3000):
            last[1], last[3] = e, last[3] + 1
        else:
            want.append([s, e, x, 1])
    got = merge_artifacts(spark.createDataFrame(rows, "ep string, no int, s long, e long, x string"), ["ep"], "no", "s", "e", "x")
    assert sorted((r.s, r.e, r.x, r.n_merged) for r in got.collect()) == sorted(map(tuple, want))


def test_wide_intervals_meet_once(spark):
    import random

    rnd = random.Random(1)
    make = lambda: [("g", k, s, s + rnd.choice([5, 900, 70_000, 900_000, 9_000_000])) for k in range(60) for s in [rnd.randrange(-100_000, 20_000_000)]]
    a, b = make(), make()
    left = spark.createDataFrame(a, "g string, i int, s long, e long")
    right = spark.createDataFrame(b, "g string, j int, t long, f long")
    got = sorted((r.i, r.j) for r in overlap_pairs(left, right, ["g"], ("s", "e"), ("t", "f"), bucket_ms=1000).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[2] < y[3] and y[2] < x[3])


def test_middles_of_one_start_are_coalesced(spark):
    rows = [("e", k, 10, 600_000 * (k + 3)) for k in range(50)]
    got = merge_intervals(spark.createDataFrame(rows, "ep string, k int, s long, e long"), ["ep"], "s", "e").collect()
    assert [(r.s, r.e) for r in got] == [(10, 600_000 * 52)]


def test_report_and_page(spark, tmp_path):
    path = str(tmp_path / "report")
    frame = lambda *rows: spark.createDataFrame(rows, "key string, reason string")
    merge_report(frame(("a", "bad"), (None, "x")), path)
    merge_report(frame(("a", "bad"), ("b", "worse")), path)
    assert sorted(map(tuple, read_report(spark, path).collect())) == [("a", "bad"), ("b", "worse")]
    page = str(tmp_path / "page")
    write_page(frame(("<b>", None)), page, "A & B")
    text = "\n".join(r.value for r in spark.read.text(page).collect())
    assert "<td>&lt;b&gt;</td><td></td>" in text and "<title>A &amp; B</title>" in text


def test_compositions(spark):
    def failing(system, user):
        if any("b" in u for u in user):
            raise models.PassingFault
        return [f"{s}:{u}" for s, u in zip(system, user)]

    parts = spark.createDataFrame([("g", 0, "x"), ("g", 1, "y")], "g string, p int, t string").repartition(2, "p")
    got = models.map_then_reduce(parts, "g", "p", "t", "M", "R", lambda s, u: [f"{a}({b})" for a, b in zip(s, u)]).collect()
    assert [(r.g, r.n_parts, r.answer) for r in got] == [("g", 2, "R(M(x)\nM(y))")]
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    long = models.translate(rows, "k", "t", ("es",), "S", "F", "T", lambda s, u: [f"{a}:{b}" for a, b in zip(s, u)]).collect()
    assert sorted((r.k, r.lang, r.text) for r in long) == [(1, "en", "F:S:a"), (1, "es", "T es:F:S:a"), (2, "en", "F:S:"), (2, "es", "T es:F:S:")]
    assert models.refine_steps(rows.filter("k = 1"), "k", "t", ["S"], failing).first().text == "S:a"
