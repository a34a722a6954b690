from __future__ import annotations

import random

from framewright.operators.temporal import align_candidates, asof_end, clip_window, overlap_pairs


def spans(rnd, n, wide=0.02):
    out = []
    for k in range(n):
        s = rnd.randrange(-500, 20_000)
        out.append((rnd.choice("ab"), k, s, s + (rnd.choice([0, -5, 1, 30, 200, 900]) if rnd.random() > wide else 15_000)))
    return out + [("a", 900, None, 5), ("b", 901, 3, None)]


def test_overlap_equals_nested_loop(spark):
    rnd = random.Random(5)
    left, right = spans(rnd, 120), spans(rnd, 120)
    l = spark.createDataFrame(left, "ep_id string, i int, s long, e long")
    r = spark.createDataFrame(right, "ep_id string, j int, rs long, re long")
    ok = lambda s, e: s is not None and e is not None and e > s
    want = sorted((a[1], c[1]) for a in left for c in right if a[0] == c[0] and ok(*a[2:]) and ok(*c[2:]) and a[2] < c[3] and c[2] < a[3])
    for bucket in (50, 100_000):
        got = overlap_pairs(l, r, ["ep_id"], ("s", "e"), ("rs", "re"), bucket_ms=bucket)
        assert sorted((x.i, x.j) for x in got.collect()) == want and want


def test_candidate_bounds(spark):
    cases = [((0, 2000), (0, 510), True), ((0, 2000), (0, 500), False), ((0, 800), (400, 730), True), ((0, 2000), (0, 100), False), ((0, 190), (0, 190), False), ((2000, 4000), (0, 1500), False)]
    for n, (a, k, hit) in enumerate(cases):
        speech = spark.createDataFrame([("e", 1, *a)], "ep_id string, id int, start_ms long, end_ms long")
        screen = spark.createDataFrame([("e", 7, *k)], "ep_id string, block_no int, start_ms long, end_ms long")
        assert align_candidates(speech, screen).count() == int(hit), n


def test_asof_and_clip(spark):
    rnd = random.Random(8)
    sp = sorted((s, s + rnd.randrange(1, 400)) for s in rnd.sample(range(0, 40_000), 60))
    spans_df = spark.createDataFrame([("e", k, s, e) for k, (s, e) in enumerate(sp)], "ep_id string, pos int, s long, e long")
    pts = [rnd.randrange(-200, 45_000) for _ in range(120)]
    points = spark.createDataFrame([("e", k, t) for k, t in enumerate(pts)], "ep_id string, pid int, ts long")

    def brute(ts):
        last = None
        for s, e in sp:
            if s > ts + 100:
                break
            if s <= ts <= e + 100:
                return e
            last = e
        return last

    got = {r.pid: r.snapped_ms for r in asof_end(points, spans_df, ["ep_id"], bucket_ms=3000).collect()}
    assert got == {k: brute(t) for k, t in enumerate(pts)}
    win = spark.createDataFrame([("e", 1, 1000, 9000), ("e", 2, 8000, 8001)], "ep_id string, wid int, w_s long, w_e long")
    got = sorted((r.wid, r.pos, r.start_ms, r.end_ms) for r in clip_window(spans_df, win, ["ep_id"], 50).collect())
    want = sorted((w, k, s - a + 50, min(e, z) - a + 50) for w, a, z in ((1, 1000, 9000), (2, 8000, 8001)) for k, (s, e) in enumerate(sp) if a <= s < z and min(e, z) > s)
    assert got == want
