"""Registered queries over the speech, screen and aligned tracks, with the equal SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import text as tx
from framewright.operators import sequence as sq
from framewright.operators import temporal as tp
from framewright.plans import base as b

_SUSPENSE, _CLOSED_HAN, _CLOSED = tx.SUSPENSE, tx.CLOSED_HAN, tx.CLOSED
PHRASES = ["north gate", "码头", "templo"]
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_PAIRS = f"""WITH {b.ASR}, {b.BLK},
pairs AS (SELECT a.ep_id, a.id, k.block_no, k.combined_text, least(a.end_ms, k.end_ms) - greatest(a.start_ms, k.start_ms) AS shared_ms, a.end_ms - a.start_ms AS d1, k.end_ms - k.start_ms AS d2
  FROM asr a JOIN blk k ON a.ep_id = k.ep_id AND a.start_ms < k.end_ms AND k.start_ms < a.end_ms
  WHERE a.end_ms - a.start_ms >= 200 AND k.end_ms > k.start_ms),
cand AS (SELECT *, round(shared_ms / CAST(least(d1, d2) AS DOUBLE), 4) AS score FROM pairs WHERE shared_ms > 500 OR shared_ms * 10 > d1 * 4)"""


@query(f"{_PAIRS} SELECT ep_id, id, block_no, shared_ms, score FROM cand")
def join_01_overlap_candidates(spark, sf):
    return tp.align_candidates(b.asr(spark, sf), b.blocks(spark, sf))


_BEST = f"""{_PAIRS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY ep_id, id ORDER BY score DESC, block_no) AS r, count(*) OVER (PARTITION BY ep_id, id) AS n FROM cand),
al AS (SELECT a.ep_id, a.id, coalesce(r.n, 0) AS n_candidates, r.block_no AS best_block, r.score AS best_score, coalesce(r.combined_text, '') AS context_text, coalesce(r.combined_text, '') <> '' AS context_available
  FROM asr a LEFT JOIN ranked r ON a.ep_id = r.ep_id AND a.id = r.id AND r.r = 1)"""


@query(f"{_BEST} SELECT * FROM al")
def join_01_overlap_align(spark, sf):
    return tp.align_tracks(b.asr(spark, sf), b.blocks(spark, sf))


_CONTEXT = f"""WITH {b.ASR}, {b.SEG},
said AS (SELECT o.ep_id, o.id AS seg_id, trim(string_agg(coalesce(a.text, ''), '' ORDER BY a.start_ms, a.id)) AS context_text
  FROM seg o JOIN asr a ON o.ep_id = a.ep_id AND o.start_ms < a.end_ms AND a.start_ms < o.end_ms WHERE o.end_ms > o.start_ms AND a.end_ms > a.start_ms GROUP BY 1, 2),
ctx AS (SELECT o.ep_id, o.id AS seg_id, coalesce(s.context_text, '') AS context_text, coalesce(s.context_text, '') <> '' AS context_available FROM seg o LEFT JOIN said s ON o.ep_id = s.ep_id AND o.id = s.seg_id)"""


@query(f"{_CONTEXT} SELECT * FROM ctx")
def join_02_ordered_context(spark, sf):
    return tp.ordered_context(b.segments(spark, sf), b.asr(spark, sf))


@query(f"""{_CONTEXT} SELECT printf('%s_%04d', o.ep_id, o.id) AS segment_id, o.raw_text AS master_text, 'ocr' AS master_source, c.context_text, CASE WHEN c.context_available THEN 'asr' ELSE '' END AS context_source, c.context_available
FROM seg o JOIN ctx c ON o.ep_id = c.ep_id AND o.id = c.seg_id""")
def join_03_screen_master(spark, sf):
    seg = b.segments(spark, sf)
    ctx = tp.ordered_context(seg, b.asr(spark, sf)).withColumnRenamed("seg_id", "id")
    out = seg.select("ep_id", "id", "raw_text").join(ctx, ["ep_id", "id"])
    return out.select(F.format_string("%s_%04d", "ep_id", "id").alias("segment_id"), F.col("raw_text").alias("master_text"), F.lit("ocr").alias("master_source"), "context_text", F.when(F.col("context_available"), "asr").otherwise("").alias("context_source"), "context_available")


@query(f"""WITH {b.ASR}, {b.BLK}, n AS (SELECT ep_id, sum(s) AS n_speech, sum(k) AS n_screen FROM (SELECT ep_id, 1 AS s, 0 AS k FROM asr UNION ALL SELECT ep_id, 0, 1 FROM blk) x GROUP BY 1)
SELECT ep_id, CAST(n_speech AS BIGINT) AS n_speech, CAST(n_screen AS BIGINT) AS n_screen, CASE WHEN n_speech < 10 AND n_screen >= 5 THEN 'screen' ELSE 'speech' END AS master FROM n""")
def join_04_sparse_route(spark, sf):
    one = lambda df, s, k: df.groupBy("ep_id").agg(F.count(F.lit(1)).alias("n")).select("ep_id", (F.col("n") * s).alias("s"), (F.col("n") * k).alias("k"))
    both = one(b.asr(spark, sf), 1, 0).unionByName(one(b.blocks(spark, sf), 0, 1)).groupBy("ep_id").agg(F.sum("s").alias("n_speech"), F.sum("k").alias("n_screen"))
    return both.withColumn("master", F.when((F.col("n_speech") < 10) & (F.col("n_screen") >= 5), "screen").otherwise("speech"))


@query(f"""WITH {b.ASR}, {b.BLK}, f AS (SELECT ep_id, arg_min(start_ms, id) AS first_ms FROM asr WHERE start_ms IS NOT NULL GROUP BY 1)
SELECT k.ep_id, k.block_no, k.start_ms, k.end_ms, k.combined_text AS master_text, 'ocr_leading' AS master_source FROM blk k JOIN f ON k.ep_id = f.ep_id AND k.end_ms <= f.first_ms - 1000""")
def join_05_leading_rescue(spark, sf):
    first = b.asr(spark, sf).filter("start_ms is not null").groupBy("ep_id").agg(F.min_by("start_ms", "id").alias("first_ms"))
    out = b.blocks(spark, sf).join(first, "ep_id").filter(F.col("end_ms") <= F.col("first_ms") - 1000)
    return out.select("ep_id", "block_no", "start_ms", "end_ms", F.col("combined_text").alias("master_text"), F.lit("ocr_leading").alias("master_source"))


@query(f"""WITH {b.ASR}, {b.BLK}, sp AS (SELECT ep_id, id, start_ms AS s, end_ms AS e FROM asr WHERE start_ms IS NOT NULL AND end_ms >= start_ms), pt AS (SELECT ep_id, block_no, end_ms AS ts FROM blk WHERE end_ms IS NOT NULL),
i AS (SELECT p.ep_id, p.block_no, arg_min(s.e, (s.s, s.id)) AS in_end FROM pt p JOIN sp s ON p.ep_id = s.ep_id AND s.s <= p.ts AND p.ts <= s.e + 100 AND s.e + 101 > s.s GROUP BY 1, 2),
l AS (SELECT p.ep_id, p.block_no, arg_max(s.e, (s.s, s.id)) AS last_end FROM pt p JOIN sp s ON p.ep_id = s.ep_id AND s.s <= p.ts + 100 GROUP BY 1, 2)
SELECT p.ep_id, p.block_no, coalesce(i.in_end, l.last_end) AS snapped_ms FROM pt p LEFT JOIN i ON p.ep_id = i.ep_id AND p.block_no = i.block_no LEFT JOIN l ON p.ep_id = l.ep_id AND p.block_no = l.block_no""")
def join_07_asof_snap(spark, sf):
    spans = b.asr(spark, sf).filter("start_ms is not null and end_ms >= start_ms").select("ep_id", F.col("id").alias("pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    points = b.blocks(spark, sf).filter("end_ms is not null").select("ep_id", F.col("block_no").alias("pid"), F.col("end_ms").alias("ts"))
    return tp.asof_end(points, spans, ["ep_id"]).withColumnRenamed("pid", "block_no")


@query(f"""WITH {b.ASR}, {b.BLK}, z AS (SELECT ep_id, block_no, end_ms, lead(start_ms) OVER (PARTITION BY ep_id ORDER BY block_no) AS n FROM blk WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL),
a AS (SELECT ep_id, block_no, end_ms AS s, n AS e FROM z WHERE n > end_ms)
SELECT a.ep_id, a.block_no, count(asr.id) AS n_speech FROM a LEFT JOIN asr ON a.ep_id = asr.ep_id AND asr.start_ms < a.e AND a.s < asr.end_ms AND asr.end_ms > asr.start_ms GROUP BY 1, 2""")
def join_05b_speech_between_blocks(spark, sf):
    ok = b.blocks(spark, sf).filter("start_ms is not null and end_ms is not null")
    gaps = sq.following(ok, ["ep_id"], "block_no", F.col("start_ms"), "g_e").filter(F.col("g_e") > F.col("end_ms")).select("ep_id", "block_no", F.col("end_ms").alias("g_s"), "g_e")
    a = b.asr(spark, sf).select("ep_id", F.col("start_ms").alias("a_s"), F.col("end_ms").alias("a_e"))
    met = tp.overlap_pairs(gaps, a, ["ep_id"], ("g_s", "g_e"), ("a_s", "a_e")).groupBy("ep_id", "block_no").agg(F.count(F.lit(1)).alias("n_speech"))
    return gaps.select("ep_id", "block_no").join(met, ["ep_id", "block_no"], "left").fillna({"n_speech": 0})


_LAST = f"""WITH {b.ASR}, {b.BLK}, m AS (SELECT ep_id, end_ms // 60000 AS clip_no, arg_max(block_no, (end_ms, block_no)) AS block_no, max(end_ms) AS hook_ms FROM blk WHERE end_ms IS NOT NULL GROUP BY 1, 2),
sp AS (SELECT ep_id, id, start_ms AS s, end_ms AS e FROM asr WHERE start_ms IS NOT NULL AND end_ms >= start_ms),
i AS (SELECT p.ep_id, p.clip_no, arg_min(s.e, (s.s, s.id)) AS in_end FROM m p JOIN sp s ON p.ep_id = s.ep_id AND s.s <= p.hook_ms AND p.hook_ms <= s.e + 100 GROUP BY 1, 2),
l AS (SELECT p.ep_id, p.clip_no, arg_max(s.e, (s.s, s.id)) AS last_end FROM m p JOIN sp s ON p.ep_id = s.ep_id AND s.s <= p.hook_ms + 100 GROUP BY 1, 2)"""


@query(f"""{_LAST} SELECT m.ep_id, m.clip_no, m.block_no, CASE WHEN (m.clip_no + 1) * 60000 - m.hook_ms >= 2000 THEN coalesce(i.in_end, l.last_end, m.hook_ms) ELSE m.hook_ms END AS end_ms
FROM m LEFT JOIN i ON m.ep_id = i.ep_id AND m.clip_no = i.clip_no LEFT JOIN l ON m.ep_id = l.ep_id AND m.clip_no = l.clip_no""")
def join_08_hook_end(spark, sf):
    """Last block of each minute; if two seconds of it remain, its end snaps to the speech as of then."""
    blk = b.blocks(spark, sf).filter("end_ms is not null").withColumn("clip_no", F.expr("end_ms div 60000"))
    last = blk.groupBy("ep_id", "clip_no").agg(F.max_by("block_no", F.struct("end_ms", "block_no")).alias("block_no"), F.max("end_ms").alias("hook_ms"))
    spans = b.asr(spark, sf).filter("start_ms is not null and end_ms >= start_ms").select("ep_id", F.col("id").alias("pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    snapped = tp.asof_end(last.select("ep_id", F.col("clip_no").alias("pid"), F.col("hook_ms").alias("ts")), spans, ["ep_id"]).withColumnRenamed("pid", "clip_no")
    end = F.when((F.col("clip_no") + 1) * 60_000 - F.col("hook_ms") >= 2000, F.coalesce("snapped_ms", "hook_ms")).otherwise(F.col("hook_ms"))
    return last.join(snapped, ["ep_id", "clip_no"]).select("ep_id", "clip_no", "block_no", end.alias("end_ms"))


@query(f"""WITH {b.ASR}, {b.SEG} SELECT o.ep_id, o.id AS window_id, a.id, a.start_ms - o.start_ms AS start_ms, least(a.end_ms, o.end_ms) - o.start_ms AS end_ms
FROM seg o JOIN asr a ON o.ep_id = a.ep_id AND a.start_ms >= o.start_ms AND a.start_ms < o.end_ms WHERE least(a.end_ms, o.end_ms) > a.start_ms""")
def join_09_window_clip(spark, sf):
    spans = b.asr(spark, sf).select("ep_id", F.col("id").alias("pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    win = b.segments(spark, sf).select("ep_id", F.col("id").alias("wid"), F.col("start_ms").alias("w_s"), F.col("end_ms").alias("w_e"))
    return tp.clip_window(spans, win, ["ep_id"]).select("ep_id", F.col("wid").alias("window_id"), F.col("pos").alias("id"), "start_ms", "end_ms")


@query(f"""WITH {b.ASR}, {b.ALN}, n AS (SELECT ep_id, max(idx) AS top FROM aln GROUP BY 1), dense AS (SELECT ep_id, unnest(range(0, top + 1)) AS idx FROM n)
SELECT d.ep_id, CAST(d.idx AS INT) AS idx, coalesce(a.master_text, '') AS text FROM dense d LEFT JOIN aln a ON d.ep_id = a.ep_id AND d.idx = a.idx""")
def join_11_scatter_dense(spark, sf):
    rows = b.aligned(spark, sf).select("ep_id", "idx", "master_text")
    # Dense numbers in slices of 10,000, so that one huge episode is spread before it is expanded.
    tops = rows.groupBy("ep_id").agg(F.max("idx").alias("top")).select("ep_id", "top", F.explode(F.sequence(F.lit(0), F.col("top"), F.lit(10_000))).alias("at"))
    dense = tops.repartition("ep_id", "at").select("ep_id", F.explode(F.sequence("at", F.least(F.col("at") + 9_999, F.col("top")))).alias("idx"))
    return dense.join(rows, ["ep_id", "idx"], "left").select("ep_id", "idx", F.coalesce("master_text", F.lit("")).alias("text"))


@query(f"""WITH {b.SEG}, {b.ALN} SELECT s.ep_id, s.id, coalesce(nullif(trim(s.normalized_text), ''), a.master_text, s.raw_text) AS text FROM seg s LEFT JOIN aln a ON s.ep_id = a.ep_id AND s.id = a.idx""")
def join_12_patch_empty(spark, sf):
    patch = b.aligned(spark, sf).select("ep_id", F.col("idx").alias("id"), "master_text")
    return b.segments(spark, sf).join(patch, ["ep_id", "id"], "left").select("ep_id", "id", F.coalesce(F.nullif(F.trim("normalized_text"), F.lit("")), "master_text", "raw_text").alias("text"))


@query(f"""WITH {b.ASR}, {b.ALN} SELECT a.ep_id, a.id, a.start_ms FROM asr a WHERE a.start_ms IS NOT NULL AND NOT EXISTS (SELECT 1 FROM aln x WHERE x.ep_id = a.ep_id AND x.start_ms = a.start_ms)""")
def join_17_unknown_times(spark, sf):
    known = b.aligned(spark, sf).select("ep_id", "start_ms")
    return b.asr(spark, sf).filter("start_ms is not null").join(known, ["ep_id", "start_ms"], "left_anti").select("ep_id", "id", "start_ms")


@query(f"""WITH {b.FRM}, v AS (SELECT *, lower(trim(coalesce(combined_text, ''))) AS v FROM frm),
l AS (SELECT *, lag(v) OVER (PARTITION BY ep_id ORDER BY ordinal) AS p FROM v),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> v THEN 1 ELSE 0 END) OVER (PARTITION BY ep_id ORDER BY ordinal) AS g FROM l)
SELECT ep_id, min(t_ms) AS start_ms, max(t_ms) + 500 AS end_ms, arg_min(combined_text, ordinal) AS text, count(*) AS n_frames, round(sum(conf) / CAST(count(*) AS DOUBLE), 2) AS mean_conf FROM g WHERE v <> '' GROUP BY ep_id, g""")
def seq_01_equality_runs(spark, sf):
    return sq.equality_runs(b.frames(spark, sf), ["ep_id"], "ordinal", "t_ms", "combined_text", "conf")


@query()
def seq_02_similarity_runs(spark, sf):
    return sq.similarity_runs(b.frames(spark, sf), ["ep_id"], "ordinal", "t_ms", "combined_text", "conf")


@query()
def seq_03_block_dedup(spark, sf):
    return sq.dedup_blocks(b.blocks(spark, sf), ["ep_id"], "block_no", "start_ms", "end_ms", "combined_text", "conf")


@query(f"""WITH {b.BLK}, l AS (SELECT ep_id, list([{{'s': start_ms, 'e': end_ms, 't': combined_text, 'n': 1}}] ORDER BY block_no) AS x FROM blk WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL GROUP BY 1),
k AS (SELECT ep_id, unnest(list_reduce(x, lambda acc, y: CASE WHEN acc[-1].t IS NOT DISTINCT FROM y[1].t AND (acc[-1].e - acc[-1].s < 200 OR y[1].e - y[1].s < 200 OR y[1].s - acc[-1].e <= 3000)
  THEN list_append(acc[:-2], {{'s': acc[-1].s, 'e': y[1].e, 't': acc[-1].t, 'n': acc[-1].n + 1}}) ELSE list_append(acc, y[1]) END)) AS z FROM l)
SELECT ep_id, z.s AS start_ms, z.e AS end_ms, z.t AS combined_text, z.n AS n_merged FROM k""")
def seq_04_artifact_merge(spark, sf):
    return sq.merge_artifacts(b.blocks(spark, sf), ["ep_id"], "block_no", "start_ms", "end_ms", "combined_text")


@query()
def seq_05_short_merge(spark, sf):
    return sq.merge_short(b.blocks(spark, sf), ["ep_id"], "block_no", "start_ms", "end_ms", "combined_text")


@query(f"""WITH {b.BLK} SELECT ep_id, block_no, start_ms, least(end_ms, coalesce(lead(start_ms) OVER (PARTITION BY ep_id ORDER BY block_no), end_ms)) AS end_ms FROM blk WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL""")
def seq_06_overlap_clip(spark, sf):
    ok = b.blocks(spark, sf).filter("start_ms is not null and end_ms is not null")
    return sq.clip_overlaps(ok, ["ep_id"], "block_no", "start_ms", "end_ms").select("ep_id", "block_no", "start_ms", "end_ms")


@query(f"""WITH {b.SEG}, t AS (SELECT ep_id, id, start_ms AS s, end_ms AS e, replace(coalesce(raw_text, ''), chr(10), '') AS t FROM seg WHERE end_ms > start_ms),
m AS (SELECT *, length(t) AS n, list_filter(range(4, length(t) - 3), lambda i: regexp_matches(substr(t, CAST(i AS INT), 1), '[,，.。!！?？;；:：、…]')) AS c FROM t),
k AS (SELECT *, CASE WHEN len(c) > 0 THEN list_sort(list_transform(c, lambda i: (abs(2 * i - n), i)))[1][2] END AS i FROM m),
x AS (SELECT *, s + CAST(floor((e - s) * i / CAST(n AS DOUBLE)) AS BIGINT) AS cut FROM k),
y AS (SELECT *, coalesce(n > 25 AND i IS NOT NULL AND cut - s >= 400 AND e - cut >= 400, FALSE) AS ok FROM x)
SELECT ep_id, id, 1 AS part, CASE WHEN ok THEN substr(t, 1, CAST(i AS INT)) ELSE t END AS text, s AS start_ms, CASE WHEN ok THEN cut ELSE e END AS end_ms FROM y
UNION ALL SELECT ep_id, id, 2, substr(t, CAST(i + 1 AS INT)), cut, e FROM y WHERE ok""")
def seq_07_long_split(spark, sf):
    ok = b.segments(spark, sf).filter("end_ms > start_ms")
    parts = ok.select("ep_id", "id", F.posexplode(sq.long_split(F.col("raw_text"), F.col("start_ms"), F.col("end_ms"))).alias("part", "x"))
    return parts.select("ep_id", "id", (F.col("part") + 1).alias("part"), "x.text", "x.start_ms", "x.end_ms")


# The fold over an episode's rows as SQL: of every row what survived; the accumulator is the list of rows so far.
_STALE = f"""WITH {b.ALN}, r AS (SELECT ep_id, idx, master_text, coalesce(hallucination_risk, FALSE) AS risk, coalesce(master_text, '') AS m, CASE WHEN coalesce(context_available, FALSE) THEN coalesce(context_text, '') ELSE '' END AS c FROM aln),
l AS (SELECT ep_id, list([{{'idx': idx, 'm': m, 'c': c}}] ORDER BY idx) AS x FROM r GROUP BY 1),
k AS (SELECT ep_id, unnest(list_reduce(x, lambda acc, y: list_append(acc, {{'idx': y[1].idx, 'm': y[1].m,
  'c': CASE WHEN y[1].c <> '' AND y[1].c <> y[1].m AND len(list_filter(acc[-5:], lambda p: p.m = y[1].c OR p.c = y[1].c)) > 0 THEN '' ELSE y[1].c END}}))) AS z FROM l),
kept AS (SELECT ep_id, z.idx AS idx, z.c AS context_kept FROM k)"""


@query(f"{_STALE} SELECT * FROM kept")
def seq_08_stale_context(spark, sf):
    return sq.stale_context(b.aligned(spark, sf), ["ep_id"], "idx", "master_text", "context_text", "context_available", "hallucination_risk")


@query(f"""{_STALE}, s AS (SELECT ep_id, idx, m, risk, row_number() OVER (PARTITION BY ep_id, m ORDER BY idx) - 1 AS seen FROM r)
SELECT s.ep_id, s.idx, s.seen, CASE WHEN k.context_kept <> '' AND k.context_kept <> s.m AND ((length(s.m) >= 8 AND s.seen >= 3) OR s.risk) THEN k.context_kept ELSE s.m END AS effective_text FROM s JOIN kept k ON s.ep_id = k.ep_id AND s.idx = k.idx""")
def seq_09_repetition_guard(spark, sf):
    """The text of each row: its surviving context where the speech repeats itself or is risky, else the speech."""
    rows = b.aligned(spark, sf)
    kept = sq.stale_context(rows, ["ep_id"], "idx", "master_text", "context_text", "context_available", "hallucination_risk")
    rows = rows.select("ep_id", "idx", F.coalesce("master_text", F.lit("")).alias("m"), F.coalesce("hallucination_risk", F.lit(False)).alias("risk"))
    seen = sq.occurrence_number(rows, ["ep_id"], "idx", "m", "seen").join(kept, ["ep_id", "idx"])
    c = F.col("context_kept")
    swap = (c != "") & (c != F.col("m")) & (((F.length("m") >= 8) & (F.col("seen") >= 3)) | F.col("risk"))
    return seen.select("ep_id", "idx", F.col("seen").cast("bigint").alias("seen"), F.when(swap, c).otherwise(F.col("m")).alias("effective_text"))


_ADJ = f"""WITH {b.ALN}, f AS (SELECT ep_id, idx, master_text, lag(trim(master_text)) OVER (PARTITION BY ep_id ORDER BY idx) AS p FROM aln WHERE trim(coalesce(master_text, '')) <> ''),
d AS (SELECT ep_id, idx, master_text FROM f WHERE p IS NULL OR p <> trim(master_text))"""


@query(f"{_ADJ} SELECT * FROM d")
def seq_10_adjacent_dedup(spark, sf):
    return sq.adjacent_distinct(b.aligned(spark, sf).select("ep_id", "idx", "master_text"), ["ep_id"], "idx", "master_text")


@query(f"{_ADJ}, u AS (SELECT *, sum(length(master_text) + 1) OVER (PARTITION BY ep_id ORDER BY idx) AS used FROM d) SELECT ep_id, idx FROM u WHERE used <= 1500")
def seq_11_budget_prefix(spark, sf):
    rows = sq.adjacent_distinct(b.aligned(spark, sf).select("ep_id", "idx", "master_text"), ["ep_id"], "idx", "master_text")
    return sq.budget_prefix(rows, ["ep_id"], "idx", F.length("master_text") + 1, 1500).select("ep_id", "idx")


@query(f"""WITH {b.ASR}, t AS (SELECT ep_id, id, start_ms, end_ms, trim(text) AS t FROM asr WHERE text IS NOT NULL),
n AS (SELECT *, lag(t) OVER w AS p, lag(end_ms) OVER w AS pe, lead(t) OVER w AS nt, lead(start_ms) OVER w AS ns FROM t WINDOW w AS (PARTITION BY ep_id ORDER BY id))
SELECT ep_id, id, CASE WHEN coalesce(p LIKE '%.' AND start_ms - pe <= 500 AND regexp_matches(t, '^(To|And|But|Or|So|Because|When|If) '), FALSE) THEN lower(substr(t, 1, 1)) || substr(t, 2)
  ELSE t END AS text, coalesce(t LIKE '%.' AND ns - end_ms <= 500 AND regexp_matches(nt, '^(To|And|But|Or|So|Because|When|If) '), FALSE) AS continues FROM n""")
def seq_12_continuation(spark, sf):
    rows = b.asr(spark, sf).filter("text is not null").select("ep_id", "id", "start_ms", "end_ms", F.trim("text").alias("t"))
    rows = sq.previous(rows, ["ep_id"], "id", F.struct("t", "end_ms"), "p")
    rows = sq.following(rows, ["ep_id"], "id", F.struct("t", "start_ms"), "n")
    starts = "^(To|And|But|Or|So|Because|When|If) "
    cont = F.coalesce(F.col("p.v.t").endswith(".") & (F.col("start_ms") - F.col("p.v.end_ms") <= 500) & F.col("t").rlike(starts), F.lit(False))
    goes = F.coalesce(F.col("t").endswith(".") & (F.col("n.start_ms") - F.col("end_ms") <= 500) & F.col("n.t").rlike(starts), F.lit(False))
    return rows.select("ep_id", "id", F.when(cont, F.concat(F.lower(F.substring("t", 1, 1)), F.expr("substring(t, 2)"))).otherwise(F.col("t")).alias("text"), goes.alias("continues"))


_SECOND = "coalesce(regexp_matches(t, '^(To |([Ii]sn|[Dd]oesn|[Dd]on|[Cc]an|[Ww]on|[Ww]ouldn|[Cc]ouldn|[Ss]houldn|[Dd]idn|[Ww]asn|[Ww]eren|[Hh]asn|[Hh]aven)''t )') AND NOT starts_with(t, 'To be ') AND (ends_with(t, '?') OR ends_with(t, '!')) AND ends_with(p, '.') AND start_ms - pe <= 500, FALSE)"


@query(f"""WITH {b.ASR}, t AS (SELECT ep_id, id, start_ms, text AS t, lag(text) OVER w AS p, lag(end_ms) OVER w AS pe FROM asr WINDOW w AS (PARTITION BY ep_id ORDER BY id)),
s AS (SELECT ep_id, id, t, {_SECOND} AS second FROM t), n AS (SELECT *, coalesce(lead(second) OVER (PARTITION BY ep_id ORDER BY id), FALSE) AS first FROM s)
SELECT ep_id, id, CASE WHEN second THEN lower(substr(t, 1, 1)) || substr(t, 2) WHEN first THEN substr(t, 1, length(t) - 1) ELSE t END AS text, second OR first AS changed FROM n""")
def seq_12_continuation_repair(spark, sf):
    return sq.continuation_repair(b.asr(spark, sf), ["ep_id"], "id", "start_ms", "end_ms", "text")


@query(f"""WITH {b.ASR}, {b.SEG}, c AS (SELECT o.ep_id, o.id AS window_id, a.id, a.start_ms, a.end_ms, regexp_matches(coalesce(a.text, ''), '{_SUSPENSE}') AS opens,
    CASE WHEN regexp_matches(coalesce(a.text, ''), '[\\x{{4E00}}-\\x{{9FFF}}]') THEN regexp_matches(coalesce(a.text, ''), '{_CLOSED_HAN}') ELSE regexp_matches(coalesce(a.text, ''), '{_CLOSED}') END AS closes
  FROM seg o JOIN asr a ON o.ep_id = a.ep_id AND a.end_ms >= a.start_ms AND a.start_ms >= o.start_ms - 100 AND a.end_ms <= o.end_ms + 100 WHERE o.end_ms > o.start_ms AND o.end_ms - a.end_ms BETWEEN 2000 AND 45000)
SELECT ep_id, window_id, arg_min(end_ms, (CASE WHEN opens THEN 0 ELSE 1 END, -start_ms, -id)) AS cut_ms FROM c WHERE opens OR NOT closes GROUP BY 1, 2""")
def seq_15_suspense_cut(spark, sf):
    """End of the last line of a window, 2 to 45 s before its end, that opens a tension; else of the last that does not close one."""
    win = b.segments(spark, sf).filter("end_ms > start_ms").select("ep_id", F.col("id").alias("window_id"), F.col("start_ms").alias("w_s"), F.col("end_ms").alias("w_e"), (F.col("start_ms") - 100).alias("w_from"))
    a = b.asr(spark, sf).filter("end_ms >= start_ms").select("ep_id", "id", F.coalesce("text", F.lit("")).alias("text"), F.col("start_ms").alias("a_s"), F.col("end_ms").alias("a_e"), (F.col("start_ms") + 1).alias("a_p"))
    met = tp.overlap_pairs(win, a, ["ep_id"], ("w_from", "w_e"), ("a_s", "a_p"), bucket_ms=30_000)
    met = met.filter((F.col("a_e") <= F.col("w_e") + 100) & (F.col("w_e") - F.col("a_e")).between(2000, 45_000))
    opens = tx.opens_tension(F.col("text"))
    good = met.filter(opens | ~tx.closes_tension(F.col("text")))
    return good.groupBy("ep_id", "window_id").agg(F.min_by("a_e", F.struct(F.when(opens, 0).otherwise(1), -F.col("a_s"), -F.col("id"))).alias("cut_ms"))


@query(f"""WITH {b.ALN}, d AS (SELECT ep_id, idx, greatest(0, coalesce(end_ms - start_ms, 0)) AS dur FROM aln)
SELECT ep_id, idx, CAST(coalesce(sum(dur) OVER (PARTITION BY ep_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ms FROM d""")
def seq_16_cumulative_offset(spark, sf):
    rows = b.aligned(spark, sf).select("ep_id", "idx", F.greatest(F.lit(0), F.coalesce(F.col("end_ms") - F.col("start_ms"), F.lit(0))).alias("dur"))
    return sq.running_total(rows, ["ep_id"], "idx", F.col("dur"), "t").select("ep_id", "idx", (F.col("t") - F.col("dur")).alias("offset_ms"))


@query(f"WITH {b.ASR} SELECT ep_id, id, row_number() OVER (PARTITION BY ep_id ORDER BY id) AS dense_no FROM asr")
def seq_17_dense_renumber(spark, sf):
    return sq.number_rows(b.asr(spark, sf).select("ep_id", "id"), ["ep_id"], "id", "dense_no")


@query(f"WITH {b.ASR}, n AS (SELECT ep_id, id, (row_number() OVER (PARTITION BY ep_id ORDER BY id) - 1) // 20 AS batch_no FROM asr) SELECT ep_id, batch_no, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id FROM n GROUP BY 1, 2")
def seq_18_fixed_batches(spark, sf):
    rows = sq.number_rows(b.asr(spark, sf).select("ep_id", "id"), ["ep_id"], "id", "n", first=0).withColumn("batch_no", F.expr("n div 20"))
    return rows.groupBy("ep_id", "batch_no").agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query(f"WITH {b.ALN} SELECT segment_id FROM aln WHERE NOT (contains(coalesce(master_text, ''), 'north gate') OR contains(coalesce(master_text, ''), '码头') OR contains(coalesce(master_text, ''), 'templo'))")
def flt_01_phrase_filter(spark, sf):
    t = F.coalesce("master_text", F.lit(""))
    return b.aligned(spark, sf).filter(~F.exists(F.array(*map(F.lit, PHRASES)), lambda p: F.contains(t, p))).select("segment_id")


@query(f"WITH {b.ASR} SELECT ep_id, id FROM asr WHERE NOT (contains(coalesce(text, ''), 'north gate') OR contains(coalesce(text, ''), '码头') OR contains(coalesce(text, ''), 'templo'))")
def flt_02_phrase_filter_speech(spark, sf):
    t = F.coalesce("text", F.lit(""))
    return b.asr(spark, sf).filter(~F.exists(F.array(*map(F.lit, PHRASES)), lambda p: F.contains(t, p))).select("ep_id", "id")


@query(f"WITH {b.ASR} SELECT ep_id, id FROM asr WHERE end_ms - start_ms <= 4000")
def flt_03_over_long(spark, sf):
    return b.asr(spark, sf).filter(F.col("end_ms") - F.col("start_ms") <= 4000).select("ep_id", "id")


@query(f"WITH {b.ASR} SELECT ep_id, id FROM asr WHERE end_ms - start_ms <= 8000")
def flt_03_within_8_seconds(spark, sf):
    return b.asr(spark, sf).filter(F.col("end_ms") - F.col("start_ms") <= 8000).select("ep_id", "id")


@query(f"WITH {b.SEG} SELECT ep_id, id, row_number() OVER (PARTITION BY ep_id ORDER BY id) - 1 AS new_id FROM seg WHERE end_ms - start_ms >= 400")
def flt_04_min_duration(spark, sf):
    kept = b.segments(spark, sf).filter(F.col("end_ms") - F.col("start_ms") >= 400).select("ep_id", "id")
    return sq.number_rows(kept, ["ep_id"], "id", "new_id", first=0)


_LINES = f"""WITH {b.FRM}, k AS (SELECT ep_id, ordinal, list_filter(frame_lines, lambda l: l.confidence >= 0.5 AND trim(coalesce(l.line_text, '')) <> '') AS x FROM frm WHERE frame_lines IS NOT NULL)"""


@query(f"{_LINES} SELECT ep_id, ordinal, len(x) AS n_lines FROM k WHERE len(x) > 0")
def flt_05_line_confidence(spark, sf):
    kept = F.filter("frame_lines", lambda x: (x["confidence"] >= 0.5) & (F.trim(F.coalesce(x["line_text"], F.lit(""))) != ""))
    return b.frames(spark, sf).select("ep_id", "ordinal", F.size(kept).cast("bigint").alias("n_lines")).filter("n_lines > 0")


@query(f"{_LINES} SELECT ep_id, ordinal, array_to_string(list_transform(x, lambda l: l.line_text), ' ') AS text FROM k WHERE len(x) > 0")
def agg_16_frame_lines(spark, sf):
    kept = F.filter("frame_lines", lambda x: (x["confidence"] >= 0.5) & (F.trim(F.coalesce(x["line_text"], F.lit(""))) != ""))
    return b.frames(spark, sf).withColumn("x", kept).filter("size(x) > 0").select("ep_id", "ordinal", F.array_join(F.transform("x", lambda x: x["line_text"]), " ").alias("text"))


@query(f"""WITH {b.ALN} SELECT segment_id, CASE WHEN start_ms IS NULL OR end_ms IS NULL THEN 'missing' WHEN end_ms < start_ms THEN 'reversed' WHEN end_ms = start_ms THEN 'empty' ELSE 'ok' END AS reason FROM aln""")
def flt_10_time_reasons(spark, sf):
    s, e = F.col("start_ms"), F.col("end_ms")
    return b.aligned(spark, sf).select("segment_id", F.when(s.isNull() | e.isNull(), "missing").when(e < s, "reversed").when(e == s, "empty").otherwise("ok").alias("reason"))


@query(f"""WITH {b.ASR} SELECT ep_id, id, coalesce(avg_probability < 0.5, TRUE) AS risky, CAST(coalesce(len(list_filter(words, lambda w: w.probability < 0.4)), 0) AS BIGINT) AS n_low FROM asr""")
def prj_05_threshold_flags(spark, sf):
    low = F.size(F.filter(F.coalesce("words", F.array()), lambda w: w["probability"] < 0.4))
    return b.asr(spark, sf).select("ep_id", "id", F.coalesce(F.col("avg_probability") < 0.5, F.lit(True)).alias("risky"), low.cast("bigint").alias("n_low"))


@query(f"""WITH {b.ALN} SELECT segment_id, CASE WHEN context_available AND context_text IS NOT NULL THEN to_json({{'i': idx, 'm': master_text, 'c': context_text}}) ELSE to_json({{'i': idx, 'm': master_text}}) END AS js FROM aln WHERE master_text IS NOT NULL""")
def prj_01_json_projection(spark, sf):
    c = F.when(F.col("context_available"), F.col("context_text"))
    return b.aligned(spark, sf).filter("master_text is not null").select("segment_id", F.to_json(F.struct(F.col("idx").alias("i"), F.col("master_text").alias("m"), c.alias("c"))).alias("js"))


@query(f"WITH {b.ASR} SELECT printf('%s_%04d', ep_id, id) AS segment_id, printf('%s_lead_%04d', ep_id, id) AS lead_id FROM asr")
def prj_03_numbered_ids(spark, sf):
    return b.asr(spark, sf).select(F.format_string("%s_%04d", "ep_id", "id").alias("segment_id"), F.format_string("%s_lead_%04d", "ep_id", "id").alias("lead_id"))


@query(f"""{_BEST}, x AS (SELECT ep_id, count(*) AS n, count_if(context_available) AS n_ctx, count_if(n_candidates > 1) AS n_multi FROM al GROUP BY 1)
SELECT ep_id, n AS n_segments, n_ctx AS with_context, n - n_ctx AS without_context, round(100.0 * n_ctx / CAST(greatest(n, 1) AS DOUBLE), 1) AS coverage_pct, n_multi AS multi_candidate FROM x""")
def agg_05_alignment_stats(spark, sf):
    al = tp.align_tracks(b.asr(spark, sf), b.blocks(spark, sf)).groupBy("ep_id")
    out = al.agg(F.count(F.lit(1)).alias("n_segments"), F.count_if("context_available").alias("with_context"), F.count_if(F.col("n_candidates") > 1).alias("multi_candidate"))
    return out.withColumn("without_context", F.col("n_segments") - F.col("with_context")).withColumn("coverage_pct", F.round(100.0 * F.col("with_context") / F.greatest("n_segments", F.lit(1)), 1))


@query(f"""{_BEST}, x AS (SELECT al.ep_id, count(*) AS n, count_if(context_available) AS n_ctx FROM al GROUP BY 1), s AS (SELECT ep_id, count_if(end_ms - start_ms < 200) AS short FROM asr GROUP BY 1)
SELECT x.ep_id, x.n_ctx AS with_context, s.short AS n_short FROM x JOIN s ON x.ep_id = s.ep_id WHERE x.n_ctx * 2 < x.n""")
def agg_06_low_coverage(spark, sf):
    speech = b.asr(spark, sf)
    al = tp.align_tracks(speech, b.blocks(spark, sf)).groupBy("ep_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("context_available").alias("with_context")).filter(F.col("with_context") * 2 < F.col("n"))
    short = speech.groupBy("ep_id").agg(F.count_if(F.col("end_ms") - F.col("start_ms") < 200).alias("n_short"))
    return al.join(short, "ep_id").select("ep_id", "with_context", "n_short")


@query(f"WITH {b.ALN} SELECT ep_id, CAST(sum(greatest(0, coalesce(end_ms - start_ms, 0))) AS BIGINT) AS total_ms FROM aln GROUP BY 1")
def agg_15_total_duration(spark, sf):
    return b.aligned(spark, sf).groupBy("ep_id").agg(F.sum(F.greatest(F.lit(0), F.coalesce(F.col("end_ms") - F.col("start_ms"), F.lit(0)))).alias("total_ms"))


@query(f"""WITH {b.FRM}, o AS (SELECT ep_id, conf, row_number() OVER (PARTITION BY ep_id ORDER BY conf, ordinal) - 1 AS r, count(*) OVER (PARTITION BY ep_id) AS n FROM frm WHERE trim(coalesce(combined_text, '')) <> ''),
p AS (SELECT ep_id, min(CASE WHEN r = CAST(floor(0.05 * n) AS BIGINT) THEN conf END) AS low, min(CASE WHEN r = least(n - 1, CAST(floor(0.95 * n) AS BIGINT)) THEN conf END) AS high FROM o WHERE n >= 3 GROUP BY 1)
SELECT ep_id, round(greatest(0.0, (low - 400) / 10000.0), 3) AS low, round(least(1.0, (high + 400) / 10000.0), 3) AS high FROM p""")
def agg_09_percentile_band(spark, sf):
    """The band from the 5th to the 95th percentile, widened by 0.04, within 0 and 1, to three decimals; from three values on."""
    # Scores are whole ten-thousandths: counting them per value bounds each group to 10,001 rows whatever its size.
    from pyspark.sql import Window

    hist = b.frames(spark, sf).filter(F.trim(F.coalesce("combined_text", F.lit(""))) != "").groupBy("ep_id", "conf").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("ep_id")
    acc = hist.withColumn("upto", F.sum("c").over(w.orderBy("conf"))).withColumn("n", F.sum("c").over(w)).filter("n >= 3")
    at = lambda r: F.min(F.when(F.col("upto") > r, F.col("conf")))
    out = acc.groupBy("ep_id").agg(at(F.floor(F.lit(0.05) * F.col("n"))).alias("low"), at(F.least(F.col("n") - 1, F.floor(F.lit(0.95) * F.col("n")))).alias("high"))
    return out.select("ep_id", F.round(F.greatest(F.lit(0.0), (F.col("low") - 400) / 10000.0), 3).alias("low"), F.round(F.least(F.lit(1.0), (F.col("high") + 400) / 10000.0), 3).alias("high"))
