"""Joins over time: interval overlap, ordered context, as-of, window clip.

Overlap joins are equi joins on (keys, time bucket): each interval goes to every bucket it touches and a pair is kept
only in the first bucket both share, so no pair appears twice and nothing has to be made distinct. Intervals that touch
more than ``WIDE`` buckets, on whichever side they are, meet the other side in buckets ``WIDE`` times as long, so no join
runs on the keys alone and a long group stays spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_MS = 10_000
WIDE = 64


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(float(width))).cast("bigint")


def overlap_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], l_span: tuple[str, str], r_span: tuple[str, str], bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Inner join of rows whose half-open intervals overlap by more than nothing; column names must not clash but for keys."""
    keys = list(keys)
    ls, le, rs, re_ = (F.col(c) for c in (*l_span, *r_span))
    left = left.filter(ls.isNotNull() & (le > ls)).withColumns({"__lb": _bucket(ls, bucket_ms), "__lz": _bucket(le - 1, bucket_ms)})
    right = right.filter(rs.isNotNull() & (re_ > rs)).withColumns({"__rb": _bucket(rs, bucket_ms), "__rz": _bucket(re_ - 1, bucket_ms)})
    l_wide, r_wide = F.col("__lz") - F.col("__lb") >= WIDE, F.col("__rz") - F.col("__rb") >= WIDE
    ln = left.filter(~l_wide).withColumn("__b", F.explode(F.sequence("__lb", "__lz")))
    rn = right.filter(~r_wide).withColumn("__b", F.explode(F.sequence("__rb", "__rz")))
    touch = (ls < re_) & (rs < le)
    narrow = ln.join(rn, [*keys, "__b"]).filter(touch & (F.col("__b") == F.greatest("__lb", "__rb"))).drop("__b")

    def coarse(a: DataFrame, b: DataFrame) -> DataFrame:
        wide = bucket_ms * WIDE
        a = a.withColumn("__a", _bucket(ls, wide)).withColumn("__b", F.explode(F.sequence("__a", _bucket(le - 1, wide))))
        b = b.withColumn("__c", _bucket(rs, wide)).withColumn("__b", F.explode(F.sequence("__c", _bucket(re_ - 1, wide))))
        return a.join(b, [*keys, "__b"]).filter(touch & (F.col("__b") == F.greatest("__a", "__c"))).drop("__a", "__b", "__c")

    out = narrow.unionByName(coarse(left.filter(l_wide), right)).unionByName(coarse(left.filter(~l_wide), right.filter(r_wide)))
    return out.drop("__lb", "__lz", "__rb", "__rz")


def overlap_score(shared: Column, a: Column, b: Column) -> Column:
    """Overlap over the shorter duration, 4 decimals; 0 where a duration is not positive."""
    short = F.least(a, b)
    return F.when(short > 0, F.round(shared / short, 4)).otherwise(F.lit(0.0))


def align_candidates(speech: DataFrame, screen: DataFrame, min_ms: int = 200, abs_ms: int = 500, ratio_x10: int = 4) -> DataFrame:
    """Qualified candidates of each speech segment: ep_id, id, block_no, shared_ms, score. Strict bounds, whole numbers."""
    a = speech.select("ep_id", "id", F.col("start_ms").alias("a_s"), F.col("end_ms").alias("a_e")).filter(F.col("a_e") - F.col("a_s") >= min_ms)
    b = screen.select("ep_id", "block_no", F.col("start_ms").alias("b_s"), F.col("end_ms").alias("b_e"))
    pairs = overlap_pairs(a, b, ["ep_id"], ("a_s", "a_e"), ("b_s", "b_e"))
    dur, other = F.col("a_e") - F.col("a_s"), F.col("b_e") - F.col("b_s")
    pairs = pairs.withColumn("shared_ms", F.least("a_e", "b_e") - F.greatest("a_s", "b_s"))
    good = (F.col("shared_ms") > abs_ms) | (F.col("shared_ms") * 10 > dur * ratio_x10)
    return pairs.filter(good).select("ep_id", "id", "block_no", "shared_ms", overlap_score(F.col("shared_ms"), dur, other).alias("score"))


def align_tracks(speech: DataFrame, screen: DataFrame) -> DataFrame:
    """Every speech segment with its best candidate's text and the number of candidates (left join)."""
    cand = align_candidates(speech, screen).join(screen.select("ep_id", "block_no", "combined_text"), ["ep_id", "block_no"])
    best = cand.groupBy("ep_id", "id").agg(F.count(F.lit(1)).alias("n_candidates"), F.max_by(F.struct("block_no", "score", "combined_text"), F.struct("score", -F.col("block_no"))).alias("b"))
    out = speech.select("ep_id", "id").join(best, ["ep_id", "id"], "left")
    text = F.coalesce("b.combined_text", F.lit(""))
    return out.select("ep_id", "id", F.coalesce("n_candidates", F.lit(0)).cast("bigint").alias("n_candidates"), F.col("b.block_no").alias("best_block"), F.col("b.score").alias("best_score"), text.alias("context_text"), (text != "").alias("context_available"))


def ordered_context(screen: DataFrame, speech: DataFrame) -> DataFrame:
    """Every screen segment with all overlapping speech in order of start, joined without a separator."""
    a = screen.select("ep_id", F.col("id").alias("seg_id"), F.col("start_ms").alias("o_s"), F.col("end_ms").alias("o_e"))
    b = speech.select("ep_id", "id", "text", F.col("start_ms").alias("a_s"), F.col("end_ms").alias("a_e"))
    pairs = overlap_pairs(a, b, ["ep_id"], ("o_s", "o_e"), ("a_s", "a_e"))
    said = pairs.groupBy("ep_id", "seg_id").agg(F.array_sort(F.collect_list(F.struct("a_s", "id", F.coalesce("text", F.lit("")).alias("text")))).alias("x"))
    said = said.select("ep_id", "seg_id", F.trim(F.array_join(F.transform("x", lambda x: x["text"]), "")).alias("context_text"))
    out = a.select("ep_id", "seg_id").join(said, ["ep_id", "seg_id"], "left").withColumn("context_text", F.coalesce("context_text", F.lit("")))
    return out.withColumn("context_available", F.col("context_text") != "")


def asof_end(points: DataFrame, spans: DataFrame, keys: Sequence[str], slack_ms: int = 100, bucket_ms: int = 60_000) -> DataFrame:
    """For each point (keys, pid, ts): the end of the first span holding it (``slack_ms`` each side), else the end of the last span that starts at or before ts + slack; null if none.

    Spans (keys, pos, s, e) in order of start. The last start is found by shard: a point looks in its own time bucket and,
    if that has no earlier start, at the last non-empty bucket before it, from one summary row a bucket.
    """
    keys = list(keys)
    p = points.withColumn("__b", _bucket(F.col("ts") + slack_ms, bucket_ms))
    s = spans.filter("s is not null").withColumn("__b", _bucket(F.col("s"), bucket_ms))
    # A span that contains the point: an overlap join of [ts, ts + 1) with [s, e + slack + 1).
    a = points.withColumn("__t1", F.col("ts") + 1)
    holds = overlap_pairs(a, spans.withColumn("__e1", F.col("e") + slack_ms + 1).select(*keys, "pos", "s", "e", "__e1"), keys, ("ts", "__t1"), ("s", "__e1"))
    inside = holds.groupBy(*keys, "pid").agg(F.min_by("e", F.struct("s", "pos")).alias("in_end"))
    here = p.join(s, [*keys, "__b"], "left").groupBy(*keys, "pid", "__b").agg(F.max_by("e", F.when(F.col("s") <= F.col("ts") + slack_ms, F.struct("s", "pos"))).alias("here_end"))
    last = s.groupBy(*keys, "__b").agg(F.max_by("e", F.struct("s", "pos")).alias("bucket_end"))
    marks = p.select(*keys, "__b").distinct().withColumn("bucket_end", F.lit(None).cast("bigint")).unionByName(last).groupBy(*keys, "__b").agg(F.max("bucket_end").alias("bucket_end"))
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = marks.select(*keys, "__b", F.last("bucket_end", ignorenulls=True).over(w).alias("before_end"))
    out = here.join(before, [*keys, "__b"], "left").join(inside, [*keys, "pid"], "left")
    return out.select(*keys, "pid", F.coalesce("in_end", "here_end", "before_end").alias("snapped_ms"))


def clip_window(spans: DataFrame, windows: DataFrame, keys: Sequence[str], offset_ms: int = 0) -> DataFrame:
    """Spans that start within [w_s, w_e) of a window, moved to the window's start plus ``offset_ms``, ends clamped, empty ones dropped."""
    w = windows.select(*keys, "wid", "w_s", "w_e")
    pts = spans.withColumn("__p1", F.col("s") + 1)
    met = overlap_pairs(pts, w, keys, ("s", "__p1"), ("w_s", "w_e")).withColumn("__e", F.least("e", "w_e"))
    moved = met.filter(F.col("__e") > F.col("s"))
    return moved.select(*keys, "wid", "pos", (F.col("s") - F.col("w_s") + offset_ms).alias("start_ms"), (F.col("__e") - F.col("w_s") + offset_ms).alias("end_ms"))


def align_with_rescue(speech: DataFrame, screen: DataFrame, min_speech: int = 10, min_screen: int = 5, margin_ms: int = 1000) -> DataFrame:
    """The aligned track of every episode: ep_id, segment_id, start_ms, end_ms, master_text, master_source, context_text, context_available.

    Speech leads, with its best block as context. Where an episode has fewer than ``min_speech`` segments but at least
    ``min_screen`` blocks, the blocks lead (near copies merged) and all overlapping speech is their context. Elsewhere blocks
    that end ``margin_ms`` before the first segment (by id) come first, merged alike, without context. Times that are null
    lead nothing.
    """
    from framewright.operators.sequence import dedup_blocks, number_rows

    n_a = speech.groupBy("ep_id").agg(F.count(F.lit(1)).alias("n_a"), F.min_by("start_ms", F.when(F.col("start_ms").isNotNull(), F.col("id"))).alias("first_ms"))
    n_k = screen.groupBy("ep_id").agg(F.count(F.lit(1)).alias("n_k"))
    route = n_a.join(n_k, "ep_id", "full").select("ep_id", "first_ms", ((F.coalesce("n_a", F.lit(0)) < min_speech) & (F.coalesce("n_k", F.lit(0)) >= min_screen)).alias("flip"))

    def merged(blocks: DataFrame) -> DataFrame:
        """Blocks with near neighbours merged, numbered from 0 in order of start."""
        done = dedup_blocks(blocks, ["ep_id"], "block_no", "start_ms", "end_ms", "combined_text", "conf")
        return number_rows(done, ["ep_id"], "start_ms", "no", first=0)

    blocks = screen.join(route, "ep_id")
    flipped = merged(blocks.filter("flip"))
    context = ordered_context(flipped.withColumnRenamed("no", "id"), speech)
    led = flipped.join(context.withColumnRenamed("seg_id", "no"), ["ep_id", "no"], "left")
    name = lambda form, no: F.format_string(form, F.col("ep_id"), F.col(no))
    cols = ["ep_id", "segment_id", "start_ms", "end_ms", "master_text", "master_source", "context_text", "context_available"]
    led = led.select("ep_id", name("%s_%04d", "no").alias("segment_id"), "start_ms", "end_ms", F.col("combined_text").alias("master_text"), F.lit("ocr").alias("master_source"), F.coalesce("context_text", F.lit("")).alias("context_text"), F.coalesce("context_available", F.lit(False)).alias("context_available"))
    leading = merged(blocks.filter(~F.col("flip") & (F.col("end_ms") <= F.col("first_ms") - margin_ms)))
    leading = leading.select("ep_id", name("%s_lead_%04d", "no").alias("segment_id"), "start_ms", "end_ms", F.col("combined_text").alias("master_text"), F.lit("ocr_leading").alias("master_source"), F.lit("").alias("context_text"), F.lit(False).alias("context_available"))
    main = speech.join(route.filter(~F.col("flip")).select("ep_id"), "ep_id", "left_semi")
    main = main.select("ep_id", "id", "start_ms", "end_ms", F.coalesce("text", F.lit("")).alias("master_text")).join(align_tracks(main, screen), ["ep_id", "id"])
    main = main.select("ep_id", name("%s_%04d", "id").alias("segment_id"), "start_ms", "end_ms", "master_text", F.lit("asr").alias("master_source"), "context_text", "context_available")
    return led.select(cols).unionByName(leading.select(cols)).unionByName(main.select(cols))
