"""Further registered queries: gates, batches, ordering, set relations, limits, plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framewright.functions import text as tx
from framewright.functions import timecode as tc
from framewright.operators import planning as pl
from framewright.operators import sequence as sq
from framewright.plans import base as b
from framewright.session import table
from framewright.sources.tracks import sample_per_group

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_WIDE = "[\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}\\x{F900}-\\x{FAFF}\\x{3000}-\\x{303F}\\x{FF00}-\\x{FFEF}]"


_EPISODES = "eps AS (SELECT ep_id, drama, row_number() OVER (PARTITION BY drama ORDER BY TRY_CAST(regexp_extract(ep_id, 'ep(\\d+)$', 1) AS INT) NULLS LAST, ep_id) AS place FROM (SELECT DISTINCT ep_id, drama FROM episode_result) q)"


def _episodes(spark, sf):
    """Episodes in natural order within their drama: one row an episode."""
    no = F.regexp_extract("ep_id", r"ep(\d+)$", 1).try_cast("int")
    w = Window.partitionBy("drama").orderBy(no.asc_nulls_last(), "ep_id")
    return table(spark, sf, "episode_result").select("ep_id", "drama").distinct().select("ep_id", "drama", F.row_number().over(w).alias("place"))


@query(f"""WITH {b.ASR}, {_EPISODES}, t AS (SELECT ep_id, sum(length(coalesce(text, ''))) + count(*) - 1 AS n, sum(length(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]', '', 'g'))) AS solid, sum(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{_WIDE}', '', 'g'))) AS c FROM asr GROUP BY 1),
h AS (SELECT drama, t.*, coalesce(sum(n) OVER (PARTITION BY drama ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM eps JOIN t USING (ep_id) WHERE place <= 3),
s AS (SELECT drama, sum(n) AS n_chars, sum(c) AS c, sum(solid) AS solid FROM h WHERE before < 100 GROUP BY 1)
SELECT drama, CAST(n_chars AS BIGINT) AS n_chars, round(CASE WHEN solid > 0 THEN c / CAST(solid AS DOUBLE) ELSE 0.0 END, 4) AS wide_ratio, CASE WHEN n_chars < 20 THEN 'too_short' WHEN c < 0.2 * solid THEN 'not_zh' WHEN c > 0.6 * solid THEN 'not_en' ELSE 'either' END AS gate FROM s""")
def agg_08_language_gate(spark, sf):
    """Which language a drama's speech cannot be in, from its first three episodes together, as many as give 100 characters."""
    t = F.coalesce("text", F.lit(""))
    per = b.asr(spark, sf).groupBy("ep_id").agg((F.sum(F.length(t)) + F.count(F.lit(1)) - 1).alias("n"), F.sum(F.length(F.regexp_replace(t, r"[ \t\r\n]", ""))).alias("solid"), F.sum(F.regexp_count(t, F.lit(tx.WIDE_RANGES))).alias("c"))
    w = Window.partitionBy("drama").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # three rows a drama
    h = _episodes(spark, sf).filter("place <= 3").join(per, "ep_id").withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).filter("before < 100")
    s = h.groupBy("drama").agg(F.sum("n").alias("n_chars"), F.sum("c").alias("c"), F.sum("solid").alias("solid"))
    gate = F.when(F.col("n_chars") < 20, "too_short").when(F.col("c") < 0.2 * F.col("solid"), "not_zh").when(F.col("c") > 0.6 * F.col("solid"), "not_en").otherwise("either")
    return s.select("drama", "n_chars", F.round(F.when(F.col("solid") > 0, F.col("c") / F.col("solid")).otherwise(F.lit(0.0)), 4).alias("wide_ratio"), gate.alias("gate"))


@query(f"""WITH {b.ALN}, {_EPISODES}, e AS (SELECT *, (place - 1) // 20 AS batch_no, count(*) OVER (PARTITION BY drama, (place - 1) // 20) AS n_eps FROM eps),
f AS (SELECT ep_id, idx, trim(master_text, ' ') AS m, lag(trim(master_text, ' ')) OVER (PARTITION BY ep_id ORDER BY idx) AS p FROM aln WHERE trim(coalesce(master_text, ''), ' ') <> ''),
u AS (SELECT *, sum(length(m) + 1) OVER (PARTITION BY ep_id ORDER BY idx) AS used FROM f WHERE p IS NULL OR p <> m),
t AS (SELECT e.drama, e.batch_no, e.place, '# ' || ep_id || chr(10) || string_agg(m, chr(10) ORDER BY idx) AS body FROM u JOIN e USING (ep_id) WHERE used <= 30000 // n_eps GROUP BY e.drama, e.batch_no, e.place, ep_id)
SELECT drama, batch_no, string_agg(body, chr(10) || chr(10) ORDER BY place) AS body FROM t GROUP BY 1, 2""")
def agg_18_batch_text(spark, sf):
    """Text of each batch of 20 episodes in natural order; 30,000 characters split over the batch's episodes, neighbours made distinct."""
    e = _episodes(spark, sf).withColumn("batch_no", F.expr("cast((place - 1) div 20 as bigint)"))
    e = e.withColumn("n_eps", F.count(F.lit(1)).over(Window.partitionBy("drama", "batch_no")))
    said = b.aligned(spark, sf).select("ep_id", "idx", F.trim("master_text").alias("m"))
    rows = sq.adjacent_distinct(said, ["ep_id"], "idx", "m")
    rows = sq.running_total(rows, ["ep_id"], "idx", F.length("m") + 1, "used").filter("used <= 30000").join(e, "ep_id").filter(F.col("used") <= F.expr("30000 div n_eps"))
    one = rows.groupBy("drama", "batch_no", "place", "ep_id").agg(F.array_sort(F.collect_list(F.struct("idx", "m"))).alias("x"))  # at most 30,000 characters a batch
    one = one.select("drama", "batch_no", "place", F.concat(F.lit("# "), "ep_id", F.lit("\n"), F.array_join(F.transform("x", lambda r: r["m"]), "\n")).alias("t"))
    whole = one.groupBy("drama", "batch_no").agg(F.array_sort(F.collect_list(F.struct("place", "t"))).alias("x"))
    return whole.select("drama", "batch_no", F.array_join(F.transform("x", lambda r: r["t"]), "\n\n").alias("body"))


@query(f"WITH {b.DOC} SELECT source, count(*) AS n_docs, min(created_at) AS first_at, max(created_at) AS last_at FROM doc GROUP BY 1")
def agg_19_earliest_time(spark, sf):
    return b.documents(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


@query("""WITH k AS (SELECT DISTINCT ep_id, drama FROM episode_result) SELECT ep_id, row_number() OVER (PARTITION BY drama ORDER BY TRY_CAST(regexp_extract(ep_id, 'ep(\\d+)$', 1) AS INT) NULLS LAST, ep_id) AS place FROM k""")
def ord_02_number_or_text(spark, sf):
    no = F.regexp_extract("ep_id", r"ep(\d+)$", 1).try_cast("int")
    w = Window.partitionBy("drama").orderBy(no.asc_nulls_last(), "ep_id")  # episodes of a drama, one row each
    return table(spark, sf, "episode_result").select("ep_id", "drama").distinct().select("ep_id", F.row_number().over(w).cast("bigint").alias("place"))


@query("""WITH k AS (SELECT DISTINCT ep_id, drama, cjk_ratio, coalesce(dominant, '') AS d FROM episode_result) SELECT ep_id, row_number() OVER (PARTITION BY drama ORDER BY CASE WHEN d IN ('cjk', 'latin') THEN 1 ELSE 0 END, ep_id DESC) AS place FROM k""")
def ord_05_two_key_sort(spark, sf):
    d = F.coalesce("dominant", F.lit(""))
    w = Window.partitionBy("drama").orderBy(F.when(d.isin("cjk", "latin"), 1).otherwise(0), F.desc("ep_id"))
    return table(spark, sf, "episode_result").select("ep_id", "drama", "dominant").distinct().select("ep_id", F.row_number().over(w).cast("bigint").alias("place"))


@query(f"WITH {b.DOC}, s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS n FROM doc GROUP BY 1) SELECT source, n FROM s ORDER BY n DESC NULLS LAST, source LIMIT 5")
def ord_04_largest_sources(spark, sf):
    return b.documents(spark, sf).groupBy("source").agg(F.sum("n_chars").alias("n")).orderBy(F.col("n").desc_nulls_last(), "source").limit(5)


@query(f"""WITH {b.ASR}, {_EPISODES}, l AS (SELECT drama, place, ep_id, id, text, row_number() OVER (PARTITION BY drama ORDER BY place, id) AS line_no FROM asr JOIN eps USING (ep_id) WHERE place <= 3 AND trim(coalesce(text, '')) <> '')
SELECT drama, line_no, ep_id, id, text FROM l WHERE line_no <= 120""")
def lim_02_first_lines(spark, sf):
    """The first 120 lines of a drama's first three episodes together, in natural order."""
    rows = b.asr(spark, sf).filter(F.trim(F.coalesce("text", F.lit(""))) != "").select("ep_id", "id", "text")
    head = rows.join(_episodes(spark, sf).filter("place <= 3"), "ep_id")
    w = Window.partitionBy("drama").orderBy("place", "id")
    # The limit goes below the shuffle (WindowGroupLimit): a task sends 120 rows a drama at most.
    return head.withColumn("line_no", F.row_number().over(w)).filter("line_no <= 120").select("drama", F.col("line_no").cast("bigint").alias("line_no"), "ep_id", "id", "text")


@query(f"WITH {b.ALN}, {b.BLK} SELECT ep_id, idx AS no, master_text AS text, 1 AS rank_no FROM aln UNION ALL SELECT ep_id, block_no, combined_text, 0 FROM blk")
def set_01_ordered_union(spark, sf):
    a = b.aligned(spark, sf).select("ep_id", F.col("idx").alias("no"), F.col("master_text").alias("text"), F.lit(1).alias("rank_no"))
    k = b.blocks(spark, sf).select("ep_id", F.col("block_no").alias("no"), F.col("combined_text").alias("text"), F.lit(0).alias("rank_no"))
    return a.unionByName(k)


@query(f"""WITH {b.DOC}, l AS (SELECT source, list_sort(list(DISTINCT lang) FILTER (lang IS NOT NULL AND lang NOT IN ('', 'und'))) AS have, count_if(lang = 'en') AS n_en, count_if(lang = 'zh') AS n_zh FROM doc WHERE source IS NOT NULL GROUP BY 1)
SELECT source, array_to_string(list_filter(['de', 'en', 'es', 'fr', 'pt', 'zh'], lambda x: NOT list_contains(have, x)), ',') AS missing, len(list_filter(['en', 'zh'], lambda x: NOT list_contains(have, x))) = 0 AND n_en = n_zh AS covers FROM l WHERE have IS NOT NULL""")
def set_05_coverage(spark, sf):
    """Languages a source lacks; it covers what is asked if it has both languages with equally many documents."""
    docs = b.documents(spark, sf).filter("source is not null and lang is not null and lang not in ('', 'und')")
    have = docs.groupBy("source").agg(F.collect_set("lang").alias("have"), F.count_if(F.col("lang") == "en").alias("n_en"), F.count_if(F.col("lang") == "zh").alias("n_zh"))
    all_ = F.array(*map(F.lit, ("de", "en", "es", "fr", "pt", "zh")))
    both = F.size(F.array_except(F.array(F.lit("en"), F.lit("zh")), "have")) == 0
    return have.select("source", F.array_join(F.array_except(all_, "have"), ",").alias("missing"), (both & (F.col("n_en") == F.col("n_zh"))).alias("covers"))


@query("""WITH c AS (SELECT DISTINCT drama, canonical, aliases, ocr_en_variants FROM cast_member) SELECT drama, canonical, list_sort(list_distinct(list_concat(coalesce(aliases, []), coalesce(ocr_en_variants, []))))[1] AS first_name, len(list_distinct(list_concat(coalesce(aliases, []), coalesce(ocr_en_variants, [])))) AS n FROM c""")
def set_06_array_union(spark, sf):
    c = table(spark, sf, "cast_member").select("drama", "canonical", "aliases", "ocr_en_variants").distinct()
    none = F.array().cast("array<string>")
    u = F.array_union(F.coalesce("aliases", none), F.coalesce("ocr_en_variants", none))
    return c.select("drama", "canonical", F.get(F.array_sort(u), F.lit(0)).alias("first_name"), F.size(u).cast("bigint").alias("n"))


@query(f"""WITH {b.ADS}, p AS (SELECT copy_id, primary_text AS t, headline AS fix FROM ads WHERE primary_text IS NOT NULL)
SELECT copy_id, CASE WHEN length(t) <= 120 THEN t WHEN length(coalesce(fix, '')) BETWEEN 1 AND 120 THEN fix ELSE substr(t, 1, 120) END AS text, length(t) > 120 AS violated FROM p""")
def val_02_check_correct_cut(spark, sf):
    t, fix = F.col("primary_text"), F.coalesce("headline", F.lit(""))
    text = F.when(F.length(t) <= 120, t).when(F.length(fix).between(1, 120), fix).otherwise(F.substring(t, 1, 120))
    return b.ad_copy(spark, sf).filter(t.isNotNull()).select("copy_id", text.alias("text"), (F.length(t) > 120).alias("violated"))


@query("""WITH c AS (SELECT DISTINCT drama, batch_index, canonical FROM cast_member), n AS (SELECT drama, count(*) FILTER (batch_index = 0) AS n0, count(*) FILTER (batch_index = 1) AS n1 FROM c GROUP BY 1) SELECT drama, CASE WHEN n1 = 0 OR n1 > 2 * n0 THEN 'first' ELSE 'second' END AS kept FROM n""")
def val_03_reduce_sanity(spark, sf):
    c = table(spark, sf, "cast_member").select("drama", "batch_index", "canonical").distinct()
    n = c.groupBy("drama").agg(F.count_if(F.col("batch_index") == 0).alias("n0"), F.count_if(F.col("batch_index") == 1).alias("n1"))
    return n.select("drama", F.when((F.col("n1") == 0) | (F.col("n1") > 2 * F.col("n0")), "first").otherwise("second").alias("kept"))


@query(f"WITH {b.FRM}, l AS (SELECT ep_id, ordinal, unnest(frame_lines) AS x FROM frm WHERE frame_lines IS NOT NULL) SELECT ep_id, count(*) AS n_lines, count_if(x.confidence >= 0.5) AS n_sure, count_if(length(x.line_text) >= 12 AND x.confidence >= 0.5) AS n_wide FROM l GROUP BY 1")
def flt_06_box_predicate(spark, sf):
    lines = b.frames(spark, sf).select("ep_id", F.explode("frame_lines").alias("x"))
    sure = F.col("x.confidence") >= 0.5
    return lines.groupBy("ep_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(sure).alias("n_sure"), F.count_if(sure & (F.length("x.line_text") >= 12)).alias("n_wide"))


@query(f"""WITH {b.ALN}, {b.SEG}, ix AS (SELECT ep_id, idx, start_ms, end_ms FROM aln)
SELECT s.ep_id, s.id, CAST(a.start_ms AS BIGINT) AS from_ms, CAST(e.end_ms AS BIGINT) AS to_ms FROM seg s LEFT JOIN ix a ON a.ep_id = s.ep_id AND a.idx = s.id LEFT JOIN ix e ON e.ep_id = s.ep_id AND e.idx = s.id + 2""")
def join_06_double_lookup(spark, sf):
    ix = b.aligned(spark, sf).select("ep_id", "idx", "start_ms", "end_ms")
    s = b.segments(spark, sf).select("ep_id", "id", (F.col("id") + 2).alias("last"))
    a = ix.select("ep_id", F.col("idx").alias("id"), F.col("start_ms").alias("from_ms"))
    e = ix.select("ep_id", F.col("idx").alias("last"), F.col("end_ms").alias("to_ms"))
    return s.join(a, ["ep_id", "id"], "left").join(e, ["ep_id", "last"], "left").select("ep_id", "id", "from_ms", "to_ms")


@query(f"WITH {b.ASR} SELECT ep_id, id, substr(replace(text, chr(10), '\\n'), 1, 80) AS prompt FROM asr WHERE text IS NOT NULL")
def fn_25_prompt_head(spark, sf):
    return b.asr(spark, sf).filter("text is not null").select("ep_id", "id", F.substring(F.replace("text", F.lit("\n"), F.lit("\\n")), 1, 80).alias("prompt"))


@query(f"WITH {b.ASR} SELECT ep_id, id, replace(substr(text, 1, 800), chr(10), '\\n') AS prompt FROM asr WHERE text IS NOT NULL")
def fn_25_prompt_head_800(spark, sf):
    return b.asr(spark, sf).filter("text is not null").select("ep_id", "id", F.replace(F.substring("text", 1, 800), F.lit("\n"), F.lit("\\n")).alias("prompt"))


@query(f"WITH {b.ASR} SELECT ep_id, id, 'Episode ' || ep_id || ', line ' || CAST(id AS VARCHAR) || ': ' || coalesce(text, '') AS prompt FROM asr")
def fn_29_template(spark, sf):
    out = F.lit("Episode {ep}, line {id}: {text}")
    for k, v in (("{ep}", F.col("ep_id")), ("{id}", F.col("id").cast("string")), ("{text}", F.coalesce("text", F.lit("")))):
        out = F.replace(out, F.lit(k), v)
    return b.asr(spark, sf).select("ep_id", "id", out.alias("prompt"))


@query("""WITH c AS (SELECT DISTINCT drama, canonical, canonical_en FROM cast_member WHERE canonical_en IS NOT NULL)
SELECT drama, canonical, t AS token FROM (SELECT drama, canonical, unnest(regexp_split_to_array(lower(canonical_en), '\\s+')) AS t FROM c) q WHERE length(t) >= 3""")
def fn_22_name_tokens(spark, sf):
    c = table(spark, sf, "cast_member").filter("canonical_en is not null").select("drama", "canonical", "canonical_en").distinct()
    return c.select("drama", "canonical", F.explode(tx.name_tokens(F.col("canonical_en"))).alias("token"))


# A sentence that gives every person a title, since the tables hold none.
_GIVES = "'The elders proclaim ' || canonical_en || ' as the Luna Princess of ep. He becomes Young Master  Ju Of The House Xi'"


@query(f"""WITH c AS (SELECT DISTINCT drama, canonical, canonical_en FROM cast_member WHERE canonical_en IS NOT NULL),
a AS (SELECT drama, canonical, {_GIVES} AS said, canonical_en FROM c), p AS (SELECT drama, canonical, unnest(regexp_extract_all(said, '\\b(?:as|becomes?)\\s+(?:the\\s+|a\\s+|an\\s+|his\\s+|her\\s+)?([A-Z][a-zA-Z]+(?:\\s+[A-Z][a-zA-Z]+)+)', 1)) AS p FROM a
  WHERE len(list_filter(regexp_split_to_array(lower(canonical_en), '\\s+'), lambda t: length(t) >= 3)) > 0)
SELECT DISTINCT drama, canonical, lower(regexp_replace(p, '\\s+', ' ', 'g')) AS alias FROM p WHERE len(regexp_split_to_array(p, '\\s+')) BETWEEN 2 AND 4""")
def fn_22_alias_phrases(spark, sf):
    c = table(spark, sf, "cast_member").filter("canonical_en is not null").select("drama", "canonical", "canonical_en").distinct()
    found = tx.title_phrases(F.expr(_GIVES), tx.name_tokens(F.col("canonical_en")))
    return c.select("drama", "canonical", F.explode(found).alias("alias")).distinct()


@query(f"WITH {b.ASR} SELECT ep_id, id, start_ms // 3600000 AS h, start_ms // 60000 % 60 AS m, start_ms // 1000 % 60 AS s, start_ms % 1000 AS f FROM asr WHERE start_ms >= 0")
def fn_04_ms_codec(spark, sf):
    p = tc._parts(F.col("start_ms"))
    return b.asr(spark, sf).filter("start_ms >= 0").select("ep_id", "id", *[c.alias(n) for c, n in zip(p, "hmsf")])


@query()
def src_16_seeded_sample(spark, sf):
    return sample_per_group(b.documents(spark, sf).select("doc_id", "source"), "source", "doc_id", 20)


@query()
def seq_13_plan_extension(spark, sf):
    scenes = b.aligned(spark, sf).select("ep_id", F.col("idx").alias("pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    plans = b.segments(spark, sf).select("ep_id", F.col("id").alias("plan_id"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    return pl.extend_plans(plans, scenes)
