"""Registered queries around the model boundary, budgets and reports, with the equal SQL over the default provider."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framewright import models
from framewright.functions import text as tx
from framewright.operators import planning as pl
from framewright.operators import temporal as tp
from framewright.plans import base as b
from framewright.plans import more_queries as mq
from framewright.session import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
MAP, REDUCE = "List the people of these episodes.", "Merge the lists into one."
SKELETON, REFINE, MINOR = "Translate word for word.", "Make it fluent.", "Translate into"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _ask(system: str, user: str) -> str:
    """The default provider's answer as SQL."""
    return f"substr(sha256({system} || chr(10) || {user}), 1, 16)"


@query(f"""WITH t AS ({mq.ORACLE_SQL["agg_18_batch_text"]}), m AS (SELECT drama, batch_no, {_ask(f"'{MAP}'", "body")} AS a FROM t), j AS (SELECT drama, count(*) AS n, string_agg(a, chr(10) ORDER BY batch_no) AS u FROM m GROUP BY 1)
SELECT drama, CAST(n AS INT) AS n_parts, {_ask(f"'{REDUCE}'", "u")} AS answer FROM j""")
def mod_04_map_reduce(spark, sf):
    return models.map_then_reduce(mq.agg_18_batch_text(spark, sf), "drama", "batch_no", "body", MAP, REDUCE)


@query(f"""WITH {b.ADS}, s AS (SELECT copy_id, {_ask(f"'{SKELETON}'", "coalesce(headline, '')")} AS t FROM ads), r AS (SELECT copy_id, {_ask(f"'{REFINE}'", "t")} AS t FROM s)
SELECT copy_id, 'en' AS lang, t AS text FROM r UNION ALL SELECT copy_id, l, {_ask(f"'{MINOR} ' || l", "t")} FROM r, (SELECT unnest(['es', 'pt']) AS l) q""")
def mod_06_translation_steps(spark, sf):
    return models.translate(b.ad_copy(spark, sf), "copy_id", "headline", ("es", "pt"), SKELETON, REFINE, MINOR)


@query(f"""WITH c AS (SELECT drama, canonical, max(canonical_en) AS en FROM cast_member GROUP BY 1, 2)
SELECT drama, canonical, coalesce(nullif(trim(en, ' '), ''), {_ask("'Write this name in English.'", "canonical")}) AS form, coalesce(trim(en, ' '), '') = '' AS asked FROM c""")
def mod_07_name_forms(spark, sf):
    c = table(spark, sf, "cast_member").groupBy("drama", "canonical").agg(F.max("canonical_en").alias("en"))
    out = models.fill_names(c.withColumn("key", F.struct("drama", "canonical")), "key", "canonical", "en", "Write this name in English.")
    return out.select("key.drama", "key.canonical", "form", "asked")


@query(f"""WITH {b.ADS} SELECT copy_id, {_ask("'Write the copy of clip ' || CAST(clip_id AS VARCHAR)", "coalesce(primary_text, '')")} AS answer FROM ads WHERE clip_id IS NOT NULL""")
def mod_09_clip_copy(spark, sf):
    rows = b.ad_copy(spark, sf).filter("clip_id is not null").select("copy_id", F.concat(F.lit("Write the copy of clip "), F.col("clip_id").cast("string")).alias("system"), F.coalesce("primary_text", F.lit("")).alias("user"))
    return models.complete(rows, "copy_id", "system", "user").select("copy_id", "answer")


# Tokens of each stage's instructions, of a missing subtitle file and of a person; characters read of a file.
O_MAP, O_REDUCE, O_REFINE, O_SCENES, O_RHYTHM, O_SKELETON, O_FLUENT, O_MINOR = 450, 350, 650, 550, 900, 450, 350, 400
NO_FILE, PERSON, FILE_CHARS, MINOR_LANGS = 5000, 300, 15000, 4


@query(f"""WITH {b.ALN}, {b.DOC}, e AS (SELECT DISTINCT ep_id, drama FROM episode_result),
a AS (SELECT ep_id, drama, count(*) AS n, sum(length(coalesce(master_text, ''))) AS m, sum(length(coalesce(master_text, '')) + 3 + length(coalesce(context_text, ''))) AS mc FROM aln JOIN e USING (ep_id) GROUP BY 1, 2),
f AS (SELECT ep_id, max(least({FILE_CHARS}, length(text))) AS chars FROM doc WHERE source = 'srt_export' AND text IS NOT NULL AND ep_id IS NOT NULL GROUP BY 1),
k AS (SELECT a.*, greatest(1, (mc + n - 1) // 3) + {O_REFINE} AS t4, coalesce(greatest(1, chars // 3), {NO_FILE}) + {O_SCENES} AS t5, greatest(1, (m + n - 1) // 3) AS zh, (row_number() OVER (PARTITION BY drama ORDER BY ep_id) - 1) // 20 AS batch_no FROM a LEFT JOIN f USING (ep_id)),
b3 AS (SELECT drama, batch_no, greatest(1, (sum(m + n + length(ep_id) + 8) + count(*) - 1 - count(*)) // 3) + {O_MAP} AS t FROM k GROUP BY 1, 2),
s3 AS (SELECT drama, sum(t) AS t FROM b3 GROUP BY 1)
SELECT drama, CAST(count(*) AS BIGINT) AS n_eps, CAST(any_value(s3.t) + greatest(10, count(*) // 3) * {PERSON} + {O_REDUCE} AS BIGINT) AS stage_3, CAST(sum(t4) AS BIGINT) AS stage_4, CAST(sum(t4) // count(*) AS BIGINT) AS mean_4, CAST(max(t4) AS BIGINT) AS most_4, count_if(t4 > 50000) AS n_over,
  CAST(sum(t5) + sum(t5) // 3 + {O_RHYTHM} AS BIGINT) AS stage_5, CAST(sum(zh + {O_SKELETON} + zh * 9 // 10 + {O_FLUENT} + (zh + {O_MINOR}) * {MINOR_LANGS}) AS BIGINT) AS stage_6 FROM k JOIN s3 USING (drama) GROUP BY 1""")
def agg_13_stage_budgets(spark, sf):
    """Tokens of the four model stages of each drama: map and reduce over batches of 20 episodes, refinement, scenes, translation."""
    e = table(spark, sf, "episode_result").select("ep_id", "drama").distinct()
    m, c = F.length(F.coalesce("master_text", F.lit(""))), F.length(F.coalesce("context_text", F.lit("")))
    a = b.aligned(spark, sf).groupBy("ep_id").agg(F.count(F.lit(1)).alias("n"), F.sum(m).alias("m"), F.sum(m + 3 + c).alias("mc")).join(e, "ep_id")
    f = b.documents(spark, sf).filter("source = 'srt_export' and text is not null and ep_id is not null").groupBy("ep_id").agg(F.max(F.least(F.lit(FILE_CHARS), F.length("text"))).alias("chars"))
    tok = lambda x: F.greatest(F.lit(1), F.floor(x / 3).cast("bigint"))
    batch = F.floor((F.row_number().over(Window.partitionBy("drama").orderBy("ep_id")) - 1) / 20)  # one row an episode
    k = a.join(f, "ep_id", "left").select(
        "drama", "ep_id", "n", "m", (tok(F.col("mc") + F.col("n") - 1) + O_REFINE).alias("t4"), (F.coalesce(tok(F.col("chars")), F.lit(NO_FILE)) + O_SCENES).alias("t5"), tok(F.col("m") + F.col("n") - 1).alias("zh"), batch.alias("batch_no"),
    )
    # A batch's lines: one head an episode ("=== ", name, " ===") and its texts, joined by line breaks.
    b3 = k.groupBy("drama", "batch_no").agg((tok(F.sum(F.col("m") + F.col("n") + F.length("ep_id") + 8) - 1) + O_MAP).alias("t"))
    s3 = b3.groupBy("drama").agg(F.sum("t").alias("map_3"))
    out = k.groupBy("drama").agg(
        F.count(F.lit(1)).alias("n_eps"), F.sum("t4").alias("stage_4"), F.max("t4").alias("most_4"), F.count_if(F.col("t4") > 50_000).alias("n_over"), F.sum("t5").alias("map_5"),
        F.sum(F.col("zh") + O_SKELETON + F.floor(F.col("zh") * 9 / 10).cast("bigint") + O_FLUENT + (F.col("zh") + O_MINOR) * MINOR_LANGS).alias("stage_6"),
    ).join(s3, "drama")
    return out.select(
        "drama", "n_eps", (F.col("map_3") + F.greatest(F.lit(10), F.expr("n_eps div 3")) * PERSON + O_REDUCE).alias("stage_3"), "stage_4", F.expr("stage_4 div n_eps").alias("mean_4"), "most_4", "n_over",
        (F.col("map_5") + F.expr("map_5 div 3") + O_RHYTHM).alias("stage_5"), "stage_6",
    )


@query(f"""WITH {b.ASR}, {b.ALN}, {b.SEG}, e AS (SELECT drama, count(DISTINCT ep_id) AS n_total FROM episode_result GROUP BY 1), d AS (SELECT DISTINCT ep_id, drama FROM episode_result),
a AS (SELECT drama, count(DISTINCT ep_id) AS n_aligned FROM aln JOIN d USING (ep_id) GROUP BY 1), s AS (SELECT drama, count(DISTINCT ep_id) AS n_speech FROM asr JOIN d USING (ep_id) GROUP BY 1), g AS (SELECT drama, count(DISTINCT ep_id) AS n_refined FROM seg JOIN d USING (ep_id) GROUP BY 1),
c AS (SELECT drama, count(*) AS n_cast, count(canonical_en) AS n_terms FROM cast_member GROUP BY 1), p AS (SELECT drama, count(DISTINCT copy_id) AS n_copy FROM ad_copy GROUP BY 1)
SELECT drama, CASE WHEN coalesce(n_aligned, 0) = 0 THEN 1 WHEN coalesce(n_cast, 0) = 0 THEN 1 WHEN coalesce(n_refined, 0) < n_aligned THEN 3 WHEN coalesce(n_terms, 0) = 0 THEN 4 WHEN coalesce(n_speech, 0) < n_aligned THEN 5 WHEN coalesce(n_copy, 0) > 0 THEN 7 ELSE 6 END AS stage,
  CASE WHEN coalesce(n_aligned, 0) = 0 OR coalesce(n_cast, 0) = 0 THEN coalesce(n_speech, 0) WHEN coalesce(n_refined, 0) < n_aligned THEN coalesce(n_refined, 0) WHEN coalesce(n_terms, 0) = 0 THEN n_aligned WHEN coalesce(n_speech, 0) < n_aligned THEN n_speech ELSE n_aligned END AS n_done
FROM e LEFT JOIN a USING (drama) LEFT JOIN s USING (drama) LEFT JOIN g USING (drama) LEFT JOIN c USING (drama) LEFT JOIN p USING (drama)""")
def agg_14_stage_cascade(spark, sf):
    """The first stage whose records are not complete, from counts per drama; the tables stand for the stages' files."""
    d = table(spark, sf, "episode_result").select("ep_id", "drama").distinct()
    eps = lambda df, name: df.select("ep_id").distinct().join(d, "ep_id").groupBy("drama").agg(F.count(F.lit(1)).alias(name))
    x = d.select("drama").distinct()
    for df, name in ((b.aligned(spark, sf), "n_aligned"), (b.asr(spark, sf), "n_speech"), (b.segments(spark, sf), "n_refined")):
        x = x.join(eps(df, name), "drama", "left")
    x = x.join(table(spark, sf, "cast_member").groupBy("drama").agg(F.count(F.lit(1)).alias("n_cast"), F.count("canonical_en").alias("n_terms")), "drama", "left")
    x = x.join(b.ad_copy(spark, sf).groupBy("drama").agg(F.count(F.lit(1)).alias("n_copy")), "drama", "left").fillna(0)
    ladder = [("n_aligned = 0 or n_cast = 0", 1, "n_speech"), ("n_refined < n_aligned", 3, "n_refined"), ("n_terms = 0", 4, "n_aligned"), ("n_speech < n_aligned", 5, "n_speech"), ("n_copy > 0", 7, "n_aligned"), ("true", 6, "n_aligned")]
    case = lambda i: F.expr("CASE " + " ".join(f"WHEN {step[0]} THEN {step[i]}" for step in ladder) + " END")
    return x.select("drama", case(1).alias("stage"), case(2).alias("n_done"))


@query(f"""WITH {b.ASR} SELECT ep_id, id, array_to_string(list_transform(words, lambda w: coalesce(w.word, '') || '/' || CAST(coalesce(CAST(round(w.start_s * 1000) AS BIGINT), -1) AS VARCHAR)), ' ') AS kept FROM asr WHERE words IS NOT NULL AND len(words) > 0""")
def prj_02_compressed_fields(spark, sf):
    """Of the nested records only the fields needed later: a word and its start."""
    kept = F.transform("words", lambda w: F.struct(w["word"].alias("w"), F.round(w["start_s"] * 1000).cast("bigint").alias("s")))
    rows = b.asr(spark, sf).filter("size(words) > 0").select("ep_id", "id", kept.alias("x"))
    return rows.select("ep_id", "id", F.array_join(F.transform("x", lambda w: F.concat(F.coalesce(w["w"], F.lit("")), F.lit("/"), F.coalesce(w["s"], F.lit(-1)).cast("string"))), " ").alias("kept"))


@query("SELECT DISTINCT ep_id, lpad(regexp_extract(ep_id, 'ep(\\d+)$', 1), 6, '0') AS padded, coalesce(CAST(TRY_CAST(regexp_extract(ep_id, 'ep(\\d+)$', 1) AS BIGINT) AS VARCHAR), '000000') AS norm, ep_id AS other FROM episode_result")
def fn_21_episode_norm(spark, sf):
    padded = F.lpad(F.regexp_extract("ep_id", r"ep(\d+)$", 1), 6, "0")
    return table(spark, sf, "episode_result").select("ep_id").distinct().select("ep_id", padded.alias("padded"), F.when(F.regexp_extract("ep_id", r"ep(\d+)$", 1) == "", padded).otherwise(tx.episode_norm(padded)).alias("norm"), tx.episode_norm(F.col("ep_id")).alias("other"))


@query("WITH k AS (SELECT DISTINCT ep_id, drama FROM episode_result) SELECT ep_id, row_number() OVER (PARTITION BY drama ORDER BY ep_id) AS place FROM k")
def ord_06_plain_order(spark, sf):
    w = Window.partitionBy("drama").orderBy("ep_id")  # one row an episode
    return table(spark, sf, "episode_result").select("ep_id", "drama").distinct().select("ep_id", F.row_number().over(w).cast("bigint").alias("place"))


@query(f"WITH {b.ASR} SELECT ep_id, id, regexp_matches(text, '[\\x{{4E00}}-\\x{{9FFF}}]') AS any_han, regexp_matches(text, '{mq._WIDE}') AS any_wide, substr(text, 1, 140) AS head FROM asr WHERE text IS NOT NULL")
def fn_09_any_cjk(spark, sf):
    t = F.col("text")
    return b.asr(spark, sf).filter(t.isNotNull()).select("ep_id", "id", tx.has_cjk(t).alias("any_han"), tx.has_cjk(t, wide=True).alias("any_wide"), tx.cut_to_length(t).alias("head"))


@query("SELECT DISTINCT drama, canonical, replace(replace(replace(replace('<\"' || canonical || '\" & co>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS cell FROM cast_member")
def snk_08_escaped_cells(spark, sf):
    c = table(spark, sf, "cast_member").select("drama", "canonical").distinct()
    return c.select("drama", "canonical", tx.escape_markup(F.concat(F.lit('<"'), "canonical", F.lit('" & co>'))).alias("cell"))


@query()
def join_04_sparse_rescue(spark, sf):
    """The whole alignment with both rescues; episodes of under 30 sure segments are led by their blocks, which the tables hold."""
    sure = b.asr(spark, sf).filter(~F.coalesce("hallucination_risk", F.lit(False)))
    return tp.align_with_rescue(sure, b.blocks(spark, sf), min_speech=30)


@query()
def seq_14_extend_again(spark, sf):
    scenes = b.aligned(spark, sf).select("ep_id", F.col("idx").alias("pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    plans = b.segments(spark, sf).select("ep_id", F.col("id").alias("plan_id"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e"), F.lit("").alias("note"))
    return pl.extend_again(plans, scenes)
