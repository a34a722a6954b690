"""Registered queries over people, ad copy and sets, with the equal SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import json_text as js
from framewright.operators import entities as en
from framewright.plans import base as b
from framewright.session import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_CAST = "c AS (SELECT DISTINCT drama, batch_index, canonical, aliases, nullif(canonical_en, '') AS canonical_en, ocr_en_variants FROM cast_member)"


@query("""SELECT DISTINCT drama, batch_index, canonical, array_to_string(list_sort(list_distinct(list_filter(coalesce(aliases, []), lambda x: x IS NOT NULL AND x <> '' AND x <> canonical))), '|') AS aliases, nullif(canonical_en, '') AS canonical_en FROM cast_member""")
def prj_04_normalise_entry(spark, sf):
    return en.normalise_entries(table(spark, sf, "cast_member")).select("drama", "batch_index", "canonical", F.array_join("aliases", "|").alias("aliases"), "canonical_en").distinct()


@query(f"""WITH {_CAST}, a AS (SELECT drama, canonical, string_agg(x, '|' ORDER BY x) AS aliases FROM (SELECT DISTINCT drama, canonical, unnest(aliases) AS x FROM c) q WHERE x <> canonical GROUP BY 1, 2),
v AS (SELECT drama, canonical, string_agg(x, '|' ORDER BY x) AS variants FROM (SELECT DISTINCT drama, canonical, unnest(ocr_en_variants) AS x FROM c) q GROUP BY 1, 2),
k AS (SELECT drama, canonical, arg_min(canonical_en, batch_index) FILTER (canonical_en IS NOT NULL) AS canonical_en FROM c GROUP BY 1, 2)
SELECT k.drama, k.canonical, coalesce(a.aliases, '') AS aliases, k.canonical_en, coalesce(v.variants, '') AS variants FROM k LEFT JOIN a ON k.drama = a.drama AND k.canonical = a.canonical LEFT JOIN v ON k.drama = v.drama AND k.canonical = v.canonical""")
def agg_01_alias_union(spark, sf):
    m = en.merge_entities(table(spark, sf, "cast_member"))
    return m.select("drama", "canonical", F.array_join("aliases", "|").alias("aliases"), "canonical_en", F.array_join("ocr_en_variants", "|").alias("variants"))


@query(f"""WITH {_CAST}, k AS (SELECT drama, canonical, arg_min(canonical_en, batch_index) FILTER (canonical_en IS NOT NULL) AS en FROM c GROUP BY 1, 2),
n AS (SELECT DISTINCT c.drama, unnest(list_append(c.aliases, c.canonical)) AS zh, k.en, c.canonical FROM c JOIN k ON c.drama = k.drama AND c.canonical = k.canonical WHERE k.en IS NOT NULL)
SELECT drama, zh, arg_max(en, canonical) AS en FROM n GROUP BY 1, 2""")
def join_13_name_map(spark, sf):
    m = en.merge_entities(table(spark, sf, "cast_member")).filter("canonical_en is not null")
    names = m.select("drama", "canonical", F.col("canonical_en").alias("en"), F.explode(F.concat("aliases", F.array("canonical"))).alias("zh"))
    return names.groupBy("drama", "zh").agg(F.max_by("en", "canonical").alias("en"))


@query(f"""WITH {_CAST}, o AS (SELECT drama, canonical AS term, canonical_en AS en, batch_index + 1 AS pri FROM c WHERE canonical_en IS NOT NULL UNION ALL SELECT drama, canonical, ocr_en_variants[1], 0 FROM c WHERE batch_index = 0 AND len(ocr_en_variants) > 0)
SELECT drama, term, arg_max(en, (pri, en)) AS en FROM o GROUP BY 1, 2""")
def join_14_overlay(spark, sf):
    c = table(spark, sf, "cast_member").distinct()
    over = c.filter(F.nullif("canonical_en", F.lit("")).isNotNull()).select("drama", F.col("canonical").alias("term"), F.col("canonical_en").alias("en"), (F.col("batch_index") + 1).alias("pri"))
    base = c.filter((F.col("batch_index") == 0) & (F.size("ocr_en_variants") > 0)).select("drama", F.col("canonical").alias("term"), F.get("ocr_en_variants", F.lit(0)).alias("en"), F.lit(0).alias("pri"))
    return en.overlay(over.unionByName(base), ["drama", "term"], "en", "pri")


@query(f"WITH {_CAST}, x AS (SELECT DISTINCT drama, unnest(aliases) AS alias, batch_index FROM c) SELECT DISTINCT drama, alias FROM x WHERE batch_index > 0 AND (drama, alias) NOT IN (SELECT (drama, alias) FROM x WHERE batch_index = 0)")
def join_15_new_keys(spark, sf):
    x = table(spark, sf, "cast_member").select("drama", "batch_index", F.explode("aliases").alias("alias"))
    return x.filter("batch_index > 0").select("drama", "alias").distinct().join(x.filter("batch_index = 0").select("drama", "alias"), ["drama", "alias"], "left_anti")


@query(f"""WITH {b.ADS}, d AS (SELECT DISTINCT drama FROM episode_result), k AS (SELECT drama, clip_id, arg_max(primary_text, copy_id) AS primary_text, arg_max(headline, copy_id) AS headline FROM (SELECT drama, clip_id, copy_id, coalesce(primary_text, '') AS primary_text, coalesce(headline, '') AS headline FROM ads) q GROUP BY 1, 2),
n AS (SELECT d.drama, k.clip_id, k.primary_text, k.headline FROM d LEFT JOIN k ON d.drama = k.drama) SELECT drama, clip_id, coalesce(primary_text, '') AS primary_text, coalesce(headline, '') AS headline FROM n""")
def join_10_last_copy_wins(spark, sf):
    d = table(spark, sf, "episode_result").select("drama").distinct()
    k = en.last_wins(b.ad_copy(spark, sf), ["drama", "clip_id"], "copy_id", ["primary_text", "headline"])
    return d.join(k, "drama", "left").select("drama", "clip_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("primary_text", "headline")])


@query(f"""WITH {b.SEG}, e AS (SELECT DISTINCT ep_id, ocr_mode FROM episode_result), s AS (SELECT DISTINCT ep_id FROM seg)
SELECT e.ep_id, CASE WHEN e.ocr_mode IN ('cross_lang', 'both') AND s.ep_id IS NULL THEN 'degraded' ELSE 'kept' END AS state FROM e LEFT JOIN s ON e.ep_id = s.ep_id""")
def join_16_orphans(spark, sf):
    e = table(spark, sf, "episode_result").select("ep_id", "ocr_mode").distinct()
    s = b.segments(spark, sf).select("ep_id").distinct().withColumn("there", F.lit(True))
    return e.join(s, "ep_id", "left").select("ep_id", F.when(F.col("ocr_mode").isin("cross_lang", "both") & F.col("there").isNull(), "degraded").otherwise("kept").alias("state"))


@query("""WITH e AS (SELECT DISTINCT ep_id, drama FROM episode_result), w AS (SELECT drama, unnest(['_ep1', '_ep01', '_ep001']) AS s, unnest([1, 2, 3]) AS pos FROM (SELECT DISTINCT drama FROM e) q), h AS (SELECT w.drama, w.pos, e.ep_id FROM w JOIN e ON e.ep_id = w.drama || w.s)
SELECT drama, arg_min(ep_id, pos) AS ep_id FROM h GROUP BY 1""")
def join_18_first_candidate(spark, sf):
    e = table(spark, sf, "episode_result").select("ep_id", "drama").distinct()
    cand = e.select("drama").distinct().select("drama", F.posexplode(F.array(*[F.concat("drama", F.lit(s)) for s in ("_ep1", "_ep01", "_ep001")])).alias("pos", "ep_id"))
    return cand.join(e.select("ep_id"), "ep_id").groupBy("drama").agg(F.min_by("ep_id", "pos").alias("ep_id"))


@query(f"WITH {b.ASR} SELECT ep_id, id FROM asr WHERE TRY_CAST(regexp_extract(ep_id, 'ep(\\d+)$', 1) AS INT) BETWEEN 1 AND 35")
def join_19_range_semi(spark, sf):
    wanted = spark.range(1, 36).withColumnRenamed("id", "no")
    rows = b.asr(spark, sf).withColumn("no", F.regexp_extract("ep_id", r"ep(\d+)$", 1).try_cast("bigint"))
    return rows.join(wanted, "no", "left_semi").select("ep_id", "id")


@query(f"WITH {b.ASR}, {b.ALN}, a AS (SELECT DISTINCT ep_id FROM asr WHERE hallucination_risk), l AS (SELECT DISTINCT ep_id FROM aln) SELECT e.ep_id, a.ep_id IS NULL AS missing FROM (SELECT DISTINCT ep_id FROM episode_result) e LEFT JOIN a ON e.ep_id = a.ep_id JOIN l ON e.ep_id = l.ep_id")
def flt_09_allow_list(spark, sf):
    risky = b.asr(spark, sf).filter("hallucination_risk").select("ep_id").distinct()
    e = table(spark, sf, "episode_result").select("ep_id").distinct().join(b.aligned(spark, sf).select("ep_id"), "ep_id", "left_semi")
    return e.join(risky, "ep_id", "left_semi").withColumn("missing", F.lit(False)).unionByName(e.join(risky, "ep_id", "left_anti").withColumn("missing", F.lit(True)))


@query(f"WITH {_CAST}, x AS (SELECT drama, canonical, list_sort(list_distinct(flatten(list(coalesce(aliases, []) ) FILTER (batch_index = 0)))) AS a0, list_sort(list_distinct(flatten(list(coalesce(aliases, [])) FILTER (batch_index = 1)))) AS a1 FROM c GROUP BY 1, 2) SELECT drama, canonical, a0 = a1 AS equal_sets, len(list_filter(a0, lambda q: NOT list_contains(a1, q))) = 0 AND len(a1) > len(a0) AS is_superset, len(list_filter(a1, lambda q: NOT list_contains(a0, q))) AS n_new FROM x WHERE a0 IS NOT NULL AND a1 IS NOT NULL")
def set_02_set_relations(spark, sf):
    c = table(spark, sf, "cast_member").distinct()
    part = lambda k: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("batch_index") == k, F.coalesce("aliases", F.array()))))))
    x = c.groupBy("drama", "canonical").agg(part(0).alias("a0"), part(1).alias("a1"), F.count_if(F.col("batch_index") == 0).alias("k0"), F.count_if(F.col("batch_index") == 1).alias("k1")).filter("k0 > 0 and k1 > 0")
    new = F.size(F.array_except("a1", "a0"))
    return x.select("drama", "canonical", (F.col("a0") == F.col("a1")).alias("equal_sets"), ((F.size(F.array_except("a0", "a1")) == 0) & (F.size("a1") > F.size("a0"))).alias("is_superset"), new.cast("bigint").alias("n_new"))


@query("SELECT ep_id, CASE WHEN dominant IS NULL OR dominant = '' THEN 0 ELSE coalesce(list_position(['unknown', 'latin', 'cjk'], dominant), 0) END >= 2 AS known FROM (SELECT DISTINCT ep_id, dominant FROM episode_result) q")
def flt_08_ordered_state(spark, sf):
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, ("unknown", "latin", "cjk"))), F.col("dominant")), F.lit(0))
    return table(spark, sf, "episode_result").select("ep_id", "dominant").distinct().select("ep_id", (rank >= 2).alias("known"))


@query("SELECT ep_id, array_to_string(list_filter(['frames_sampled', 'total_chars', 'cjk_ratio'], lambda k: (k = 'frames_sampled' AND frames_sampled IS NULL) OR (k = 'total_chars' AND total_chars IS NULL) OR (k = 'cjk_ratio' AND (cjk_ratio IS NULL OR isnan(cjk_ratio)))), ',') AS missing FROM (SELECT DISTINCT ep_id, frames_sampled, total_chars, cjk_ratio FROM episode_result) q")
def val_04_required_keys(spark, sf):
    have = F.map_filter(F.create_map(F.lit("frames_sampled"), F.col("frames_sampled").cast("double"), F.lit("total_chars"), F.col("total_chars").cast("double"), F.lit("cjk_ratio"), F.nanvl("cjk_ratio", F.lit(None).cast("double"))), lambda k, v: v.isNotNull())
    need = F.array(*map(F.lit, ("frames_sampled", "total_chars", "cjk_ratio")))
    return table(spark, sf, "episode_result").select("ep_id", "frames_sampled", "total_chars", "cjk_ratio").distinct().select("ep_id", F.array_join(F.array_except(need, F.map_keys(have)), ",").alias("missing"))


@query(f"WITH {b.ALN}, x AS (SELECT ep_id, arg_min(start_ms IS NOT NULL AND end_ms IS NOT NULL, idx) AS f, arg_max(start_ms IS NOT NULL AND end_ms IS NOT NULL, idx) AS l FROM aln GROUP BY 1) SELECT ep_id, f AND l AS fresh FROM x")
def val_05_first_and_last_timed(spark, sf):
    ok = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    return b.aligned(spark, sf).groupBy("ep_id").agg((F.min_by(ok, "idx") & F.max_by(ok, "idx")).alias("fresh"))


@query(f"WITH {b.DOC} SELECT doc_id FROM doc WHERE lang IS NULL OR lang = 'en'")
def val_06_fingerprint(spark, sf):
    return b.documents(spark, sf).filter(F.col("lang").isNull() | (F.col("lang") == "en")).select("doc_id")


@query(f"""WITH {b.SEG}, r AS (SELECT ep_id, id, normalized_text AS t, 1 AS rank_no FROM seg UNION ALL SELECT ep_id, id, raw_text, 2 FROM seg UNION ALL SELECT ep_id, id, '(none)', 3 FROM seg),
u AS (SELECT ep_id, id, arg_min(t, rank_no) AS text, min(rank_no) AS used FROM r WHERE trim(coalesce(t, ''), ' ') <> '' GROUP BY 1, 2)
SELECT u.*, CASE WHEN used = 1 THEN '' ELSE CASE WHEN seg.normalized_text IS NULL THEN 'first: missing' ELSE 'first: blank' END || CASE WHEN used = 3 THEN CASE WHEN seg.raw_text IS NULL THEN '; second: missing' ELSE '; second: blank' END ELSE '' END END AS failures FROM u JOIN seg USING (ep_id, id)""")
def val_07_fallback_chain(spark, sf):
    """First usable of both forms, else a stand-in, and a record of what failed before it."""
    usable = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    used = F.when(usable("normalized_text"), 1).when(usable("raw_text"), 2).otherwise(3)
    why = lambda c: F.when(F.col(c).isNull(), "missing").otherwise("blank")
    failures = F.when(used == 1, "").when(used == 2, F.concat(F.lit("first: "), why("normalized_text"))).otherwise(F.concat(F.lit("first: "), why("normalized_text"), F.lit("; second: "), why("raw_text")))
    return b.segments(spark, sf).select("ep_id", "id", F.when(used == 1, F.col("normalized_text")).when(used == 2, F.col("raw_text")).otherwise("(none)").alias("text"), used.alias("used"), failures.alias("failures"))


@query(f"WITH {b.ADS} SELECT copy_id, headline AS h, clip_id AS k FROM ads WHERE headline IS NOT NULL")
def fn_16_json_extraction(spark, sf):
    ads = b.ad_copy(spark, sf).filter("headline is not null")
    raw = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(F.col("headline").alias("h"), F.col("clip_id").alias("k"))), F.lit("\n```\nDone."))
    got = js.extract_object(raw)
    return ads.select("copy_id", F.get_json_object(got, "$.h").alias("h"), F.get_json_object(got, "$.k").cast("int").alias("k"))


@query(f"WITH {b.ADS} SELECT copy_id, 1 AS n_whole FROM ads WHERE headline IS NOT NULL")
def fn_17_truncated_json(spark, sf):
    ads = b.ad_copy(spark, sf).filter("headline is not null")
    one = F.to_json(F.struct(F.col("headline").alias("h")))
    cut = F.concat(F.lit('{"a":'), one, F.lit(',"b":{"h":"unfinis'))
    return ads.select("copy_id", F.size(F.json_object_keys(js.recover_object(cut))).alias("n_whole"))
