"""Registered queries over documents and lines: subtitle sources, text functions, validation, with the equal SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import text as tx
from framewright.functions import timecode as tc
from framewright.operators import sequence as sq
from framewright.operators import subtitles as st
from framewright.operators.temporal import overlap_score
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


_BLOCKS = f"""WITH {b.DOC}, t AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '^\\x{{FEFF}}', '') AS t FROM doc WHERE text IS NOT NULL),
s AS (SELECT doc_id, trim(regexp_replace(regexp_replace(t, '^\\n+', ''), '\\n+$', ''), ' ') AS t FROM t),
l AS (SELECT doc_id, list_filter(string_split_regex(t, '\\n\\n+'), lambda x: x <> '') AS bs FROM s),
x AS (SELECT doc_id, unnest(bs) AS block, generate_subscripts(bs, 1) - 1 AS pos FROM l),
y AS (SELECT doc_id, pos, string_split(block, chr(10)) AS ls FROM x)"""
_MS = "((CAST(split_part({0}, ':', 1) AS BIGINT) * 60 + CAST(split_part({0}, ':', 2) AS BIGINT)) * 60 + CAST(substr(split_part({0}, ':', 3), 1, 2) AS BIGINT)) * 1000 + CAST(right({0}, 3) AS BIGINT)"
_STAMP = "(\\d{2,}:\\d{2}:\\d{2},\\d{3}) --> (\\d{2,}:\\d{2}:\\d{2},\\d{3})"


@query(f"""{_BLOCKS}, z AS (SELECT doc_id, pos, ls, regexp_extract(ls[2], '{_STAMP}', 1) AS a, regexp_extract(ls[2], '{_STAMP}', 2) AS e FROM y WHERE len(ls) >= 3 AND regexp_full_match(ls[2], '{_STAMP}'))
SELECT doc_id, CAST(pos AS INT) AS pos, {_MS.format('a')} AS start_ms, {_MS.format('e')} AS end_ms, array_to_string(ls[3:], chr(10)) AS text FROM z""")
def src_09_srt_blocks(spark, sf):
    return st.parse_blocks(b.documents(spark, sf), "doc_id", "text")


_SCAN = "(\\d{2,}:\\d{2}:\\d{2}[,.]\\d{3})\\s*-->\\s*(\\d{2,}:\\d{2}:\\d{2}[,.]\\d{3})"


@query(f"""WITH {b.DOC}, m AS (SELECT doc_id, regexp_extract_all(text, '{_SCAN}', 1) AS a, regexp_extract_all(text, '{_SCAN}', 2) AS e FROM doc WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(a) AS a, unnest(e) AS e, generate_subscripts(a, 1) - 1 AS pos FROM m)
SELECT doc_id, CAST(pos AS INT) AS pos, {_MS.format('a')} AS start_ms, {_MS.format('e')} AS end_ms FROM u""")
def src_10_srt_scan(spark, sf):
    return st.scan_stamps(b.documents(spark, sf), "doc_id", "text")


_LINES = f"""WITH {b.DOC}, l AS (SELECT doc_id, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS ls FROM doc WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(ls) AS line, CAST(generate_subscripts(ls, 1) - 1 AS INT) AS line_no FROM l)"""


@query(f"{_LINES} SELECT doc_id, line_no, trim(line, ' ') AS line FROM u WHERE NOT regexp_matches(line, '^\\s*$|^\\s*\\d+\\s*$|-->')")
def src_11_dialogue_lines(spark, sf):
    return st.dialogue_lines(b.documents(spark, sf), "doc_id", "text")


@query(f"WITH {b.DOC} SELECT doc_id, substr(text, 1, 800) AS head FROM doc WHERE text IS NOT NULL")
def src_12_text_head(spark, sf):
    return b.documents(spark, sf).filter("text is not null").select("doc_id", F.substring("text", 1, 800).alias("head"))


@query(f"""WITH {b.ASR}, {b.ALN} SELECT ep_id, idx AS no, master_text AS text, 'aligned' AS origin FROM aln
UNION ALL SELECT ep_id, id, text, 'speech' FROM asr WHERE ep_id NOT IN (SELECT ep_id FROM aln WHERE ep_id IS NOT NULL)""")
def src_13_fallback_source(spark, sf):
    first = b.aligned(spark, sf).select("ep_id", F.col("idx").alias("no"), F.col("master_text").alias("text"), F.lit("aligned").alias("origin"))
    rest = b.asr(spark, sf).join(first.select("ep_id").distinct(), "ep_id", "left_anti").select("ep_id", F.col("id").alias("no"), "text", F.lit("speech").alias("origin"))
    return first.unionByName(rest)


@query(f"""WITH {b.DOC}, t AS (SELECT doc_id, text, regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '^\\x{{FEFF}}', '') AS t FROM doc),
l AS (SELECT doc_id, text, list_filter(string_split_regex(trim(regexp_replace(regexp_replace(t, '^\\n+', ''), '\\n+$', ''), ' '), '\\n\\n+'), lambda x: x <> '') AS bs FROM t),
x AS (SELECT doc_id, unnest(bs) AS block, generate_subscripts(bs, 1) AS pos FROM l),
y AS (SELECT doc_id, pos, string_split(block, chr(10)) AS ls FROM x),
z AS (SELECT doc_id, pos, trim(ls[1], ' ') AS i, ls[2] AS s, ls[3:] AS body, regexp_extract(ls[2], '{_STAMP}', 1) AS a, regexp_extract(ls[2], '{_STAMP}', 2) AS e FROM y),
c AS (SELECT doc_id, pos, CASE WHEN NOT regexp_full_match(i, '\\d+') THEN 'index_not_digits' WHEN TRY_CAST(i AS BIGINT) IS NULL OR TRY_CAST(i AS BIGINT) <> pos THEN 'index_out_of_order' WHEN s IS NULL OR NOT contains(s, '-->') THEN 'no_timestamp'
  WHEN NOT regexp_full_match(s, '{_STAMP}\\s*') THEN 'bad_timestamp' WHEN a <> '' AND {_MS.format("nullif(e, '')")} <= {_MS.format("nullif(a, '')")} THEN 'end_not_after_start'
  WHEN len(list_filter(body, lambda q: trim(q, ' ') <> '')) = 0 THEN 'no_text' WHEN len(list_filter(body, lambda q: regexp_matches(q, '{_STAMP}'))) > 0 THEN 'stuck_block' END AS code FROM z),
f AS (SELECT doc_id, arg_min(code, pos) AS code FROM c WHERE code IS NOT NULL GROUP BY 1)
SELECT l.doc_id, CASE WHEN trim(coalesce(l.text, ''), ' ') = '' THEN 'document_empty' WHEN len(l.bs) = 0 THEN 'no_blocks' ELSE f.code END AS violation FROM l LEFT JOIN f ON l.doc_id = f.doc_id""")
def val_01_srt_validator(spark, sf):
    return b.documents(spark, sf).select("doc_id", st.violation(F.col("text")).alias("violation"))


_FMT = "printf('%02d:%02d:%02d{1}%03d', greatest({0}, 0) // 3600000, greatest({0}, 0) // 60000 % 60, greatest({0}, 0) // 1000 % 60, greatest({0}, 0) % 1000)"


@query(f"""WITH {b.ASR}, k AS (SELECT *, row_number() OVER (PARTITION BY ep_id ORDER BY id) AS no FROM asr WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL AND trim(coalesce(text, '')) <> '')
SELECT ep_id, no, printf('%d', no) || chr(10) || {_FMT.format('start_ms', ',')} || ' --> ' || {_FMT.format('end_ms', ',')} || chr(10) || text || chr(10) AS block FROM k""")
def snk_02_srt_render(spark, sf):
    ok = b.asr(spark, sf).filter(F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull() & (F.trim(F.coalesce("text", F.lit(""))) != ""))
    rows = sq.number_rows(ok, ["ep_id"], "id", "no")
    return rows.select("ep_id", "no", st.render(F.col("start_ms"), F.col("end_ms"), F.col("no"), F.col("text")).alias("block"))


@query(f"{_LINES} SELECT doc_id, count(*) AS n_lines FROM u WHERE NOT regexp_full_match(lower(trim(line, ' ')), '\\[corrupted[^\\]]*\\]') GROUP BY 1")
def flt_07_placeholder_lines(spark, sf):
    lines = b.documents(spark, sf).filter("text is not null").select("doc_id", F.explode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("line"))
    return lines.filter(~F.lower(F.trim("line")).rlike(r"^\[corrupted[^\]]*\]$")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"WITH {b.ASR}, {b.BLK} SELECT ep_id, id, {_FMT.format('start_ms', ',')} AS srt, {_FMT.format('start_ms', '.')} AS cut FROM asr WHERE start_ms IS NOT NULL")
def fn_02_time_formats(spark, sf):
    return b.asr(spark, sf).filter("start_ms is not null").select("ep_id", "id", tc.srt_time(F.col("start_ms")).alias("srt"), tc.cut_time(F.col("start_ms")).alias("cut"))


@query(f"WITH {b.ASR} SELECT ep_id, id, start_ms AS back_ms, CAST(0 AS BIGINT) AS broken_ms FROM asr WHERE start_ms IS NOT NULL")
def fn_03_time_parse(spark, sf):
    return b.asr(spark, sf).filter("start_ms is not null").select("ep_id", "id", tc.parse_time(tc.srt_time(F.col("start_ms"))).alias("back_ms"), tc.parse_time(F.lit("1:2"), 0).alias("broken_ms"))


@query(f"""WITH {b.SEG}, n AS (SELECT ep_id, id, start_ms, end_ms, lead(start_ms) OVER w AS s2, lead(end_ms) OVER w AS e2 FROM seg WINDOW w AS (PARTITION BY ep_id ORDER BY id))
SELECT ep_id, id, CASE WHEN least(end_ms - start_ms, e2 - s2) > 0 THEN round(greatest(0, least(end_ms, e2) - greatest(start_ms, s2)) / CAST(least(end_ms - start_ms, e2 - s2) AS DOUBLE), 4) ELSE 0.0 END AS score FROM n WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL AND s2 IS NOT NULL AND e2 IS NOT NULL""")
def fn_01_overlap_score(spark, sf):
    rows = sq.following(b.segments(spark, sf), ["ep_id"], "id", F.struct("start_ms", "end_ms"), "n").filter("start_ms is not null and end_ms is not null and n.start_ms is not null and n.end_ms is not null")
    shared = F.greatest(F.lit(0), F.least("end_ms", "n.end_ms") - F.greatest("start_ms", "n.start_ms"))
    return rows.select("ep_id", "id", overlap_score(shared, F.col("end_ms") - F.col("start_ms"), F.col("n.end_ms") - F.col("n.start_ms")).alias("score"))


_SPACE = "[\\s\\x{1c}-\\x{1f}\\x{85}\\pZ]"


@query(f"WITH {b.SEG} SELECT ep_id, id, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw_text, '<[^>]+>', '', 'g'), '[{tx.SIGNS}]', '', 'g'), '-{_SPACE}*\\n{_SPACE}*', '', 'g'), '{_SPACE}+', ' ', 'g'), ' ')) AS form FROM seg")
def fn_06_normalise_line(spark, sf):
    return b.segments(spark, sf).select("ep_id", "id", tx.normalise_line(F.col("raw_text")).alias("form"))


@query()
def fn_07_similarity(spark, sf):
    rows = sq.following(b.blocks(spark, sf), ["ep_id"], "block_no", F.col("combined_text"), "n").filter("n is not null")
    return rows.select("ep_id", "block_no", F.round(sq.similarity("combined_text", "n"), 6).alias("ratio"))


_WIDE = "[\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}\\x{F900}-\\x{FAFF}\\x{3000}-\\x{303F}\\x{FF00}-\\x{FFEF}]"


@query(f"""WITH {b.ASR}, x AS (SELECT ep_id, id, length(regexp_replace(text, '[ \\t\\r\\n]', '', 'g')) AS n, length(text) - length(regexp_replace(text, '{_WIDE}', '', 'g')) AS c, regexp_matches(text, '[\\x{{4E00}}-\\x{{9FFF}}]') AS any_han FROM asr WHERE text IS NOT NULL)
SELECT ep_id, id, round(CASE WHEN n > 0 THEN c / CAST(n AS DOUBLE) ELSE 0.0 END, 4) AS wide_ratio, any_han FROM x""")
def fn_08_script_ratio(spark, sf):
    return b.asr(spark, sf).filter("text is not null").select("ep_id", "id", F.round(tx.script_ratio(F.col("text")), 4).alias("wide_ratio"), F.col("text").rlike(tx.HAN).alias("any_han"))


@query(f"""WITH {b.ADS}, s AS (SELECT copy_id, primary_text AS t, string_split(primary_text, chr(10)) AS ls FROM ads WHERE primary_text IS NOT NULL)
SELECT copy_id, len(ls) <= 3 AND len(list_filter(ls, lambda x: length(x) > 40)) = 0 AND length(t) <= 140 AS fits, array_to_string(list_transform(ls[1:3], lambda x: substr(x, 1, 40)), chr(10)) AS cut FROM s""")
def fn_10_screen_limits(spark, sf):
    return b.ad_copy(spark, sf).filter("primary_text is not null").select("copy_id", tx.fits_screen(F.col("primary_text")).alias("fits"), tx.cut_to_screen(F.col("primary_text")).alias("cut"))


@query(f"""WITH {b.ADS} SELECT copy_id, rtrim(substr(trim(replace(primary_text, chr(10), ' '), ' '), 1, 125), ' ') AS primary_clean, rtrim(substr(trim(replace(headline, chr(10), ' '), ' '), 1, 27), ' ') AS headline_clean, rtrim(substr(trim(replace(description, chr(10), ' '), ' '), 1, 27), ' ') AS description_clean FROM ads""")
def fn_12_clean_fields(spark, sf):
    return b.ad_copy(spark, sf).select("copy_id", *[tx.clean_field(F.col(c), n).alias(a) for c, n, a in (("primary_text", 125, "primary_clean"), ("headline", 27, "headline_clean"), ("description", 27, "description_clean"))])


@query(f"WITH {b.ADS} SELECT copy_id, substr(trim(regexp_replace(headline, '[^\\pL\\pN _-]', '_', 'g'), ' '), 1, 35) AS file_name FROM ads WHERE headline IS NOT NULL")
def fn_13_file_name(spark, sf):
    return b.ad_copy(spark, sf).filter("headline is not null").select("copy_id", tx.file_name(F.col("headline")).alias("file_name"))


@query(f"WITH {b.ADS} SELECT copy_id, trim(headline, ' ') AS inner_text, '{{\"a\": [1,2]}}' AS fixed FROM ads WHERE headline IS NOT NULL")
def fn_14_fence_and_commas(spark, sf):
    fenced = F.concat(F.lit("```srt\n"), F.trim("headline"), F.lit("\n```"))
    return b.ad_copy(spark, sf).filter("headline is not null").select("copy_id", tx.strip_fence(fenced).alias("inner_text"), tx.drop_trailing_commas(F.lit('{"a": [1,2,],}')).alias("fixed"))


@query(f"WITH {b.DOC} SELECT doc_id, greatest(1, CAST(floor(length(text) / 3.0) AS INT)) AS tokens FROM doc WHERE text IS NOT NULL")
def fn_18_token_estimate(spark, sf):
    return b.documents(spark, sf).filter("text is not null").select("doc_id", tx.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT DISTINCT ep_id, regexp_extract(ep_id, 'ep(\\d+)$', 1) AS ep_no, coalesce(CAST(TRY_CAST(regexp_extract(ep_id, 'ep(\\d+)$', 1) AS INT) AS VARCHAR), ep_id) AS norm FROM episode_result")
def fn_19_episode_number(spark, sf):
    no = F.regexp_extract("ep_id", r"ep(\d+)$", 1)
    return table(spark, sf, "episode_result").select("ep_id").distinct().select("ep_id", no.alias("ep_no"), F.coalesce(no.try_cast("int").cast("string"), "ep_id").alias("norm"))


_SUSPENSE, _CLOSED_HAN, _CLOSED = tx.SUSPENSE, tx.CLOSED_HAN, tx.CLOSED


@query(f"WITH {b.ASR} SELECT ep_id, id, regexp_matches(text, '{_SUSPENSE}') AS suspense, CASE WHEN regexp_matches(text, '[\\x{{4E00}}-\\x{{9FFF}}]') THEN regexp_matches(text, '{_CLOSED_HAN}') ELSE regexp_matches(text, '{_CLOSED}') END AS declarative FROM asr WHERE text IS NOT NULL")
def fn_26_line_classes(spark, sf):
    t = F.col("text")
    return b.asr(spark, sf).filter(t.isNotNull()).select("ep_id", "id", tx.opens_tension(t).alias("suspense"), tx.closes_tension(t).alias("declarative"))


@query(f"WITH {b.DOC} SELECT doc_id, coalesce(MAP {{'en': 'English', 'zh': 'Chinese', 'es': 'Spanish', 'pt': 'Portuguese', 'fr': 'French', 'de': 'German'}}[lang], upper(lang)) AS language FROM doc WHERE lang IS NOT NULL")
def fn_27_language_names(spark, sf):
    names = F.create_map(*[F.lit(x) for kv in {"en": "English", "zh": "Chinese", "es": "Spanish", "pt": "Portuguese", "fr": "French", "de": "German"}.items() for x in kv])
    return b.documents(spark, sf).filter("lang is not null").select("doc_id", F.coalesce(F.try_element_at(names, F.col("lang")), F.upper("lang")).alias("language"))


@query(f"WITH {b.DOC}, s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS n FROM doc WHERE source IS NOT NULL GROUP BY 1) SELECT source, CASE WHEN n >= 1000000 THEN printf('%.1fM', n / 1000000.0) WHEN n >= 1000 THEN printf('%.1fK', n / 1000.0) ELSE CAST(n AS VARCHAR) END AS size FROM s")
def fn_24_human_sizes(spark, sf):
    return b.documents(spark, sf).filter("source is not null").groupBy("source").agg(F.sum("n_chars").alias("n")).select("source", tx.human_count(F.col("n")).alias("size"))


@query(f"""WITH {b.ASR}, e AS (SELECT DISTINCT ep_id, ocr_mode FROM episode_result), w AS (SELECT ep_id, sum(length(text) - length(regexp_replace(text, '{_WIDE}', '', 'g'))) AS c, sum(length(regexp_replace(text, '[ \\t\\r\\n]', '', 'g'))) AS n FROM asr GROUP BY 1)
SELECT e.ep_id, CASE WHEN e.ocr_mode IN ('cross_lang', 'both') THEN 'screen_' ELSE 'speech_' END || CASE WHEN w.c >= 0.3 * w.n THEN 'cjk' ELSE 'latin' END AS mode FROM e JOIN w ON e.ep_id = w.ep_id""")
def fn_28_mode_table(spark, sf):
    e = table(spark, sf, "episode_result").select("ep_id", "ocr_mode").distinct()
    w = b.asr(spark, sf).groupBy("ep_id").agg(F.sum(F.regexp_count("text", F.lit(tx.WIDE_RANGES))).alias("c"), F.sum(F.length(F.regexp_replace("text", r"[ \t\r\n]", ""))).alias("n"))
    return e.join(w, "ep_id").select("ep_id", F.concat(F.when(F.col("ocr_mode").isin("cross_lang", "both"), "screen_").otherwise("speech_"), F.when(F.col("c") >= 0.3 * F.col("n"), "cjk").otherwise("latin")).alias("mode"))


@query(f"""WITH {b.ASR}, x AS (SELECT ep_id, sum(length(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]', '', 'g'))) AS n, sum(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{_WIDE}', '', 'g'))) AS c FROM asr GROUP BY 1),
d AS (SELECT DISTINCT ep_id, drama FROM episode_result)
SELECT d.drama, CAST(sum(n) AS BIGINT) AS n_chars, CAST(sum(c) AS BIGINT) AS n_wide, CASE WHEN sum(c) >= 0.3 * sum(n) THEN 'cjk' ELSE 'latin' END AS dominant FROM x JOIN d ON x.ep_id = d.ep_id GROUP BY 1""")
def agg_07_script_micro_average(spark, sf):
    t = F.coalesce("text", F.lit(""))
    x = b.asr(spark, sf).groupBy("ep_id").agg(F.sum(F.length(F.regexp_replace(t, r"[ \t\r\n]", ""))).alias("n"), F.sum(F.regexp_count(t, F.lit(tx.WIDE_RANGES))).alias("c"))
    d = table(spark, sf, "episode_result").select("ep_id", "drama").distinct()
    out = x.join(d, "ep_id").groupBy("drama").agg(F.sum("n").alias("n_chars"), F.sum("c").cast("bigint").alias("n_wide"))
    return out.withColumn("dominant", F.when(F.col("n_wide") >= 0.3 * F.col("n_chars"), "cjk").otherwise("latin"))


@query(f"WITH {b.DOC} SELECT source, lang, count(*) AS n_docs, count_if(trim(coalesce(text, '')) = '') AS n_empty FROM doc GROUP BY CUBE (source, lang)")
def agg_10_coverage_cube(spark, sf):
    return b.documents(spark, sf).cube("source", "lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.trim(F.coalesce("text", F.lit(""))) == "").alias("n_empty"))


@query(f"WITH {b.DOC} SELECT source, CAST(sum(n_chars) AS BIGINT) AS n_chars, count(*) AS n_docs FROM doc GROUP BY ROLLUP (source)")
def agg_02_source_rollup(spark, sf):
    return b.documents(spark, sf).rollup("source").agg(F.sum("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n_docs"))


@query(f"WITH {b.DOC} SELECT lang, source, count(*) AS n_docs, CAST(sum(n_chars) FILTER (created_at >= TIMESTAMP '2024-01-01') AS BIGINT) AS recent_chars FROM doc GROUP BY GROUPING SETS ((lang), (source, lang))")
def agg_04_grouping_sets(spark, sf):
    b.documents(spark, sf).createOrReplaceTempView("fw_doc")
    return spark.sql("SELECT lang, source, count(*) AS n_docs, sum(n_chars) FILTER (WHERE created_at >= TIMESTAMP '2024-01-01') AS recent_chars FROM fw_doc GROUP BY GROUPING SETS ((lang), (source, lang))")


@query(f"WITH {b.DOC} SELECT source, count_if(lang = 'en') AS n_en, count_if(lang = 'zh') AS n_zh, count_if(lang NOT IN ('en', 'zh') OR lang IS NULL) AS n_other, CASE WHEN count_if(lang = 'en') = 0 THEN 'none' WHEN count_if(lang = 'en') > count_if(lang = 'zh') THEN 'en' ELSE 'zh' END AS lead FROM doc GROUP BY 1")
def agg_11_pivot_status(spark, sf):
    en, zh = F.count_if(F.col("lang") == "en"), F.count_if(F.col("lang") == "zh")
    out = b.documents(spark, sf).groupBy("source").agg(en.alias("n_en"), zh.alias("n_zh"), F.count_if(~F.col("lang").isin("en", "zh") | F.col("lang").isNull()).alias("n_other"))
    return out.withColumn("lead", F.when(F.col("n_en") == 0, "none").when(F.col("n_en") > F.col("n_zh"), "en").otherwise("zh"))


@query(f"WITH {b.DOC}, e AS (SELECT unnest(['en', 'zh', 'es', 'pt', 'fr', 'de', 'it', 'ja']) AS lang) SELECT e.lang, count(doc.doc_id) AS n_docs FROM e LEFT JOIN doc ON e.lang = doc.lang GROUP BY 1")
def agg_12_histogram_with_zeros(spark, sf):
    langs = spark.createDataFrame([(x,) for x in ("en", "zh", "es", "pt", "fr", "de", "it", "ja")], "lang string")
    counts = b.documents(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    return langs.join(counts, "lang", "left").fillna({"n_docs": 0})


@query(f"""WITH {b.DOC}, t AS (SELECT source, greatest(1, CAST(floor(length(coalesce(text, '')) / 3.0) AS INT)) AS k FROM doc)
SELECT source, CAST(sum(k) AS BIGINT) AS total, round(avg(k), 4) AS mean, max(k) AS most, CAST(ceil(count(*) / 20.0) AS BIGINT) AS batches, count_if(k > 500) AS n_over FROM t GROUP BY 1""")
def agg_13_token_budget(spark, sf):
    t = b.documents(spark, sf).select("source", tx.token_estimate(F.coalesce("text", F.lit(""))).alias("k"))
    return t.groupBy("source").agg(F.sum("k").alias("total"), F.round(F.avg("k"), 4).alias("mean"), F.max("k").alias("most"), F.ceil(F.count(F.lit(1)) / 20).cast("bigint").alias("batches"), F.count_if(F.col("k") > 500).alias("n_over"))


@query(f"WITH {b.ASR}, n AS (SELECT ep_id, CAST(id // 20 AS BIGINT) AS part, id, text FROM asr WHERE trim(coalesce(text, '')) <> '') SELECT ep_id, part, '=== ' || ep_id || ' ===' || chr(10) || string_agg(text, chr(10) ORDER BY id) AS body FROM n GROUP BY 1, 2")
def agg_17_ordered_text(spark, sf):
    rows = b.asr(spark, sf).filter(F.trim(F.coalesce("text", F.lit(""))) != "").withColumn("part", F.expr("cast(id div 20 as bigint)"))
    lines = rows.groupBy("ep_id", "part").agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("x"))
    return lines.select("ep_id", "part", F.concat(F.lit("=== "), "ep_id", F.lit(" ===\n"), F.array_join(F.transform("x", lambda x: x["text"]), "\n")).alias("body"))


@query("WITH k AS (SELECT DISTINCT ep_id FROM episode_result) SELECT ep_id, array_to_string(list_transform(regexp_extract_all(lower(ep_id), '\\d+|\\D+'), lambda x: CASE WHEN regexp_matches(x, '^\\d') THEN lpad(x, 12, '0') ELSE x END), '') AS sort_key FROM k")
def ord_01_natural_key(spark, sf):
    return table(spark, sf, "episode_result").select("ep_id").distinct().select("ep_id", tx.natural_key(F.col("ep_id")).alias("sort_key"))


@query(f"WITH {b.DOC} SELECT doc_id, n_chars FROM doc WHERE n_chars IS NOT NULL ORDER BY n_chars DESC, doc_id LIMIT 25")
def lim_01_top_documents(spark, sf):
    return b.documents(spark, sf).filter("n_chars is not null").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query(f"WITH {b.DOC}, r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS LAST, doc_id) AS rank_no FROM doc) SELECT source, doc_id, rank_no FROM r WHERE rank_no <= 3")
def lim_04_top_per_source(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(F.col("n_chars").desc_nulls_last(), "doc_id")
    # The limit is pushed below the shuffle (WindowGroupLimit), so a hot source sends three rows a task.
    return b.documents(spark, sf).withColumn("rank_no", F.row_number().over(w)).filter("rank_no <= 3").select("source", "doc_id", F.col("rank_no").cast("bigint").alias("rank_no"))


@query("SELECT DISTINCT drama, batch_index, canonical, array_to_string(aliases[1:2], '|') AS two FROM cast_member")
def lim_03_array_head(spark, sf):
    return table(spark, sf, "cast_member").select("drama", "batch_index", "canonical", F.array_join(F.slice("aliases", 1, 2), "|").alias("two")).distinct()


@query(f"WITH {b.DOC}, p AS (SELECT doc_id FROM doc WHERE text LIKE '%the wedding%'), q AS (SELECT doc_id FROM doc WHERE text LIKE '%banquet%') SELECT doc_id, 'both' AS side FROM (SELECT * FROM p INTERSECT SELECT * FROM q) UNION ALL SELECT doc_id, 'first' FROM (SELECT * FROM p EXCEPT SELECT * FROM q)")
def set_04_difference_and_common(spark, sf):
    d = b.documents(spark, sf)
    p, q = d.filter(F.col("text").contains("the wedding")).select("doc_id"), d.filter(F.col("text").contains("banquet")).select("doc_id")
    return p.intersect(q).withColumn("side", F.lit("both")).unionByName(p.subtract(q).withColumn("side", F.lit("first")))


@query(f"WITH {b.SEG}, {b.BLK}, s AS (SELECT DISTINCT ep_id FROM seg), k AS (SELECT DISTINCT ep_id FROM blk), e AS (SELECT DISTINCT ep_id FROM episode_result) SELECT e.ep_id, s.ep_id IS NOT NULL AS has_segments, k.ep_id IS NOT NULL AS has_blocks FROM e LEFT JOIN s ON e.ep_id = s.ep_id LEFT JOIN k ON e.ep_id = k.ep_id")
def set_07_partition_by_artefact(spark, sf):
    s = b.segments(spark, sf).select("ep_id").distinct().withColumn("has_segments", F.lit(True))
    k = b.blocks(spark, sf).select("ep_id").distinct().withColumn("has_blocks", F.lit(True))
    return table(spark, sf, "episode_result").select("ep_id").distinct().join(s, "ep_id", "left").join(k, "ep_id", "left").fillna(False)
