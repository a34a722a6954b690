"""Registered queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.language import label_documents, script_of_groups
from framewright.llm.lookalike import canonical_form, same_look_pairs
from framewright.llm.mixing import mix_plan, reached_shares, sample_mix
from framewright.llm.nearest import nearest_within
from framewright.llm.reading import DEMANDING, errors_by_source, fit_levels, grade_documents
from framewright.llm.runs import collapse_runs
from framewright.llm.tokens import encode_corpus, token_counts, vocabulary
from framewright.llm.truncation import find_truncated
from framewright.llm.turns import attributed, speaker_turns
from framewright.operators.dedup import one_per_key
from framewright.session import cut, ms, table

HOUR_MS = 3_600_000


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of equal-looking but different lines of an episode at most an hour apart."""
    rows = table(spark, sf_dir, "ocr_segment").withColumn("t_ms", ms(F.col("start_s")))
    return same_look_pairs(rows, "ep_id", "id", "t_ms", "raw_text", HOUR_MS)


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every on-screen record with both texts in the consistent form."""
    rows = table(spark, sf_dir, "ocr_segment").dropDuplicates(["ep_id", "id"])
    return rows.select("ep_id", "id", canonical_form(F.col("raw_text")).alias("raw_form"), canonical_form(F.col("normalized_text")).alias("normalized_form"))


def _transcripts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Speech segments with their drama, and the roster of each drama with every known form of a name."""
    dramas = table(spark, sf_dir, "episode_result").filter("ep_id is not null").groupBy("ep_id").agg(F.max("drama").alias("g"))
    seg = table(spark, sf_dir, "asr_segment").select("ep_id", "id", "text", F.col("hallucination_risk").alias("risky"), "words")
    seg = seg.join(dramas, "ep_id", "left").withColumnRenamed("ep_id", "ep")
    cast = table(spark, sf_dir, "cast_member")
    forms = F.concat(F.array("canonical", "canonical_en"), F.coalesce("aliases", F.array()), F.coalesce("ocr_en_variants", F.array()))
    return seg, cast.select(F.col("drama").alias("g"), "canonical", F.explode(forms).alias("variant"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker turns of every episode."""
    turns = speaker_turns(*_transcripts(spark, sf_dir))
    return turns.select(F.col("ep").alias("ep_id"), F.col("first_id").cast("int").alias("first_id"), F.col("last_id").cast("int").alias("last_id"), "speaker")


def p3_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of speech with its person and its cleaned words, in order of (ep_id, id, piece_no)."""
    return attributed(*_transcripts(spark, sf_dir)).select(F.col("ep").alias("ep_id"), "id", F.col("no").alias("piece_no"), "speaker", "words")


def _scored_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_truncated(table(spark, sf_dir, "ad_copy"), "copy_id", "copy_source", ["primary_text", "headline", "description"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of ad_copy that were cut short."""
    return _scored_copy(spark, sf_dir).filter("is_cut").select("copy_id", "field_name")


def p4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut values per source and field."""
    rated = _scored_copy(spark, sf_dir).groupBy("copy_source", "field_name")
    return rated.agg(F.count(F.lit(1)).alias("n_values"), F.count_if("is_cut").alias("n_cut"), F.avg(F.col("is_cut").cast("double")).alias("cut_rate"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of frames and of blocks that show one line."""
    frames = collapse_runs(table(spark, sf_dir, "ocr_frame"), "ep_id", "ordinal", "combined_text", score="avg_confidence")
    blocks = collapse_runs(table(spark, sf_dir, "ocr_block"), "ep_id", "block_no", "combined_text", weight="frame_count")
    tracks = [t.filter("n_records >= 2").select("ep_id", F.lit(name).alias("track"), "first_no", "last_no", F.col("n_weight").cast("int").alias("n_frames")) for t, name in ((frames, "frame"), (blocks, "block"))]
    return tracks[0].unionByName(tracks[1])


def p5_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of frames and of blocks, single records too, with its number of frames and duration in ms (a block run ends with its last block)."""
    frames = table(spark, sf_dir, "ocr_frame").withColumn("t_ms", ms(F.col("frame_time"))).withColumn("span", F.struct(F.col("t_ms").alias("s"), F.col("t_ms").alias("e")))
    blocks = table(spark, sf_dir, "ocr_block").withColumn("span", F.struct(ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e")))
    frames = collapse_runs(frames, "ep_id", "ordinal", "combined_text", score="avg_confidence", at="span")
    blocks = collapse_runs(blocks, "ep_id", "block_no", "combined_text", weight="frame_count", at="span")
    tracks = [t.select("ep_id", F.lit(name).alias("track"), "first_no", "last_no", F.col("n_weight").alias("n_frames"), F.col("first_at.s").alias("start_ms"), (F.col("last_at.e") - F.col("first_at.s")).alias("duration_ms")) for t, name in ((frames, "frame"), (blocks, "block"))]
    return tracks[0].unionByName(tracks[1])


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    return label_documents(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def _speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each speech record once, so that a late copy has no second vote."""
    return one_per_key(table(spark, sf_dir, "asr_segment").select("ep_id", "id", "text"), ["ep_id", "id"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong label, all paragraphs of mixed documents, episodes with a wrong script."""
    labelled, net = _labelled(spark, sf_dir)
    label = F.lower(F.trim(F.coalesce("label", F.lit(""))))
    wrong = F.when(F.col("para_no") == 0, ~F.col("mixed") & (label != F.col("found_lang"))).otherwise(F.lit(True))
    docs = labelled.filter(F.col("found_lang").isNotNull() & wrong)
    docs = docs.select(F.lit("document").alias("rec_kind"), F.col("doc_id").cast("string").alias("rec_id"), "para_no", "found_lang")

    scripts = script_of_groups(_speech(spark, sf_dir), "ep_id", "text", net)
    dominant = F.lower(F.trim(F.coalesce("dominant", F.lit(""))))
    episodes = table(spark, sf_dir, "episode_result").select("ep_id", "dominant").dropDuplicates(["ep_id"]).join(scripts, "ep_id")
    episodes = episodes.filter(dominant != F.col("script")).select(F.lit("episode").alias("rec_kind"), F.col("ep_id").alias("rec_id"), F.lit(0).alias("para_no"), F.col("script").alias("found_lang"))
    return docs.unionByName(episodes)


def p6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every document (para_no 0) and of every paragraph of a mixed one; script and confidence of every episode.

    An episode without letters in its speech has a null script and confidence 0.
    """
    labelled, net = _labelled(spark, sf_dir)
    docs = labelled.select(F.lit("document").alias("rec_kind"), "doc_id", F.lit(None).cast("string").alias("ep_id"), "para_no", "found_lang", "confidence", "mixed", "label")
    speech = _speech(spark, sf_dir)
    known = table(spark, sf_dir, "episode_result").groupBy("ep_id").agg(F.max("dominant").alias("label"))
    every = speech.select("ep_id").distinct().join(known, "ep_id", "full").filter("ep_id is not null")
    episodes = every.join(script_of_groups(speech, "ep_id", "text", net), "ep_id", "left").select(
        F.lit("episode").alias("rec_kind"), F.lit(None).cast(labelled.schema["doc_id"].dataType).alias("doc_id"), "ep_id", F.lit(0).alias("para_no"),
        F.col("script").alias("found_lang"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.lit(False).alias("mixed"), "label",
    )
    return docs.unionByName(episodes)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest block of each speech segment, middles at most 700 ms apart (times doubled to stay whole)."""

    def doubled(name: str, key: str) -> DataFrame:
        s, e = ms(F.col("start_s")), ms(F.col("end_s"))
        rows = table(spark, sf_dir, name).select(F.col("ep_id").alias("g"), F.col(key).alias("id"), s.alias("s"), e.alias("e"))
        return rows.filter("s is not null and e > s").groupBy("g", "id").agg(F.max(F.col("s") + F.col("e")).alias("t"))

    found = nearest_within(doubled("asr_segment", "id"), doubled("ocr_block", "block_no"), tolerance=1400, first_width=350)
    return found.select(F.col("g").alias("ep_id"), F.col("id").alias("asr_id"), F.col("match").alias("block_no"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens."""
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("byte_bpe_50k"))


def p8_stitched_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ids by chunks of 500 characters, which the documents reach: pre-tokenised apart, stitched, encoded in pieces."""
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("byte_bpe_50k"), chunk_chars=500, overlap=100)


def _mix(spark: SparkSession, sf_dir: str, nearest: bool = False) -> tuple[DataFrame, DataFrame]:
    counted = cut(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("byte_bpe_50k"), ["source"]))
    plan = mix_plan(counted, table(spark, sf_dir, "mix_target"), nearest=nearest)
    return sample_mix(counted, plan, "doc_id"), plan


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined records: one row a use of a document, with its text."""
    sampled, _ = _mix(spark, sf_dir)
    texts = one_per_key(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    uses = sampled.join(texts, "doc_id")
    return uses.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("use_no"), "text")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    return reached_shares(*_mix(spark, sf_dir))


def p9_nearest_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source at the largest total at which no source is clamped."""
    return reached_shares(*_mix(spark, sf_dir, nearest=True))


def _grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "reading_label").select("doc_id", F.col("reading_level").alias("grade"))


def _graded(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    return grade_documents(table(spark, sf_dir, "documents"), _grades(spark, sf_dir), "doc_id", "text", "lang", "source", "grade", every=every)[0]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents of demanding text."""
    return _graded(spark, sf_dir).filter(F.col("english") & (F.col("level") >= DEMANDING)).select("doc_id")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the levels of all documents spread in each source; only those without text have none."""
    g = _graded(spark, sf_dir, every=True).groupBy("source")
    return g.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("level").alias("mean_level"), *[F.count_if(F.round("level").cast("int") == k).alias(f"n_level_{k}") for k in (1, 2, 3)])


def p10_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded documents of each source, mean absolute error and share of right levels while that source was held out."""
    model = fit_levels(table(spark, sf_dir, "documents"), _grades(spark, sf_dir), "doc_id", "text", "source", "grade")
    return spark.createDataFrame(errors_by_source(model), "source string, n_graded int, mean_error double, share_right double")


P7_SQL = """
WITH a AS (SELECT DISTINCT ep_id, id, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e FROM asr_segment),
b AS (SELECT DISTINCT ep_id, block_no, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e FROM ocr_block),
near AS (
  SELECT a.ep_id, a.id AS asr_id, b.block_no,
         row_number() OVER (PARTITION BY a.ep_id, a.id ORDER BY abs((a.s + a.e) - (b.s + b.e)), b.block_no) AS r
  FROM a JOIN b ON a.ep_id = b.ep_id AND b.s + b.e BETWEEN a.s + a.e - 1400 AND a.s + a.e + 1400
  WHERE a.e > a.s AND b.e > b.s)
SELECT ep_id, asr_id, block_no FROM near WHERE r = 1
"""

QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms, "p3_found": p3_found, "p3_speech": p3_speech, "p4_found": p4_found, "p4_rates": p4_rates, "p5_found": p5_found, "p5_durations": p5_durations, "p6_found": p6_found, "p6_languages": p6_languages, "p7_found": p7_found, "p8_ids": p8_ids, "p8_stitched_ids": p8_stitched_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_nearest_shares": p9_nearest_shares, "p10_found": p10_found, "p10_profile": p10_profile, "p10_errors": p10_errors}
ORACLE_SQL = {"p7_found": P7_SQL}
