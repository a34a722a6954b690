"""File sources: track documents (JSON), subtitle files, logs, directory listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.text import natural_key

WORD = "struct<word:string,start:double,end:double,probability:double,low_confidence:boolean>"
SPEECH_DOC = f"episode string, source string, model string, asr_language string, role string, segments array<struct<id:int,start:double,end:double,text:string,avg_probability:double,hallucination_risk:boolean,words:array<{WORD}>>>"
SCREEN_DOC = "episode string, mode string, blocks array<struct<start:double,end:double,combined_text:string,avg_confidence:double,frame_count:int>>, segments array<struct<id:int,start:double,end:double,raw_text:string,normalized_text:string,avg_confidence:double,frame_count:int>>"
ALIGNED_DOC = "segment_id string, start double, end double, master_text string, master_source string, master_confidence double, hallucination_risk boolean, context_text string, context_source string, context_available boolean"
VIDEO_TYPES = ("mp4", "mkv", "mov", "avi", "flv", "wmv", "ts", "m4v", "webm")


def list_files(spark: SparkSession, folder: str, types: tuple[str, ...] = VIDEO_TYPES, deep: bool = False) -> DataFrame:
    """Paths, sizes and times of the files of some types, with the episode id and its natural sort key. No content is read."""
    glob = "*.{" + ",".join(t for x in types for t in (x, x.upper())) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(deep).lower()).load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select("path", "length", "modificationTime", name.alias("ep_id"), natural_key(name).alias("sort_key"))


def list_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the folders right below ``folder`` that hold files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    base = folder.rstrip("/").split("/")[-1]
    return files.select(F.regexp_extract("path", rf"/{base}/([^/]+)/", 1).alias("name")).filter("name <> ''").distinct().orderBy("name")


def read_speech(spark: SparkSession, path: str) -> DataFrame:
    """Speech segments of JSON documents; unreadable documents and documents without segments give no rows."""
    docs = spark.read.schema(SPEECH_DOC).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    return docs.select(F.col("episode").alias("ep_id"), F.posexplode("segments").alias("pos", "x")).select("ep_id", "pos", "x.*")


def read_screen(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """Blocks (``same_lang``) or segments (``cross_lang``); a document of another mode is an error."""
    docs = spark.read.schema(SCREEN_DOC).option("multiLine", True).json(path)
    items = "blocks" if mode == "same_lang" else "segments"
    wrong = F.assert_true(F.coalesce(F.col("mode") == mode, F.lit(False)), F.concat(F.lit(f"a document is not of mode {mode}: "), F.coalesce("mode", F.lit("null"))))
    return docs.select(F.col("episode").alias("ep_id"), wrong.alias("__ok"), F.posexplode(items).alias("pos", "x")).filter("__ok is null").select("ep_id", "pos", "x.*")


def read_aligned(spark: SparkSession, path: str) -> DataFrame:
    """Aligned rows of files that hold a list or an object with ``segments``; corrupt files give no rows."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:_aligned)?\.json$", 1).alias("ep_id"), "value")
    item = f"array<struct<{ALIGNED_DOC.replace(', ', ',').replace(' ', ':')}>>"
    as_list = F.when(F.trim("value").startswith("["), F.from_json("value", item))
    as_object = F.when(F.trim("value").startswith("{"), F.from_json("value", f"struct<segments:{item}>")["segments"])
    return text.select("ep_id", F.posexplode(F.coalesce(as_list, as_object)).alias("pos", "x")).select("ep_id", "pos", "x.*")


def read_entity_batches(spark: SparkSession, path: str) -> DataFrame:
    """Entities of batch files (object of name -> entry); files that are no object are left out."""
    entry = "map<string,struct<canonical:string,aliases:array<string>,canonical_en:string,ocr_en_variants:array<string>>>"
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value").filter(F.trim("value").startswith("{"))
    rows = text.select(F.regexp_extract("file", r"(\d+)[^/]*$", 1).try_cast("int").alias("batch_index"), F.explode(F.from_json("value", entry)).alias("name", "x"))
    return rows.select("batch_index", F.coalesce("x.canonical", "name").alias("canonical"), F.coalesce("x.aliases", F.array().cast("array<string>")).alias("aliases"), "x.canonical_en", F.coalesce("x.ocr_en_variants", F.array().cast("array<string>")).alias("ocr_en_variants"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record a line; blank and corrupt lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_subtitles(spark: SparkSession, path: str) -> DataFrame:
    """Whole subtitle files as (ep_id, text)."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]+$", 1).alias("ep_id"), F.col("value").alias("text"))


def read_corpus(spark: SparkSession, path: str, form: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet, ORC, JSON lines or CSV with a header, by ``form``; only ``columns`` are read where the form allows."""
    reader = spark.read.option("header", True).option("inferSchema", True) if form == "csv" else spark.read
    df = reader.format(form).load(path)
    return df.select(*columns) if columns else df


def sample_per_group(df: DataFrame, group: str, key: str, size: int, seed: int = 7) -> DataFrame:
    """``size`` rows of each group by a seeded hash; each task sends at most ``size`` rows of a group."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= size).drop("__r")
