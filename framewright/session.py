"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(seconds: Column) -> Column:
    """Seconds with float dust as whole milliseconds; null stays null, NaN and infinities become null."""
    x = F.when(F.isnan(seconds) | (F.abs(seconds) > F.lit(9.0e12)), F.lit(None)).otherwise(seconds)
    return F.round(x * 1000).cast("bigint")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; a temporary folder only where none is set (local tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="framewright-checkpoint-")
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
