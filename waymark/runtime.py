"""Lineage cuts and folders in the session's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


CLEANED = "spark.cleaner.referenceTracking.cleanCheckpoints"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the session names; where none is named a local one is made in local mode only (tests), as executors of a
    cluster would not share it. Unless the session says otherwise, files of a checkpoint go when nothing refers to it any more."""
    sc = spark.sparkContext
    conf = sc._jsc.sc().conf()
    if not conf.contains(CLEANED):
        conf.set(CLEANED, "true")
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="waymark-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """The name of a folder in there that nobody else has."""
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
