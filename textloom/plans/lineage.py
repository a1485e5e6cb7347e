"""Cutting lineage through files that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared(df: DataFrame) -> str:
    """The folder named in spark.checkpoint.dir; where none is set, a folder of our own on a local master only."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir") or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df from the shared folder."""
    shared(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder: compressed, and read by the columns that are asked for."""
    path = f"{shared(df).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
