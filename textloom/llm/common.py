"""Shared plumbing: sessions, folders, row keys, bounded samples."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where none is set (tests)."""
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf)
        return conf
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through files that every executor can read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def estimated_bytes(df: DataFrame, default: int) -> int:
    """Optimizer's size estimate, or default where it knows none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 55 else default


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key_id, key_text): the key tells rows apart that share an id, and equals for repeated rows."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("key_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key_text"),
    )


def bounded_sample(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About bound rows (all, if there are fewer), chosen by a hash of the id.

    The rows are counted without their texts, then a hash threshold keeps bound of them in expectation.
    """
    total = rows.count()
    if total <= bound:
        return rows
    share = bound / total
    return rows.where(F.pmod(F.xxhash64(F.lit(17), F.col(id_col)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
