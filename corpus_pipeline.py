"""A corpus pipeline: each stage takes the documents its predecessor kept.

The last stage writes the token store and reports what its files hold; the others return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontamination, mixing, simhash, tokenstore, toxicity
from textloom.llm.common import checkpoint, fresh_dir, id_remainder, table


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns in one, so that none clashes with an operator's."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models don't predict as toxic. Learnt from the labels of ids whose crc32 mod 5 is not 0;
    without labels of both classes all stay. Null and empty texts are rated as such; each row by its own text.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(id_remainder(F.col("doc_id"), 5) != 0))
    return toxicity.rate(_packed(docs), model, ["row"]).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: the smallest doc_id (null after all others), then the smallest text key.

    Groups are told apart by their root, so unlike texts under one id all stay; of repeated rows one does. An empty or
    null text is in the group of texts without words.
    """
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("key_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key_text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *key)
    prints = checkpoint(simhash.fingerprints(rows, keep=["doc_id", "key_id", "key_text"]))
    found = prints.join(simhash.near_duplicates(prints).select("fingerprint", "root"), "fingerprint")
    stays = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "key_id", "key_text")).alias("first")).select("first.key_id", "first.key_text")
    kept = _packed(docs).select(*key, "row").join(stays, ["key_id", "key_text"])
    return kept.dropDuplicates(["key_id", "key_text"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under a twentieth of whose words stand in benchmark windows; null and empty texts stay, rows are judged singly."""
    found = decontamination.hits(_packed(docs), table(spark, sf_dir, "benchmark"), keep=["text", "row"])
    return decontamination.with_verdict(found).where("not contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the calibrated mix samples; repeated rows share one fate, null texts weigh nothing and stay."""
    return mixing.sample(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the store; a null text has the end id alone."""
    return tokenstore.read_index(spark, tokenstore.write(docs, fresh_dir(spark, "tokens")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: No SQL expresses the trained stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = fresh_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
