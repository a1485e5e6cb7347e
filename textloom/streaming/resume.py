"""Incremental runs: a stream over new chunk files, and ordered enrichment of a relation schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new(spark: SparkSession, chunks_path: str, schema: str, out: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]) -> None:
    """Process the files that no earlier call has seen, then stop; each batch is written once to its own folder."""
    chunks = spark.readStream.schema(schema).parquet(chunks_path)

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    chunks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def enrich(unknown: DataFrame, known: dict[str, str]) -> DataFrame:
    """Ordered enrichment over triples (doc_id, pos, s, p, o, definition) whose relation the schema lacks: the first one with
    a definition adds its relation (added), it and all later ones keep theirs, earlier ones lose it (p null).

    A relation's fate hangs on its own triples alone, so the walk through all of them is a minimum for each relation and a
    comparison with it; the rows of a hot relation combine before the shuffle.
    """
    at = F.struct("doc_id", "pos")
    firsts = unknown.where(F.col("definition").isNotNull() & ~F.col("p").isin(list(known))).groupBy("p").agg(F.min(at).alias("first"))
    told = unknown.join(firsts, "p", "left").withColumn("old", F.coalesce(F.col("p").isin(list(known)), F.lit(False)))
    added = F.coalesce(at == F.col("first"), F.lit(False))
    return told.select("doc_id", "pos", "s", F.when(F.col("old") | F.coalesce(at >= F.col("first"), F.lit(False)), F.col("p")).alias("p"), "o", added.alias("added"))
