"""Triples: extraction by co-occurrence, deduplication, scoring, judging, sampling. Keys, never positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.native import CAPITALISED, spans, triple_question

KEY = ("graph_id", "s", "p", "o")


def adjacent_name_triples(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, s, p, o) of neighbouring capitalised words: a deterministic stand-in for an extraction model."""
    words = docs.select("doc_id", "lang", "text", spans(F.col("text"), CAPITALISED).alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.struct(a.alias("s"), F.lit("followed_by").alias("p"), b.alias("o")))
    return words.select("doc_id", "lang", "text", F.posexplode(pairs).alias("pos", "t")).select("doc_id", "lang", "text", "pos", "t.s", "t.p", "t.o")


def grounded_name_triples(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, pos, s, p, o, label) of neighbouring capitalised words; the text is looked into where it is, not copied
    to every triple."""
    words = docs.select("doc_id", "lang", "text", spans(F.col("text"), CAPITALISED).alias("w"))
    after = F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0)))
    held = lambda a, b: F.contains(F.col("text"), a) & F.contains(F.col("text"), b)
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), after, lambda a, b: F.struct(a.alias("s"), F.lit("followed_by").alias("p"), b.alias("o"), F.when(held(a, b), "YES").otherwise("NO").alias("label")))
    return words.select("doc_id", "lang", F.posexplode(pairs).alias("pos", "t")).select("doc_id", "lang", "pos", "t.s", "t.p", "t.o", "t.label")


def distinct_in_order(triples: DataFrame, *group: str) -> DataFrame:
    """One row per triple and group, with the place of its first occurrence."""
    return triples.groupBy(*group, "s", "p", "o").agg(F.min("pos").alias("pos"))


def grounded(triples: DataFrame) -> DataFrame:
    """label: YES if both ends occur in the text, else NO."""
    return triples.withColumn("label", F.when(F.contains("text", F.col("s")) & F.contains("text", F.col("o")), "YES").otherwise("NO"))


def normalised(triples: DataFrame) -> DataFrame:
    return triples.withColumns({c: F.lower(F.trim(F.col(c))) for c in ("s", "p", "o")})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def micro_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Precision, recall and F1 over distinct triples of all graphs; one aggregation over both sides, no join."""
    sides = normalised(gold).select(*KEY, F.lit(1).alias("g"), F.lit(0).alias("h")).unionByName(normalised(predicted).select(*KEY, F.lit(0).alias("g"), F.lit(1).alias("h")))
    per = sides.groupBy(*KEY).agg(F.max("g").alias("g"), F.max("h").alias("h"))
    total = per.agg(F.coalesce(F.sum(F.col("g") * F.col("h")), F.lit(0)).alias("tp"), F.coalesce(F.sum("g"), F.lit(0)).alias("n_gold"), F.coalesce(F.sum("h"), F.lit(0)).alias("n_pred"))
    return total.select("tp", "n_gold", "n_pred", F.round(_ratio(F.col("tp"), F.col("n_pred")), 6).alias("precision"), F.round(_ratio(F.col("tp"), F.col("n_gold")), 6).alias("recall"), F.round(_ratio(2.0 * F.col("tp"), F.col("n_gold") + F.col("n_pred")), 6).alias("f1"))


def macro_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Means over triple classes (the union of both sides) of per-class precision, recall and F1."""
    sides = gold.select(*KEY, F.lit(1).alias("g"), F.lit(0).alias("h")).unionByName(predicted.select(*KEY, F.lit(0).alias("g"), F.lit(1).alias("h")))
    per = sides.groupBy(*KEY).agg(F.max("g").alias("g"), F.max("h").alias("h"))
    by_class = per.groupBy("s", "p", "o").agg(F.sum(F.col("g") * F.col("h")).alias("tp"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    precision, recall, f1 = _ratio(F.col("tp"), F.col("h")), _ratio(F.col("tp"), F.col("g")), _ratio(2.0 * F.col("tp"), F.col("g") + F.col("h"))
    return by_class.agg(F.round(F.avg(precision), 6).alias("precision"), F.round(F.avg(recall), 6).alias("recall"), F.round(F.avg(f1), 6).alias("f1"), F.count("*").alias("classes"))


def match_accuracy(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Share of predictions, repeats counted, that are gold in their graph; null without predictions."""
    known = normalised(gold).select(*KEY).distinct().withColumn("hit", F.lit(1))
    return normalised(predicted).join(known, list(KEY), "left").agg(F.round(F.avg(F.coalesce("hit", F.lit(0)).cast("double")), 6).alias("accuracy"), F.count("*").alias("n_pred"))


def retention(before: DataFrame, after: DataFrame, fallback: str = "none") -> DataFrame:
    """Triples before and after a filter, and what share stays, per graph. After it, a triple of three fallback cells, which
    stands for a graph that couldn't be read, isn't counted; before it, it is."""
    unread = F.lit(True)
    for c in ("s", "p", "o"):
        unread = unread & (F.lower(F.trim(c)) == fallback)
    after = after.where(~F.coalesce(unread, F.lit(False)))
    both = before.select("graph_id", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select("graph_id", F.lit(0).alias("b"), F.lit(1).alias("a")))
    return both.groupBy("graph_id").agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after")).withColumn("retained_pct", F.round(100.0 * F.col("n_after") / F.col("n_before"), 4))


def judge_filter(triples: DataFrame, predictions: DataFrame, keep_if_none: bool = False) -> DataFrame:
    """Triples (graph_id, pos, ...) whose prediction (graph_id, pos, verdict) is true; one without a prediction goes.

    keep_if_none: a graph that would lose all its triples keeps them.
    """
    joined = triples.join(predictions, ["graph_id", "pos"], "left").withColumn("ok", F.coalesce("verdict", F.lit(False)))
    if keep_if_none:
        joined = joined.withColumn("ok", F.col("ok") | ~F.max("ok").over(Window.partitionBy("graph_id")))
    return joined.where("ok").drop("ok", "verdict")


def negative_tails(triples: DataFrame) -> DataFrame:
    """Each triple with the nearest different tail after its own in its document (the smallest if there is none)."""
    tails = triples.select("graph_id", F.col("o").alias("tail")).distinct()
    by_tail = Window.partitionBy("graph_id").orderBy("tail")
    nearest = tails.select("graph_id", F.col("tail").alias("o"), F.lead("tail").over(by_tail).alias("up"), F.first("tail").over(by_tail).alias("low"))
    chosen = F.coalesce("up", F.when(F.col("low") != F.col("o"), F.col("low")))
    return triples.join(nearest, ["graph_id", "o"]).select("graph_id", "pos", "s", "p", "o", chosen.alias("negative_tail"))


def split_known(triples: DataFrame, schema: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(triples whose relation is in the schema, the others): only the others need a model."""
    keys = schema.select(F.col("relation").alias("p")).distinct()
    return triples.join(keys, "p", "left_semi"), triples.join(keys, "p", "left_anti")


#: Queries of a block, and vectors of a tile.
QUERY_BLOCK, TILE = 2048, 8192
NEAR = "query_id long, vec_id long, score double"


def top_k(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k vectors of largest inner product for each query (query_id, embedding), ties by id.

    Queries are packed into blocks, vectors where they lie into tiles; blocks go to every group of tiles, so a task
    multiplies one block with one tile at a time and keeps k vectors for each query and block it has open. Neither side
    passes through the driver, and no pair is made a row that isn't among a task's k best. Vectors that fit one tile go
    to every block instead.
    """
    spark = queries.sparkSession
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = queries.where("embedding is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = max(1, -(-some.count() // QUERY_BLOCK))
    packed = some.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("query_id", "embedding")).alias("q"))  # about QUERY_BLOCK each
    sent = packed.select("block", F.transform("q", lambda x: x["query_id"]).alias("names"), F.flatten(F.transform("q", lambda x: x["embedding"])).alias("wanted"))
    held = vectors.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    few = len(held.limit(TILE + 1).select("vec_id").take(TILE + 1)) <= TILE

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                part, turn = batch.slice(i, TILE), turn + 1
                column = part.column("embedding")
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (part.column("vec_id"), column.flatten())]
                yield pa.RecordBatch.from_arrays([pa.array([turn % groups], pa.int32()), *lists], ["group", "ids", "held"])

    cut_up = held.mapInArrow(tiles, "group int, ids array<long>, held array<double>")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def out(block: int) -> pa.RecordBatch:
            names, score, ids = open_blocks.pop(block)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(names, score.shape[1])), pa.array(ids.ravel()), pa.array(score.ravel())], ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                block, (names, wanted, ids, held) = batch.column("block")[i].as_py(), (batch.column(c)[i].values.to_numpy() for c in ("names", "wanted", "ids", "held"))
                score = np.round(wanted.reshape(len(names), -1) @ held.reshape(len(ids), -1).T, 6)
                ids = np.broadcast_to(ids, score.shape)
                if block in open_blocks:
                    _, before, their = open_blocks[block]
                    score, ids = np.concatenate([before, score], axis=1), np.concatenate([their, ids], axis=1)
                order = np.lexsort((ids, -score), axis=1)[:, :k]
                open_blocks[block] = (names, np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1))
                if len(open_blocks) > 64:
                    yield out(next(iter(open_blocks)))
        for block in list(open_blocks):
            yield out(block)

    to_each = sent.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = sent.crossJoin(F.broadcast(cut_up)) if few else to_each.join(cut_up, "group")  # TILE vectors at most
    found = met.select("block", "names", "wanted", "ids", "held").mapInArrow(best, NEAR)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def labelled_questions(triples: DataFrame) -> DataFrame:
    """instruction, output, label for each triple (graph_id, pos, s, p, o): itself, true, and with another tail of its graph, false."""
    both = negative_tails(triples)
    yes = both.select("graph_id", "pos", triple_question(F.col("s"), F.col("p"), F.col("o")).alias("instruction"), F.lit("Yes, this is true.").alias("output"), F.lit(True).alias("label"))
    no = both.where("negative_tail is not null").select("graph_id", "pos", triple_question(F.col("s"), F.col("p"), F.col("negative_tail")).alias("instruction"), F.lit("No, this is not true.").alias("output"), F.lit(False).alias("label"))
    return yes.unionByName(no)


def found_or_missing(words: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """words (word) joined with the dictionary (word, ...), and the distinct words that it lacks, for a model to answer."""
    return words.join(dictionary, "word"), words.select("word").distinct().join(dictionary, "word", "left_anti")
