"""Review rounds, checkpoints, resumable chunks, judge metrics and lexical normalisation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.numbering import numbered


def accepted(verdicts: DataFrame) -> DataFrame:
    """Per record: accepted if every check passed, and the failed checks in order."""
    failed = F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("check"))))
    return verdicts.groupBy("record_id").agg(F.bool_and("passed").alias("accepted"), F.array_join(failed, ",").alias("failed_checks"))


def latest_checkpoint(saved: DataFrame) -> DataFrame:
    """The last saved row of each chunk; by key, as an aggregate that combines before the shuffle."""
    return saved.groupBy("source_path", "index").agg(F.max_by(F.struct("ord", "status"), "ord").alias("last")).select("source_path", "index", "last.ord", "last.status")


def illegal_replacements(saved: DataFrame) -> DataFrame:
    """Rows that follow one which isn't `model_failed`: a chunk may only be saved again after a failure."""
    before = F.lag("status").over(Window.partitionBy("source_path", "index").orderBy("ord"))
    return saved.withColumn("before", before).where("before is not null and before <> 'model_failed'").drop("before")


STATUSES = ("accepted", "dropped", "review_rejected", "model_failed")


def checkpoint_errors(saved: DataFrame) -> DataFrame:
    """source_path, index, ord, reason of saved rows (with source_sha256, start, end, status, text) that can't stand.

    A status that isn't known, a missing field, or a row after another of its chunk, unless that failed and both agree on
    the source and the offsets.
    """
    w = Window.partitionBy("source_path", "index").orderBy("ord")
    same = F.lit(True)
    for c in ("source_sha256", "start", "end"):
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    before = F.lag("status").over(w)
    missing = F.lit(False)
    for c in ("source_path", "source_sha256", "index", "start", "end", "text"):
        missing = missing | F.col(c).isNull()
    reason = F.when(missing, "field missing").when(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "status").when(before != "model_failed", "saved before").when(before.isNotNull() & ~same, "another source or offsets")
    return saved.select("source_path", "index", "ord", reason.alias("reason")).where("reason is not null")


def foreign_checkpoints(chunks: DataFrame, saved: DataFrame) -> DataFrame:
    """source_path, index, reason of saved chunks whose book is gone, that aren't chunks of it, or whose digest or offsets differ.

    chunks: source_path, index, source_sha256, start, end as they are now.
    """
    last = saved.groupBy("source_path", "index").agg(F.max_by(F.struct("source_sha256", "start", "end"), "ord").alias("last"))
    books = chunks.select("source_path").distinct().withColumn("there", F.lit(True))
    both = last.join(chunks.select("source_path", "index", F.struct("source_sha256", "start", "end").alias("now")), ["source_path", "index"], "left").join(books, "source_path", "left")
    reason = F.when(F.col("there").isNull(), "no such book").when(F.col("now").isNull(), "no such chunk").when(F.col("now") != F.col("last"), "changed")
    return both.select("source_path", "index", reason.alias("reason")).where("reason is not null")


def budgeted(pending_chunks: DataFrame, most: int) -> DataFrame:
    """The first `most` pending chunks by path and index (0: all): a run's budget."""
    return pending_chunks if not most else pending_chunks.orderBy("source_path", "index").limit(most)


def run_summary(chunks: DataFrame, saved: DataFrame) -> DataFrame:
    """One row: books, chunks, processed chunks (saved with any status), completed books, chunks by last status."""
    done = latest_checkpoint(saved)
    both = chunks.select("source_path", "index").join(done, ["source_path", "index"], "left")
    per = both.groupBy("source_path").agg(F.count("*").alias("n"), F.count("status").alias("done"), *(F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES))
    return per.agg(F.count("*").alias("books"), F.sum("n").alias("chunks"), F.sum("done").alias("processed"), F.count(F.when(F.col("n") == F.col("done"), 1)).alias("completed"), *(F.sum(s).alias(s) for s in STATUSES))


def pending(chunks: DataFrame, saved: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Chunks without a saved result (failed ones again on demand)."""
    done = latest_checkpoint(saved)
    done = done.where("status <> 'model_failed'") if retry_failed else done
    return chunks.join(done, ["source_path", "index"], "left_anti")


def publishable(chunks: DataFrame, saved: DataFrame) -> DataFrame:
    """Books all of whose chunks are saved."""
    done = latest_checkpoint(saved).select("source_path", "index", F.lit(1).alias("done"))
    per = chunks.select("source_path", "index").join(done, ["source_path", "index"], "left").groupBy("source_path").agg(F.count("*").alias("n_chunks"), F.count("done").alias("n_done"))
    return per.where("n_chunks = n_done")


def binary_metrics(truth: Column, guess: Column) -> list[Column]:
    """Accuracy, precision, recall and F1 as aggregates; undefined ratios are 0."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    tp, fp, fn = n(truth & guess), n(~truth & guess), n(truth & ~guess)
    div = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    return [F.round(F.avg((truth == guess).cast("double")), 6).alias("accuracy"), div(tp, tp + fp).alias("precision"), div(tp, tp + fn).alias("recall"), div(2.0 * tp, 2 * tp + fp + fn).alias("f1")]


def lexnorm_metrics(tokens: DataFrame) -> DataFrame:
    """tokens (batch, source, target, predicted): per batch, then the plain mean over batches, in per cent."""
    need, changed, right = F.col("source") != F.col("target"), F.col("predicted") != F.col("source"), F.col("predicted") == F.col("target")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    per = tokens.groupBy("batch").agg(div(n(need & right), n(need)).alias("r"), div(n(need & right), n(changed)).alias("p"), div(n(~need & right), n(~need)).alias("k"), F.avg(right.cast("double")).alias("a"))
    return per.agg(*(F.round(100 * F.avg(c), 4).alias(name) for c, name in (("r", "recall"), ("p", "precision"), ("k", "kept_recall"), ("a", "accuracy"))))


def run_labels(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Gaps and islands: each maximal run of equal values with its first place and length."""
    w = Window.partitionBy(by).orderBy(order)
    island = rows.withColumn("g", F.row_number().over(w) - F.row_number().over(Window.partitionBy(by, value).orderBy(order)))
    return island.groupBy(by, value, "g").agg(F.min(order).alias("first_at"), F.count("*").alias("run")).select(by, value, "first_at", F.least("run", F.lit(4)).alias("label"), "run")


def length_buckets(rows: DataFrame, id_col: str, length: Column, size: int) -> DataFrame:
    """Batches of rows of equal length, in order of id."""
    placed = numbered(rows.select(id_col, length.alias("sent_len")), id_col, "sent_len")
    return placed.select(id_col, "sent_len", F.floor(F.col("number") / size).cast("long").alias("batch"))


def multiset_difference(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """How many more of each key the left side has than the right."""
    both = left.select(*keys, F.lit(1).alias("n")).unionByName(right.select(*keys, F.lit(-1).alias("n")))
    return both.groupBy(*keys).agg(F.sum("n").alias("missing")).where("missing > 0")
