"""Training samples for a retriever of relations: a sentence with one definition that fits and one that doesn't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.lineage import cut


def digest(seed: int, *parts: Column | str) -> Column:
    """Hex digits that stand for a seeded draw: the same on every run and machine."""
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts).cast("binary"))


def drawn(key: Column, among: Column) -> Column:
    """A number below `among` from a digest."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), among)


def numbered(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """Adds number, from 0 in order of the digest in `key` within `by`.

    Rows are ranked in 256 parts by the digest's first byte, which the parts' sizes then shift: a group as large as the
    table is never in one task.
    """
    parts = rows.withColumn("_part", F.substring(key, 1, 2))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    shift = sizes.select(*by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(key))
    return parts.withColumn("_rank", rank).join(shift, [*by, "_part"]).withColumn("number", F.col("_shift") + F.col("_rank") - 1).drop("_part", "_rank", "_shift")


def retriever_samples(rows: DataFrame, per_row: int = 2, size: int | None = None, seed: int = 0) -> DataFrame:
    """rows (row_id, sentence, triples: lists of strings, definitions: map of relation to definition), row_id unique.

    A relation is positive for a row that defines it and has a triple of three fields with it, whose subject and object
    occur in the sentence whatever the case. The first per_row positives, in order of their triples, are paired with
    as many other relations of the corpus, drawn by a digest, and one of the definitions given to those anywhere,
    repeats counted. A row with fewer negatives than positives has fewer samples. size: the first so many samples, by
    row_id and k. Null sentences, triples or definitions give none.

    The draw walks a ring of all relations from a place of the row's own: one more step than the row has positives
    meets a negative, so a row is joined to a handful of ring places by number and never to all relations.
    """
    low = F.lower("sentence")
    fits = lambda t: (F.size(t) == 3) & F.contains(low, F.lower(t[0])) & F.contains(low, F.lower(t[2])) & F.map_contains_key("definitions", t[1])
    whole = rows.where("sentence is not null and triples is not null and definitions is not null")
    whole = whole.withColumn("_good", F.filter("triples", lambda t: F.coalesce(fits(t), F.lit(False))))
    whole = whole.withColumn("_positives", F.array_distinct(F.transform("_good", lambda t: t[1])))

    given = rows.where("definitions is not null").select("row_id", F.explode("definitions").alias("relation", "definition"))
    given = given.select("relation", "definition", digest(seed, F.col("row_id").cast("string"), "relation").alias("_key"))
    texts = numbered(given, "_key", "relation").select("relation", "number", "definition")
    counts = given.groupBy("relation").agg(F.count("*").alias("n_definitions")).withColumn("_key", digest(seed, "relation"))
    ring = cut(numbered(counts, "_key").select("number", "relation", "n_definitions"))
    n = ring.count()

    narrow = whole.where(F.size("_positives") > 0).select("row_id", "_positives", drawn(digest(seed, F.col("row_id").cast("string")), F.lit(max(n, 1))).alias("_start"))
    steps = F.sequence(F.lit(0), F.least(F.lit(max(n, 1)), F.size("_positives") + per_row) - 1)
    walked = narrow.select("row_id", "_positives", "_start", F.explode(steps).alias("step")).withColumn("number", (F.col("_start") + F.col("step")) % max(n, 1))
    others = walked.join(ring, "number").where(~F.array_contains("_positives", F.col("relation")))
    k = F.row_number().over(Window.partitionBy("row_id").orderBy("step"))
    others = others.withColumn("k", k).where((F.col("k") <= per_row) & (F.col("k") <= F.size("_positives")))
    which = drawn(digest(seed, F.col("row_id").cast("string"), F.col("k").cast("string")), F.col("n_definitions"))
    chosen = others.select("row_id", "k", "relation", which.alias("number")).join(texts, ["relation", "number"])
    chosen = chosen.select("row_id", "k", F.col("relation").alias("negative_relation"), F.concat("relation", F.lit(": "), F.coalesce("definition", F.lit(""))).alias("negative"))

    both = whole.join(chosen, "row_id").withColumn("positive_relation", F.element_at("_positives", F.col("k")))
    mine = F.coalesce(F.element_at("definitions", F.col("positive_relation")), F.lit(""))
    out = both.select(
        "row_id", "k", "sentence", F.concat("positive_relation", F.lit(": "), mine).alias("positive"), "negative", "positive_relation", "negative_relation",
        F.filter("_good", lambda t: t[1] == F.col("positive_relation")).alias("positive_triples"),
    )
    return out if size is None else out.orderBy("row_id", "k").limit(size)


def split_shares(rows: DataFrame, id_col: str, shares: dict[str, float], seed: int = 0) -> DataFrame:
    """Adds split: names with the given shares (adding to one), by a digest of the id; no shuffle, the same on every run."""
    place = F.conv(F.substring(digest(seed, F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    names, edge, out = list(shares), 0.0, None
    for name in names[:-1]:
        edge += shares[name]
        out = F.when(place < edge, name) if out is None else out.when(place < edge, name)
    return rows.withColumn("split", F.lit(names[-1]) if out is None else out.otherwise(names[-1]))
