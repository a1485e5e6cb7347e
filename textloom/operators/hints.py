"""Hints for another round of extraction, and the choice of sentences that define relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.lineage import cut


def entity_hint(before: Column, found: Column) -> Column:
    """Both lists, each entity once, earlier ones first."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(before, none), F.coalesce(found, none)))


def relation_hints(rows: DataFrame, schema: DataFrame, run: DataFrame, seed: int = 0) -> DataFrame:
    """rows (doc_id, before, retrieved): relation names; schema (relation, definition); run (s, p, o): the run's triples.

    Per document a text: a numbered line per relation that the schema defines, previous ones first, with an example
    triple of the same run picked by a digest, where there is one.
    """
    pick = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), "s", "p", "o").cast("binary"))
    examples = run.groupBy(F.col("p").alias("relation")).agg(F.min(F.struct(pick.alias("k"), "s", "o")).alias("e"))
    known = schema.dropDuplicates(["relation"]).join(examples, "relation", "left")
    wanted = rows.select("doc_id", F.posexplode(entity_hint(F.col("before"), F.col("retrieved"))).alias("pos", "relation"))
    found = wanted.join(known, "relation")
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos"))
    example = F.when(F.col("e").isNotNull(), F.concat(F.lit(" Example: ["), F.concat_ws(", ", F.col("e.s"), F.col("relation"), F.col("e.o")), F.lit("]"))).otherwise("")
    lines = found.select("doc_id", n.alias("n"), F.concat(n.cast("string"), F.lit(". "), "relation", F.lit(": "), F.coalesce("definition", F.lit("")), example).alias("line"))
    # a document's hints are as few as the relations retrieved for it
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    return rows.select("doc_id").distinct().join(lines.groupBy("doc_id").agg(text.alias("hint")), "doc_id", "left").select("doc_id", F.coalesce("hint", F.lit("")).alias("hint"))


def first_sentences(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """rows (pos, relations): in order of pos, the rows none of whose relations an earlier chosen row holds.

    Rows without relations are not chosen. limit: rows are chosen until their relations number at least this. The choice in order equals rounds in which every
    row that comes first for all its relations is chosen and every row that shares a relation with it goes, so
    each round is a plan over all rows instead of a walk over them.
    """
    left = cut(rows.select("pos", F.explode(F.array_distinct("relations")).alias("relation")))
    chosen, rounds = None, 0
    while not left.isEmpty():
        firsts = left.groupBy("relation").agg(F.min("pos").alias("first"))
        marked = left.join(firsts, "relation")
        won = cut(marked.groupBy("pos").agg(F.min((F.col("pos") == F.col("first")).cast("int")).alias("all_first"), F.count("*").alias("n")).where("all_first = 1").select("pos", "n"))
        rounds += 1
        chosen = won if chosen is None else chosen.unionByName(won)
        chosen = cut(chosen) if rounds % 8 == 0 else chosen  # the plan stays short, however many rounds there are
        taken = left.join(won.select("pos"), "pos").select("relation").distinct()
        gone = left.join(taken, "relation", "left_semi").select("pos").distinct()
        left = cut(left.join(gone, "pos", "left_anti"))
    if chosen is None:
        return rows.limit(0)
    if limit is not None:
        # chosen rows are at most as many as relations
        before = F.coalesce(F.sum("n").over(Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        chosen = chosen.withColumn("_before", before).where(F.col("_before") < limit)
    return rows.join(chosen.select("pos"), "pos", "left_semi")
