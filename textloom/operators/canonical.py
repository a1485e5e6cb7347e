"""Relations of triples replaced by those of a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.triples import split_known


def chosen(options: Column, response: Column) -> Column:
    """The option that the answer's first character names (A the first); null for any other answer, `None of the above` too."""
    place = F.ascii(F.substring(response, 1, 1)) - F.ascii(F.lit("A"))
    return F.when(place.between(0, F.size(options) - 1), F.get(options, place))


def canonicalised(triples: DataFrame, schema: DataFrame, answers: DataFrame) -> DataFrame:
    """triples (doc_id, pos, s, p, o); schema (relation); answers (doc_id, pos, options, response), one at most a triple.

    A relation of the schema stays (how `known`); another becomes the chosen option (`chosen`), or null (`unmatched`)
    where the answer names none or there is none. Only unknown relations meet the answers.
    """
    # a null relation is neither in the schema nor lost: it is unmatched
    known, unknown = split_known(triples.select("doc_id", "pos", "s", "p", "o"), schema)
    told = unknown.join(answers.select("doc_id", "pos", "options", "response"), ["doc_id", "pos"], "left").withColumn("p", chosen(F.col("options"), F.col("response")))
    told = told.withColumn("how", F.when(F.col("p").isNull(), "unmatched").otherwise("chosen"))
    return known.withColumn("how", F.lit("known")).unionByName(told.drop("options", "response"))
