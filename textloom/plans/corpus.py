"""From records to a verified graph: cleanup, cutting, suggestions, correction or review, extraction's results, judgments."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import native, parsing
from textloom.functions.clean import clean_text_udf
from textloom.functions.segment import split_udf
from textloom.plans import agents, model_stage
from textloom.plans.lineage import cut
from textloom.plans.model_stage import asked

Backend = Callable[[str], str]
SUGGESTIONS = "array<struct<source:string,replacement:string,confidence:double>>"
EMPTY = "skipped_empty_after_cleanup"


def routed(agent_status: Column) -> Column:
    """ready, unless agents dropped or rejected the segment."""
    return F.when(agent_status.isin("dropped", "review_rejected", "model_failed"), F.concat(F.lit("skipped_"), agent_status)).otherwise("ready")


def corrected(segments: DataFrame, model: Backend, **options) -> DataFrame:
    """segments (text, suggestions) with the model's text where it is a safe correction, and correction_status accepted or rejected."""
    told = asked(segments, "correct", model, F.col("text"), F.col("suggestions"), **options)
    good = F.col("response").isNotNull() & parsing.safe_udf("text", F.trim(F.coalesce("response", F.lit(""))))
    told = cut(told.withColumn("good", good))
    return told.withColumn("text", F.when(F.col("good"), F.trim("response")).otherwise(F.col("text"))).withColumn("correction_status", F.when(F.col("good"), "accepted").otherwise("rejected")).drop("good", "response", "error")


def prepared(records: DataFrame, limit: int = 1800, suggest: Callable[[DataFrame], DataFrame] | None = None, correct: Backend | None = None, write: Backend | None = None, review: Backend | None = None, **options) -> DataFrame:
    """records (id, text, and where there are such source_id, source_line, raw_text, metadata), id unique -> a row a segment.

    Columns: id, source_id, source_line, part, metadata, raw_text, normalized_text, clean_text, suggestions,
    suggestion_status, correction_status, agent_status, agent_action, status. A record with nothing left after cleanup is
    one row, skipped. suggest: (id, text) -> (id, suggestions, suggestion_status). correct, or write and review (never
    both): models; a segment that agents drop or reject is skipped, not lost.
    """
    if correct and (write or review):
        raise ValueError("texts are corrected by one model or written and reviewed, not both")
    have = set(records.columns)
    rows = records.select(
        "id", "text", (F.coalesce("source_id", "id") if "source_id" in have else F.col("id")).alias("source_id"), (F.coalesce("source_line", F.lit(1)) if "source_line" in have else F.lit(1)).cast("int").alias("source_line"),
        (F.coalesce("raw_text", "text") if "raw_text" in have else F.col("text")).alias("raw_text"), (F.col("metadata") if "metadata" in have else F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    pieces = F.coalesce(split_udf(clean_text_udf("text"), F.lit(limit)), F.array().cast("array<string>"))
    cleaned = cut(rows.withColumn("pieces", pieces).drop("text").withColumnRenamed("id", "record"))
    parts = cleaned.select("*", F.posexplode("pieces").alias("k", "text")).withColumn("part", F.col("k") + 1)
    parts = parts.withColumn("id", native.part_id(F.col("record"), F.col("part"), F.size("pieces"))).withColumn("normalized_text", F.col("text")).drop("k", "pieces", "record")
    none = F.array().cast(SUGGESTIONS)
    if suggest is None:
        parts = parts.withColumn("suggestions", none).withColumn("suggestion_status", F.lit("not_requested"))
    else:
        parts = parts.join(suggest(parts.select("id", "text")), "id", "left").withColumn("suggestions", F.coalesce("suggestions", none)).withColumn("suggestion_status", F.coalesce("suggestion_status", F.lit("unchanged")))
    parts = corrected(parts, correct, **options) if correct else parts.withColumn("correction_status", F.lit("not_requested"))
    if write and review:
        told = agents.adaptive_rounds(parts.select(F.col("id").alias("record_id"), "text"), write, review)[0]
        told = told.select(F.col("record_id").alias("id"), F.col("status").alias("agent_status"), F.col("action").alias("agent_action"), F.col("text").alias("written"))
        parts = parts.join(told, "id").withColumn("text", F.when(F.col("agent_status") == "accepted", F.col("written")).otherwise(F.col("text"))).drop("written")
    else:
        parts = parts.withColumn("agent_status", F.lit("not_requested")).withColumn("agent_action", F.lit("none"))
    parts = parts.withColumn("status", routed(F.col("agent_status"))).withColumnRenamed("text", "clean_text")
    blank = cleaned.where(F.size("pieces") == 0).select(
        F.col("record").alias("id"), "source_id", "source_line", F.lit(None).cast("int").alias("part"), "metadata", "raw_text", F.lit(None).cast("string").alias("normalized_text"), F.lit("").alias("clean_text"),
        none.alias("suggestions"), F.lit(EMPTY).alias("suggestion_status"), *(F.lit(None).cast("string").alias(c) for c in ("correction_status", "agent_status", "agent_action")), F.lit(EMPTY).alias("status"),
    )
    return parts.unionByName(blank)


def model_inputs(segments: DataFrame) -> DataFrame:
    """(index, input_text) of the ready segments: their id, and their text on one line."""
    return segments.where("status = 'ready'").select(F.col("id").alias("index"), F.trim(F.translate("clean_text", "\n", " ")).alias("input_text"))


def mismatches(segments: DataFrame, stages: DataFrame) -> DataFrame:
    """id, reason where stage results (index, input_text) and ready segments don't belong together one to one."""
    wanted = model_inputs(segments).withColumnRenamed("input_text", "wanted")
    got = stages.groupBy("index").agg(F.count("*").alias("n"), F.min(F.trim("input_text")).alias("text"))
    both = wanted.join(got, "index", "full")
    reason = F.when(F.col("n").isNull(), "no result").when(F.col("wanted").isNull(), "no segment").when(F.col("n") > 1, "several results").when(F.col("wanted") != F.col("text"), "another text")
    return both.select(F.col("index").alias("id"), reason.alias("reason")).where("reason is not null")


def candidates(stages: DataFrame) -> DataFrame:
    """index, pos, s, p, o, error of canonical triples in order, each once; null triples are left out, blank cells an error."""
    rows = stages.select("index", F.posexplode("canonical").alias("pos", "t")).where("t is not null and t.p is not null")
    cells = rows.select("index", "pos", *(F.trim(f"t.{c}").alias(c) for c in "spo"))
    blank = F.lit(False)
    for c in "spo":
        blank = blank | (F.coalesce(F.col(c), F.lit("")) == "")
    first = cells.groupBy("index", "s", "p", "o").agg(F.min("pos").alias("pos"))
    return first.select("index", "pos", "s", "p", "o", F.when(blank, "blank cell").alias("error"))


def offline_judge(prompt: str) -> str:
    """YES where subject and object stand side by side in the text."""
    ask = json.loads(prompt)
    return "YES" if f"{ask['s']} {ask['o']}" in ask["text"] else "No."


def judged(segments: DataFrame, stages: DataFrame, judge: Backend = offline_judge, **options) -> DataFrame:
    """id, pos, s, p, o, label (YES, NO or UNSURE; a failed call is UNSURE), response, error. Raises where results and
    segments don't belong together."""
    wrong = mismatches(segments, stages).take(3)
    if wrong:
        raise ValueError("stage results and segments don't match: " + "; ".join(f"{r['id']}: {r['reason']}" for r in wrong))
    texts = segments.where("status = 'ready'").select(F.col("id").alias("index"), "clean_text")
    rows = cut(candidates(stages).join(texts, "index"))
    told = asked(rows.where("error is null").drop("error"), "judge", judge, F.col("clean_text").alias("text"), F.col("s"), F.col("p"), F.col("o"), **options)
    told = told.withColumn("label", native.strict_judgment(F.coalesce("response", F.lit(""))))
    names = ["index", "pos", "s", "p", "o", "label", "response", "error"]
    bad = rows.where("error is not null").withColumn("label", F.lit(None).cast("string")).withColumn("response", F.lit(None).cast("string"))
    return told.select(names).unionByName(bad.select(names)).withColumnRenamed("index", "id")


def graph(segments: DataFrame, judgments: DataFrame) -> DataFrame:
    """The ready segments with their judgments in order, whatever the label."""
    per = judgments.where("error is null").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "s", "p", "o", "label", "response"))).alias("judgments"))
    ready = segments.where("status = 'ready'").select("id", "source_id", "source_line", "metadata", "clean_text")
    none = F.array().cast("array<struct<pos:int,s:string,p:string,o:string,label:string,response:string>>")
    return ready.join(per, "id", "left").withColumn("judgments", F.coalesce("judgments", none))


def judged_prompts(prompts: DataFrame, model: Backend, chars: int = 100, **options) -> DataFrame:
    """prompts (prompt, ...) -> with generated, error and verdict: false where the answer's first characters deny, null where
    the call failed (the error is data, not an answer). Distinct prompts are called once, many at a time."""
    keyed = model_stage.with_prompt_id(prompts, "judge")
    told = cut(model_stage.call(keyed.select("prompt_id", "prompt").distinct(), model, **options)).select("prompt_id", F.col("response").alias("generated"), "error")
    return keyed.join(told, "prompt_id").drop("prompt_id").withColumn("verdict", F.when(F.col("error").isNull(), native.prefix_judgment(F.col("generated"), chars)))


def described(graphs: DataFrame, model: Backend, **options) -> DataFrame:
    """graphs (graph_id, triples) -> graph_id, description, error: a text for each graph."""
    return asked(graphs.select("graph_id", "triples"), "describe", model, F.col("triples"), **options).select("graph_id", F.col("response").alias("description"), "error")
