"""Generation and review in rounds: a round is one batch stage over all open records, not a loop per record.

Prompts are JSON texts; `generate`, `review` and `derive` are callables from prompt to answer (see `model_stage.call`).
Every round's calls are written to the checkpoint folder before anything reads them, so a lost executor repeats a
task's calls and never a finished stage's. A bad answer ends its record as `model_failed` with the reason.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import parsing, segment
from textloom.functions.native import MATH, spans
from textloom.plans import model_stage
from textloom.plans.lineage import cut

Backend = Callable[[str], str]

# The protocol's rules shown at once, its depth of splitting and the smallest limit of a part.
SHOWN_RULES, SPLIT_DEPTH, LEAST_PART = 12, 3, 100

RESULT = ["record_id", "status", "action", "text", "attempts", "error"]
FAILED = "array<struct<check:string,feedback:string>>"


def lost_formulas(source: Column, text: Column) -> Column:
    """Formulas that the source holds more often than the text, each once, in order."""
    old, new = spans(source, MATH), spans(text, MATH)
    n = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.filter(F.array_distinct(old), lambda x: n(old, x) > n(new, x))


def _reviewed(made: DataFrame, review: Backend) -> DataFrame:
    """record_id, failed (checks that failed with feedback, by name), review_error."""
    each = made.select("record_id", "source", "c").withColumn("check", F.explode(F.array(*[F.lit(c) for c in parsing.CHECKS])))
    asked = model_stage.asked(each, "review", review, F.col("check"), F.col("source"), F.col("c.action").alias("action"), F.col("c.text").alias("text"))
    read = asked.withColumn("v", parsing.verdict_udf("response"))
    wrong = F.coalesce("error", "v.error")
    seen = read.select("record_id", "check", F.col("v.passed").alias("passed"), F.col("v.feedback").alias("feedback"), F.when(wrong.isNotNull(), F.concat_ws(": ", "check", wrong)).alias("wrong"))
    lost = F.when(F.col("c.action") == "rewrite", lost_formulas(F.col("source"), F.col("c.text")))
    guard = made.where(F.size(lost) > 0).select("record_id", F.lit("protected_math").alias("check"), F.lit(False).alias("passed"), F.concat(F.lit("Restore exactly: "), F.array_join(lost, " ")).alias("feedback"), F.lit(None).cast("string").alias("wrong"))
    # one row a check: at most five of a record
    bad = F.when(~F.col("passed"), F.struct("check", "feedback"))
    return seen.unionByName(guard).groupBy("record_id").agg(F.array_sort(F.collect_list(bad)).cast(FAILED).alias("failed"), F.min("wrong").alias("review_error"))


def review_rounds(records: DataFrame, generate: Backend, review: Backend, derive: Backend | None = None, rules: DataFrame | None = None, max_rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """records (record_id, text), record_id unique. Returns the results and the history of attempts.

    Results (RESULT): status accepted, dropped, review_rejected (rounds used up) or model_failed; text is empty unless
    accepted. A null or blank text is skipped_empty_after_cleanup, without a call. rules (ord, rule): the last
    SHOWN_RULES are shown to all. Each new attempt sees its record's rejected ones, their feedback and the rules that
    `derive` drew from them. History: record_id, attempt, action, text, failed, retry_rules.
    """
    shown = [] if rules is None else [r["rule"] for r in rules.orderBy(F.col("ord").desc()).limit(SHOWN_RULES).collect()][::-1]
    fixed = F.array(*[F.lit(r) for r in shown]).cast("array<string>")
    none = F.array().cast("array<string>")
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    nothing = [F.lit("none").alias("action"), F.lit("").alias("text")]
    results = records.where(blank).select("record_id", F.lit("skipped_empty_after_cleanup").alias("status"), *nothing, F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"))
    history = None
    live = records.where(~blank).select("record_id", F.col("text").alias("source"), none.alias("rejected"), none.alias("retry_rules"))
    for attempt in range(1, max_rounds + 1):
        asked = model_stage.asked(live, "generate", generate, F.col("source"), F.array_distinct(F.concat(fixed, "retry_rules")).alias("rules"), F.col("rejected"))
        made = cut(asked.withColumn("c", parsing.candidate_udf("response", "source")).withColumn("error", F.coalesce("error", "c.error")))
        seen = _reviewed(made.where("error is null"), review)
        out = made.join(seen, "record_id", "left").withColumn("error", F.coalesce("error", "review_error"))
        passed = F.size("failed") == 0
        status = F.when(F.col("error").isNotNull(), "model_failed").when(passed & (F.col("c.action") == "drop"), "dropped").when(passed, "accepted").when(F.lit(attempt == max_rounds), "review_rejected").otherwise("open")
        out = cut(out.withColumn("status", status))
        kept = F.col("status") == "accepted"
        ended = out.where("status <> 'open'").select("record_id", "status", F.when(F.col("status").isin("accepted", "dropped"), F.col("c.action")).otherwise("none").alias("action"), F.when(kept, F.col("c.text")).otherwise("").alias("text"), F.lit(attempt).alias("attempts"), "error")
        results = results.unionByName(ended)
        again = out.where("status = 'open'").select("record_id", "source", "rejected", "retry_rules", "c", "failed")
        if derive is None:
            again = again.withColumn("new_rules", none)
        else:
            told = model_stage.asked(again, "retry_rules", derive, F.col("source"), F.col("c.text").alias("text"), F.col("failed"))
            learnt = parsing.rules_udf("response", F.transform("failed", lambda x: x["check"]), F.col("c.answer").isNotNull())
            again = cut(told.withColumn("new_rules", F.transform(learnt, lambda r: r["rule"])))
        tried = lambda df, new: df.select("record_id", F.lit(attempt).alias("attempt"), "c.action", "c.text", "failed", new.alias("retry_rules"))
        entry = tried(out.where("status <> 'open' and error is null"), none).unionByName(tried(again, F.col("new_rules")))
        history = entry if history is None else history.unionByName(entry)
        told_back = F.to_json(F.struct(F.lit(attempt).alias("attempt"), F.col("c.action").alias("action"), F.col("c.text").alias("text"), "failed"))
        live = again.select("record_id", "source", F.array_append("rejected", told_back).alias("rejected"), F.array_distinct(F.concat("retry_rules", "new_rules")).alias("retry_rules"))
        if attempt < max_rounds and live.isEmpty():
            break
    return results, history


def confirmed_rules(records: DataFrame, results: DataFrame, history: DataFrame, derive: Backend, rules: DataFrame) -> DataFrame:
    """rules (ord, category, rule, source_record_id) and those learnt from records accepted after a rejected attempt.

    Only attempts whose text differs from the accepted one teach. A rule is known by category and lower-cased text;
    the record with the smallest id is its source. The next batch of records is shown the new table: the
    reference protocol's record after record becomes batch after batch.
    """
    won = results.where(F.col("status").isin("accepted", "dropped") & (F.col("attempts") > 1)).select("record_id", F.col("action").alias("won_action"), F.col("text").alias("won_text"))
    lessons = history.where(F.size("failed") > 0).join(won, "record_id").where("text <> won_text or action <> won_action")
    # a record's attempts are at most max_rounds
    per = lessons.groupBy("record_id", "won_action", "won_text").agg(F.array_sort(F.collect_list(F.struct("attempt", "text", "failed"))).alias("rejected"))
    told = model_stage.asked(per.join(records.select("record_id", F.col("text").alias("source")), "record_id"), "confirmed_rules", derive, F.col("source"), F.col("won_text").alias("text"), F.col("rejected"))
    checks = F.array_distinct(F.flatten(F.transform("rejected", lambda r: F.transform(r["failed"], lambda x: x["check"]))))
    found = told.select("record_id", F.explode(parsing.rules_udf("response", checks, F.lit(False))).alias("r")).select("r.category", "r.rule", F.col("record_id").alias("source_record_id"))
    key = lambda df: df.withColumn("_low", F.lower("rule"))
    new = key(found).groupBy("category", "_low").agg(F.min_by(F.struct("rule", "source_record_id"), "source_record_id").alias("r"))
    new = new.join(key(rules).select("category", "_low"), ["category", "_low"], "left_anti").select("category", "r.rule", "r.source_record_id")
    last = rules.agg(F.coalesce(F.max("ord"), F.lit(0))).first()[0]
    # new rules are few: distinct lessons of one batch
    return rules.select("ord", "category", "rule", "source_record_id").unionByName(cut(new).withColumn("ord", (F.lit(last) + F.row_number().over(Window.orderBy("source_record_id", "category", "rule"))).cast("long")))


def adaptive_rounds(records: DataFrame, generate: Backend, review: Backend, depth: int = SPLIT_DEPTH, **options) -> tuple[DataFrame, DataFrame]:
    """review_rounds, in which a record whose answer was cut off is done again in parts of half its size, up to `depth` times.

    Parts are called <record_id>::part_<3 digits>. A record is model_failed if a part is or if it can't be parted,
    review_rejected or dropped if all parts are, else accepted: its parts' results are spliced into its text.
    """
    levels, history = [], None
    level = records.select("record_id", "text", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    for k in range(depth + 1):
        results, tried = review_rounds(level.select("record_id", "text"), generate, review, **options)
        done = cut(level.withColumnRenamed("text", "source").join(results, "record_id"))
        history = tried if history is None else history.unionByName(tried)
        long = done.where(F.col("error").contains("OutputTruncated")).select("record_id", "source", segment.chunks_udf("source", F.greatest(F.lit(LEAST_PART), F.floor(F.length("source") / 2).cast("int"))).alias("cuts"))
        parts = long.where(F.size("cuts") > 1).select("record_id", "source", F.posexplode("cuts").alias("i", "at"))
        level = cut(parts.select(F.format_string("%s::part_%03d", "record_id", F.col("i") + 1).alias("record_id"), F.substr("source", F.col("at.start") + 1, F.col("at.end") - F.col("at.start")).alias("text"), F.col("record_id").alias("parent"), F.col("at.start").alias("start"), F.col("at.end").alias("end")))
        levels.append(done)
        if k == depth or level.isEmpty():
            break
    below = None
    for done in reversed(levels):
        if below is not None:
            # a record's parts are as few as its text is short
            is_all = lambda s: F.bool_and(F.col("status") == s)
            status = F.when(F.bool_or(F.col("status") == "model_failed"), "model_failed").when(is_all("review_rejected"), "review_rejected").when(is_all("dropped"), "dropped").otherwise("accepted")
            whole = below.groupBy(F.col("parent").alias("record_id")).agg(status.alias("_status"), F.array_sort(F.collect_list(F.struct("start", "end", "status", "text"))).alias("_parts"), F.sum("attempts").cast("int").alias("_attempts"), F.min("error").alias("_error"))
            both = done.join(whole, "record_id", "left")
            ok = F.col("_status") == "accepted"
            text = F.when(ok, segment.assemble_udf(F.coalesce("source", F.lit("")), F.coalesce("_parts", F.array().cast("array<struct<start:int,end:int,status:string,text:string>>"))))
            action = F.when(ok, "rewrite").when(F.col("_status") == "dropped", "drop").otherwise("none")
            had = F.col("_status").isNotNull()
            new = {"status": F.col("_status"), "action": action, "text": F.coalesce(text, F.lit("")), "attempts": F.col("attempts") + F.col("_attempts"), "error": F.col("_error")}
            done = both.withColumns({c: F.when(had, v).otherwise(F.col(c)) for c, v in new.items()}).drop("_status", "_parts", "_attempts", "_error")
        below = done
    return below.select(*RESULT), history


def offline_writer(prompt: str) -> str:
    """A deterministic writer that proves the plumbing: by a digest of the source it keeps, drops, is cut off or rewrites.

    A rewrite is marked with one `?` less in each attempt, starting at two or four.
    """
    asked = json.loads(prompt)
    source, tries = asked["source"], len(asked["rejected"])
    kind = hashlib.sha256(source.encode()).digest()[0] % 6
    if kind == 2 and len(source) > 150:
        raise model_stage.OutputTruncated
    action = ("keep", "drop", "rewrite", "rewrite", "rewrite", "rewrite")[kind]
    marks = "?" * max(0, (4 if kind == 5 else 2) - tries)
    text = {"keep": source, "drop": "", "rewrite": source.upper() + marks}[action]
    return json.dumps({"action": action, "text": text, "answer": None, "explanation": None, "reason": "offline"})


def offline_reviewer(prompt: str) -> str:
    """Fails the semantics of a text that ends in two question marks or more, and its terminology at one."""
    asked = json.loads(prompt)
    mark = {"semantics": "??", "terminology": "?"}.get(asked["check"])
    bad = mark is not None and asked["text"].endswith(mark)
    return json.dumps({"passed": not bad, "feedback": "too many marks" if bad else ""})
