"""Writers: refusing, atomic with a backup, and the protocol's own file forms."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _filesystem(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def refuse_inside(spark: SparkSession, output: str, *inputs: str) -> None:
    """Raise unless the output folder is new and lies outside of every input folder (and none inside it)."""
    fs, path = _filesystem(spark, output)
    if fs.exists(path):
        raise FileExistsError(f"{output} exists")
    out = fs.makeQualified(path).toString().rstrip("/") + "/"
    for folder in inputs:
        other_fs, other = _filesystem(spark, folder)
        at = other_fs.makeQualified(other).toString().rstrip("/") + "/"
        if out.startswith(at) or at.startswith(out):
            raise ValueError(f"{output} and {folder} lie one in the other")


def write_new(rows: DataFrame, path: str, *inputs: str) -> None:
    """JSON lines to a folder that must not exist and lies outside of the inputs."""
    refuse_inside(rows.sparkSession, path, *inputs)
    rows.write.mode("errorifexists").json(path)


def publish(rows: DataFrame, path: str, backup: bool = False) -> str | None:
    """Parquet under a name of its own first, renamed when whole; what was there goes to path.bak-<id> (backup) or away.

    Returns the backup's path. A run that fails before the renaming leaves the old folder as it is; on a store without
    atomic renames a reader should look for _SUCCESS.
    """
    spark = rows.sparkSession
    name = uuid.uuid4().hex
    fs, target = _filesystem(spark, path)
    _, fresh = _filesystem(spark, f"{path.rstrip('/')}.tmp-{name}")
    rows.write.parquet(fresh.toString())
    kept = None
    if fs.exists(target):
        kept = f"{path.rstrip('/')}.bak-{name}"
        if not fs.rename(target, _filesystem(spark, kept)[1]):
            raise OSError(f"{path} can't be moved away")
    if not fs.rename(fresh, target):
        raise OSError(f"{path} can't be published")
    if kept and not backup:
        fs.delete(_filesystem(spark, kept)[1], True)
        kept = None
    return kept


def write_prepared(prepared: DataFrame, folder: str) -> None:
    """prepared/ (all records as JSON lines) and input/ (texts of the ready ones, a line each, by segment id order)."""
    write_new(prepared, f"{folder}/prepared")
    ready = prepared.where("status = 'ready'").select("id", F.translate("clean_text", "\n", " ").alias("value"))
    ready.orderBy("id").select("value").write.text(f"{folder}/input")


def write_graph(segments: DataFrame, folder: str) -> None:
    """kg/ (a line for each segment with all its judgments) and triples/ (a line for each YES)."""
    write_new(segments, f"{folder}/kg")
    yes = segments.select("source_id", F.col("id").alias("segment_id"), "source_line", "metadata", F.explode("judgments").alias("j")).where("j.label = 'YES'")
    yes.select("source_id", "segment_id", "source_line", "metadata", F.array("j.s", "j.p", "j.o").alias("triple")).write.json(f"{folder}/triples")


def printed_triple(t: Column) -> Column:
    """A triple as a list in its printed form, quotes as the language's printer chooses them."""

    def cell(c: Column) -> Column:
        body = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
        return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))

    return F.concat(F.lit("["), F.concat_ws(", ", cell(t["s"]), cell(t["p"]), cell(t["o"])), F.lit("]"))


def canon_lines(stages: DataFrame) -> DataFrame:
    """index, value: of each document the list of its canonical triples in printed form."""
    return stages.select("index", F.concat(F.lit("["), F.array_join(F.transform(F.filter("canonical", lambda t: t["p"].isNotNull()), printed_triple), ", "), F.lit("]")).alias("value"))


def write_stages(stages: DataFrame, folder: str, iteration: int) -> None:
    """iter<n>/stages (Parquet), iter<n>/result (JSON lines under the protocol's field names, its misspelling included) and
    iter<n>/canon (printed graphs in order of index)."""
    at = f"{folder}/iter{iteration}"
    stages.write.parquet(f"{at}/stages")
    cells = lambda c: F.transform(c, lambda t: F.array(t["s"], t["p"], t["o"]))
    # a triple without a canonical relation is null there
    canonical = F.transform("canonical", lambda t: F.when(t["p"].isNotNull(), F.array(t["s"], t["p"], t["o"])))
    out = stages.select("index", "input_text", "entity_hint", "relation_hint", cells("oie").alias("oie"), "schema_definition", F.to_json("candidates").alias("canonicalization_candidates"), canonical.alias("schema_canonicalizaiton"))
    out.write.option("ignoreNullFields", False).json(f"{at}/result")
    canon_lines(stages).orderBy("index").select("value").write.text(f"{at}/canon")


def write_instructions(rows: DataFrame, folder: str) -> None:
    """instructions/ (JSON lines: instruction, input, output) and prompts/ (CSV with a header: prompt, response)."""
    rows.select("instruction", F.lit("").alias("input"), "output").write.json(f"{folder}/instructions")
    rows.select(F.col("instruction").alias("prompt"), F.col("output").alias("response")).write.option("header", True).option("escape", '"').csv(f"{folder}/prompts")


def write_filtered(graphs: DataFrame, folder: str) -> None:
    """Graphs after a judge, a line each in order, between triple backticks."""
    body = F.concat(F.lit("```["), F.array_join(F.transform("triples", printed_triple), ", "), F.lit("]```"))
    graphs.orderBy("graph_id").select(body.alias("value")).write.text(folder)


def append_rules(rules: DataFrame, log: str, table: str) -> DataFrame:
    """Rules (category, rule, evidence, source_record_id) go to the log; the table is rewritten with those it hasn't got,
    under category and rule whatever the case, the first one of each. Returns the table."""
    spark = rules.sparkSession
    rules.write.mode("append").parquet(log)
    every = spark.read.parquet(log)
    first = every.groupBy("category", F.lower(F.trim("rule")).alias("key")).agg(F.min_by(F.struct("rule", "evidence", "source_record_id"), F.struct("source_record_id", "rule")).alias("r"))
    publish(first.select("category", "r.rule", "r.evidence", "r.source_record_id"), table)
    return spark.read.parquet(table)
