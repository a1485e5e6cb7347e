"""Readers. Bad rows are kept with a reason, so a run can report them instead of ending at the first one."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import parsing
from textloom.functions.native import book_id

RECORD = "struct<id:string,text:string,source_id:string,source_line:int,raw_text:string,metadata:map<string,string>>"


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as file paths name it, with a slash at its end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/") + "/"


def _decoded(path: Column) -> Column:
    """A path as its folder lists it: percent signs of a plus sign apart, file paths are URL-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def markdown_books(spark: SparkSession, root: str, least: int = 1) -> DataFrame:
    """rel_path, content, doc_id of every .md file under root; an error if there are fewer than `least`."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    top = unquote(_qualified(spark, root))
    # scheme and slashes may differ between the folder and its files; what follows the folder's own path doesn't
    inner = "/" + top.split(":", 1)[-1].lstrip("/") if ":" in top.split("/")[0] else top
    path = _decoded(F.col("_metadata.file_path"))
    rel = F.substr(path, F.locate(inner, path) + len(inner))
    books = files.select(rel.alias("rel_path"), F.col("value").alias("content"))
    if least and len(books.select("rel_path").take(least)) < least:
        raise FileNotFoundError(f"no Markdown files under {root}")
    return books.select("rel_path", "content", book_id(F.col("rel_path")).alias("doc_id"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1 in each file), value of every line; files are read split by split.

    Lines are numbered within their split, which is as large as spark.sql.files.maxPartitionBytes at most, and shifted by the
    lines of the splits before it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seen"), "value")
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("file", "block", before.alias("shift"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("seen"))
    return lines.withColumn("own", own).join(shifts, ["file", "block"]).select("file", (F.col("shift") + F.col("own")).alias("line_no"), "value")


def jsonl_records(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """file, line_no, record and error for every line of the files; limit: records up to that line number of each file (0: all)."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    if limit:
        lines = lines.where(F.col("line_no") <= limit)
    rows = lines.select("file", "line_no", F.from_json("value", RECORD).alias("record"), F.col("value").alias("raw"))
    parsed = F.try_parse_json("raw")
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(parsed, path, "variant")), F.lit("VOID"))
    line = F.col("record.source_line")
    error = (
        F.when(parsed.isNull() | ~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), "no JSON object")
        .when((kind("$.id") != "STRING") | (kind("$.text") != "STRING"), "id and text must be strings")
        .when(~F.startswith(kind("$.metadata"), F.lit("OBJECT")) & (kind("$.metadata") != "VOID"), "metadata must be an object")
        .when((kind("$.source_line") != "VOID") & (line.isNull() | (line < 1) | (kind("$.source_line") != "BIGINT")), "source_line must be positive")
    )
    return rows.select("file", "line_no", "record", error.alias("error"))


def validated(records: DataFrame) -> DataFrame:
    """jsonl_records with a reason also where an id was seen before (in order of file and line; the first keeps it)."""
    good = records.where("error is null").groupBy(F.col("record.id").alias("id")).agg(F.min(F.struct("file", "line_no")).alias("first"))
    joined = records.join(good, F.col("record.id") == F.col("id"), "left")
    again = F.col("error").isNull() & (F.struct("file", "line_no") != F.col("first"))
    return joined.select("file", "line_no", "record", F.when(again, "id used before").otherwise(F.col("error")).alias("error"))


def duplicate_ids(records: DataFrame, id_col: str = "id") -> DataFrame:
    return records.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")


def first_lines(spark: SparkSession, path: str, n: int = 1000) -> DataFrame:
    """file, line_no, value of the first n lines of each file."""
    return numbered_lines(spark, path).where(F.col("line_no") <= n)


def relation_schema(spark: SparkSession, path: str) -> DataFrame:
    """relation, definition of a headerless CSV; of one relation the last line stays."""
    lines = numbered_lines(spark, path).select("file", "line_no", F.from_csv("value", "relation string, definition string", {"escape": '"'}).alias("c"))
    return lines.groupBy("c.relation").agg(F.max_by("c.definition", F.struct("file", "line_no")).alias("definition"))


def tekgen(sentences: DataFrame) -> DataFrame:
    """Sentences all of whose triples have three fields with subject and object in the sentence, whatever the case."""
    low = F.lower("sentence")
    fits = F.forall("triples", lambda t: (F.size(t) == 3) & F.contains(low, F.lower(t[0])) & F.contains(low, F.lower(t[2])))
    return sentences.where(fits)


def resolved_entities(rows: DataFrame) -> DataFrame:
    """Relations (subject, object: places in entities) with the entities' surface forms."""
    name = lambda i: F.element_at("entities", i + 1)["surfaceform"]
    return rows.withColumn("triples", F.transform("relations", lambda r: F.struct(name(r["subject"]).alias("s"), r["predicate"].alias("p"), name(r["object"]).alias("o"))))


def gold_graphs(spark: SparkSession, path: str) -> DataFrame:
    """graph_id (the line's place in its file, from 0), triples, error of graphs written one a line."""
    rows = numbered_lines(spark, path).select((F.col("line_no") - 1).alias("graph_id"), parsing.gold_line_udf("value").alias("g"))
    return rows.select("graph_id", "g.triples", "g.error")


def predicted_graphs(spark: SparkSession, path: str) -> DataFrame:
    """graph_id, triples of predicted graphs; a line that can't be read is the fallback graph of one triple of Nulls."""
    return numbered_lines(spark, path).select((F.col("line_no") - 1).alias("graph_id"), parsing.graph_line_udf("value").alias("triples"))


def long_graphs(graphs: DataFrame, side: str) -> DataFrame:
    """graph_id, side, pos, s, p, o from rows with a list of triples."""
    return graphs.select("graph_id", F.lit(side).alias("side"), F.posexplode("triples").alias("pos", "t")).select("graph_id", "side", "pos", "t.s", "t.p", "t.o")


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """prompt, generated of a judge's CSV with a header; quoted fields may hold lines and quotes."""
    return _csv(spark, path, "prompt string, generated string")


LEXNORM_LABELLED = ("id", "original", "normalized", "input", "output", "rule_01", "rule_02")


def lexnorm_rows(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Rows of a lexical normalisation CSV, columns named by place; lists of words are read from their printed form.

    Without labels, normalized and output are absent. Rows with an empty field are left out.
    """
    names = [c for c in LEXNORM_LABELLED if labelled or c not in ("normalized", "output")]
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"').toDF(*names).na.drop()
    lists = [c for c in names if c in ("input", "output", "rule_01", "rule_02")]
    words = lambda c: F.transform(parsing.list_udf(c), lambda x: x[0])
    return raw.select(*(words(c).alias(c) if c in lists else c for c in names))
