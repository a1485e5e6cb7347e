"""Queries over the driver's tables, one or more for each operator, with the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import clean, native, parsing, segment
from textloom.operators import canonical, graphs, hints, lexnorm, numbering, retriever, review, triples
from textloom.plans.lineage import cut
from textloom.plans import agents, corpus, edc, model_stage
from textloom.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, d: f(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# --- inputs that stand in for models' output

STAR_SQL = """star AS (
  SELECT c_nationkey::BIGINT AS graph_id, c_custkey * 2 AS pos, c_name AS s, 'lives_in' AS p, n_name AS o, c_acctbal, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT c_nationkey::BIGINT, c_custkey * 2 + 1, c_name, 'buys_for', c_mktsegment, c_acctbal, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey),
gold AS (SELECT graph_id, pos, s, p, o FROM star),
pred AS (SELECT graph_id, pos, s, p, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE o END AS o FROM star)"""


def star(t) -> DataFrame:
    """Two facts of every customer, a graph per nation."""
    c = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    facts = F.posexplode(F.array(F.struct(F.lit("lives_in").alias("p"), F.col("n_name").alias("o")), F.struct(F.lit("buys_for").alias("p"), F.col("c_mktsegment").alias("o"))))
    c = c.select(F.col("c_nationkey").cast("long").alias("graph_id"), "c_custkey", F.col("c_name").alias("s"), "c_acctbal", "c_mktsegment", facts.alias("k", "f"))
    return c.select("graph_id", (F.col("c_custkey") * 2 + F.col("k")).alias("pos"), "s", "f.p", "f.o", "c_acctbal", "c_mktsegment")


def gold_pred(t) -> tuple[DataFrame, DataFrame]:
    rows = star(t)
    wrong = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.col("o"))
    return rows.select("graph_id", "pos", "s", "p", "o"), rows.select("graph_id", "pos", "s", "p", wrong.alias("o"))


# --- text functions

DOCS_TRIPLES_SQL = r"""w AS (SELECT doc_id, lang, text, regexp_extract_all(text, '\p{Lu}[\p{L}\p{M}]*') AS w FROM documents),
t AS (SELECT doc_id, lang, text, w[i] AS s, 'followed_by' AS p, w[i + 1] AS o FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w))"""


@query(f"WITH {DOCS_TRIPLES_SQL} SELECT lang, count(*) AS n_triples FROM (SELECT DISTINCT doc_id, lang, s, p, o FROM t WHERE contains(text, s) AND contains(text, o)) GROUP BY lang")
def grounded_triples_by_lang(t):
    found = triples.grounded_name_triples(t("documents")).where("label = 'YES'")
    return triples.distinct_in_order(found, "doc_id", "lang").groupBy("lang").agg(F.count("*").alias("n_triples"))


def _spans(name: str, pattern: str, sql_pattern: str) -> None:
    def run(t):
        found = native.spans(F.col("text"), pattern)
        return t("documents").select("doc_id", F.size(found).cast("long").alias("n"), F.array_join(found, "|").alias("spans"))

    run.__name__ = name
    query(f"SELECT doc_id, len(f)::BIGINT AS n, array_to_string(f, '|') AS spans FROM (SELECT doc_id, regexp_extract_all(text, '{sql_pattern}') AS f FROM documents)")(run)


_spans("number_spans", native.NUMBER, native.NUMBER)
_spans("math_spans", native.MATH, native.MATH)
_spans("capitalized_words", native.CAPITALISED, native.CAPITALISED)

MATH_COUNTS_SQL = rf"SELECT doc_id, span, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(%s, '{native.MATH}')) AS span FROM documents) GROUP BY ALL"


@query(f"SELECT a.doc_id, a.span, (a.n - coalesce(b.n, 0))::BIGINT AS missing FROM ({MATH_COUNTS_SQL % 'text'}) a LEFT JOIN ({MATH_COUNTS_SQL % 'substr(text, 1, length(text) // 2)'}) b USING (doc_id, span) WHERE a.n > coalesce(b.n, 0)")
def missing_math_multiset(t):
    """Formulas of each text that its first half lacks, with multiplicity."""
    exploded = lambda c: t("documents").select("doc_id", F.explode(native.spans(c, native.MATH)).alias("span"))
    half = F.substr(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    return review.multiset_difference(exploded(F.col("text")), exploded(half), "doc_id", "span")


@query("SELECT doc_id, length(text)::BIGINT AS n_old, length(replace(text, ' the ', ' '))::BIGINT AS n_new, length(replace(text, ' the ', ' ')) BETWEEN 0.6 * length(text) AND 1.4 * length(text) AS ok FROM documents")
def length_ratio_guard(t):
    new = F.replace(F.col("text"), F.lit(" the "), F.lit(" "))
    n = lambda c: F.length(c).cast("long")
    return t("documents").select("doc_id", n("text").alias("n_old"), n(new).alias("n_new"), n(new).between(0.6 * n("text"), 1.4 * n("text")).alias("ok"))


@query("SELECT doc_id, coalesce(length(text) > 0, false) AS same, coalesce(length(text) > 0 AND NOT regexp_matches(text, '[0-9]'), false) AS digits_changed, false AS cut_short FROM documents")
def safe_correction(t):
    """Whether three changes of each document would be safe corrections: none, every digit raised, all but a third cut off."""
    raised = F.translate("text", "0123456789", "1234567890")
    short = F.substr(F.col("text"), F.lit(1), F.floor(F.length("text") / 3).cast("int"))
    return t("documents").select("doc_id", parsing.safe_udf("text", "text").alias("same"), parsing.safe_udf("text", raised).alias("digits_changed"), parsing.safe_udf("text", short).alias("cut_short"))


# relation lists as a model writes them: of a nation its suppliers' segments, one of them twice, an answer line, one without a colon
@query("""WITH x AS (SELECT n_nationkey AS doc_id, unnest([n_name || ': first of ' || n_name, 'Answer: none', ' next_to : lies by: ' || n_regionkey, 'no definition', n_name || ': again ' || n_regionkey]) AS line, unnest([1, 2, 3, 4, 5]) AS i FROM nation),
p AS (SELECT doc_id, i, trim(split_part(line, ':', 1)) AS relation, trim(substr(line, strpos(line, ':') + 1)) AS definition FROM x WHERE contains(line, ':'))
SELECT doc_id, relation, arg_max(definition, i) AS definition FROM p WHERE relation <> 'Answer' GROUP BY doc_id, relation""")
def relation_definition_parse(t):
    region = F.col("n_regionkey").cast("string")
    text = F.concat_ws("\n", F.concat("n_name", F.lit(": first of "), "n_name"), F.lit("Answer: none"), F.concat(F.lit(" next_to : lies by: "), region), F.lit("no definition"), F.concat("n_name", F.lit(": again "), region))
    return t("nation").select(F.col("n_nationkey").alias("doc_id"), F.inline(native.relation_definitions(text)))


@query(r"SELECT conv_id, turn, CASE upper(regexp_extract(text, '(?i)^\s*(YES|NO|UNSURE)\s*[.!]?\s*$', 1)) WHEN '' THEN 'UNSURE' ELSE upper(regexp_extract(text, '(?i)^\s*(YES|NO|UNSURE)\s*[.!]?\s*$', 1)) END AS label FROM conversations")
def judge_label_strict(t):
    return t("conversations").select("conv_id", "turn", native.strict_judgment(F.col("text")).alias("label"))


@query("SELECT conv_id, turn, NOT (contains(lower(substr(text, 1, 100)), 'no') OR contains(lower(substr(text, 1, 100)), 'false')) AS verdict FROM conversations")
def judge_label_prefix(t):
    return t("conversations").select("conv_id", "turn", native.prefix_judgment(F.col("text")).alias("verdict"))


@query("""WITH x AS (SELECT l.quality = 1 AS y, NOT (contains(lower(substr(d.text, 1, 100)), 'no') OR contains(lower(substr(d.text, 1, 100)), 'false')) AS g FROM documents d JOIN labels l USING (doc_id)),
c AS (SELECT count(*) FILTER (y AND g) AS tp, count(*) FILTER (NOT y AND g) AS fp, count(*) FILTER (y AND NOT g) AS fn, avg((y = g)::INT) AS a FROM x)
SELECT round(a, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def judge_binary_metrics(t):
    rows = t("documents").join(t("labels"), "doc_id")
    return rows.agg(*review.binary_metrics(F.col("quality") == 1, native.prefix_judgment(F.col("text"))))


BARE = "replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D')"


@query(f"SELECT doc_id, {BARE} AS text FROM documents")
def strip_accents_full(t):
    return t("documents").select("doc_id", native.strip_accents(F.col("text")).alias("text"))


@query("SELECT conv_id, turn, CASE WHEN ends_with(x, '.') THEN x ELSE x || '.' END AS text FROM (SELECT conv_id, turn, replace(replace(upper(substr(text, 1, 1)) || lower(substr(text, 2)), ' ,', ','), ' .', '.') AS x FROM conversations)")
def sentence_case(t):
    return t("conversations").select("conv_id", "turn", native.sentence_case(F.col("text")).alias("text"))


@query("SELECT page_id, 'book:' || substr(sha256(url), 1, 16) AS doc_id FROM pages")
def doc_sha_id(t):
    return t("pages").select("page_id", native.book_id(F.col("url")).alias("doc_id"))


@query("SELECT conv_id, turn, CASE WHEN n = 1 THEN 'c' || conv_id ELSE 'c' || conv_id || '::part' || (turn + 1) END AS segment_id FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)")
def segment_ids(t):
    n = t("conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    rows = t("conversations").join(n, "conv_id")
    return rows.select("conv_id", "turn", native.part_id(F.concat(F.lit("c"), "conv_id"), F.col("turn") + 1, F.col("n")).alias("segment_id"))


@query("SELECT page_id, true AS spaced, true AS no_tags, true AS no_blank_before_marks FROM pages WHERE NOT contains(html, '$')")
def clean_pages(t):
    """Every page without formulas, as what must hold after the cleanup: single blanks, none of the known tags, none before a mark."""
    text = F.col("text")
    tags = r"(?i)</?(p|div|span|strong|em|br|ul|ol|li|h[1-6]|sup|sub|a|img|section|article|tbody|thead|table|tr|td|th|details|summary)\b[^>]*>"
    done = t("pages").where(~F.contains("html", F.lit("$"))).select("page_id", clean.clean_text_udf("html").alias("text"))
    return done.select("page_id", (~F.rlike(text, F.lit(r"(?U)^\s|\s\s|\s$"))).alias("spaced"), (~F.rlike(text, F.lit(tags))).alias("no_tags"), (~F.rlike(text, F.lit(r"(?U)\s[,.;:!?]"))).alias("no_blank_before_marks"))


@query("SELECT page_id, true AS no_comments, true AS single_gaps, true AS no_trailing_blanks FROM pages WHERE NOT contains(html, '$')")
def clean_book_pages(t):
    """Every page without formulas as a book: no comments, one blank line at most between lines, no blanks before a line feed."""
    text = F.col("text")
    done = t("pages").where(~F.contains("html", F.lit("$"))).select("page_id", clean.clean_book_udf("html").alias("text"))
    return done.select("page_id", (~F.contains(text, F.lit("<!--"))).alias("no_comments"), (~F.contains(text, F.lit("\n\n\n"))).alias("single_gaps"), (~F.rlike(text, F.lit(r"[ \t]\n"))).alias("no_trailing_blanks"))


# what SQL can state of cuts: pieces hold the text's words in order, fit the limit unless a word or formula is longer, and
# offset chunks with the white space between them are the text
BARE_TEXT = r"regexp_replace(text, '[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}\x{001c}-\x{001f}]+', '', 'g')"


@query(f"SELECT doc_id, md5({BARE_TEXT}) AS words, true AS trimmed, true AS fits FROM documents WHERE {BARE_TEXT} <> ''")
def split_segments(t):
    """Pieces of every text, as invariants: the rejoined words, no white space around pieces, and the limit."""
    pieces = cut(t("documents").select("doc_id", F.posexplode(segment.split_udf("text", F.lit(1800))).alias("part", "piece")))
    bare = lambda c: F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", "")
    # a text's pieces are as many as its length over half the limit
    per = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda x: x["piece"]), "")
    fits = (F.length("piece") <= 1800) | F.contains("piece", F.lit("$")) | ~F.rlike("piece", F.lit(r"(?U)\s"))
    out = pieces.groupBy("doc_id").agg(F.md5(bare(per).cast("binary")).alias("words"), F.bool_and(F.rlike("piece", F.lit(r"(?Us)^\S(.*\S)?$"))).alias("trimmed"), F.bool_and(fits).alias("fits"))
    return out


@query(f"SELECT doc_id, true AS numbered, true AS lines_rise, true AS fits FROM documents WHERE {BARE_TEXT} <> ''")
def pack_segments(t):
    """Segments of every text as a book: numbered from 1, their lines in order, within the limit."""
    packed = t("documents").select("doc_id", "text").mapInArrow(segment.pack_books, segment.PACKED)
    fits = (F.length("text") <= 1800) | ~F.contains("text", F.lit("\n\n"))
    per = packed.groupBy("doc_id").agg((F.max("part") == F.count("*")).alias("a"), (F.min("part") == 1).alias("b"), F.bool_and(F.col("start_line") <= F.col("end_line")).alias("lines_rise"), F.bool_and(fits).alias("fits"))
    return per.select("doc_id", (F.col("a") & F.col("b")).alias("numbered"), "lines_rise", "fits")


def _chunked(t) -> DataFrame:
    return t("documents").select("doc_id", "text", F.posexplode(segment.chunks_udf("text", F.lit(1800))).alias("index", "c")).select("doc_id", "text", "index", "c.start", "c.end")


@query(f"SELECT doc_id, length(text)::BIGINT AS n_chars, true AS rising, md5({BARE_TEXT}) AS words FROM documents WHERE {BARE_TEXT} <> ''")
def chunk_offsets(t):
    """Offset chunks of every text: they rise without overlap and hold all that is no white space."""
    chunked = cut(t("documents").select("doc_id", "text", segment.chunks_udf("text", F.lit(1800)).alias("c")).where(F.size("c") > 0))
    rising = F.forall(F.sequence(F.lit(1), F.size("c")), lambda i: (F.get("c", i - 1)["start"] < F.get("c", i - 1)["end"]) & F.coalesce(F.get("c", i - 1)["end"] <= F.get("c", i)["start"], F.lit(True)))
    held = F.array_join(F.transform("c", lambda x: F.substring(F.col("text"), x["start"] + 1, x["end"] - x["start"])), "")
    return chunked.select("doc_id", F.length("text").cast("long").alias("n_chars"), rising.alias("rising"), F.md5(F.regexp_replace(held, r"(?U)[\s\x1c-\x1f]+", "").cast("binary")).alias("words"))


@query("""WITH RECURSIVE b AS (SELECT doc_id, length(text) AS n FROM documents WHERE regexp_matches(text, '\\S'))
SELECT count(*) AS books, count(*) FILTER (n <= 1800) AS whole, true AS enough FROM b""")
def chunk_plan_counts(t):
    """Books and their chunks without work on them: a book within the limit is one chunk, a longer one at least its length over the limit."""
    n = t("documents").select(F.length("text").alias("n"), F.size(segment.chunks_udf("text", F.lit(1800))).alias("chunks")).where("chunks > 0")
    return n.agg(F.count("*").alias("books"), F.count(F.when((F.col("n") <= 1800) & (F.col("chunks") == 1), 1)).alias("whole"), F.bool_and(F.col("chunks") >= F.floor(F.col("n") / 3700)).alias("enough"))


CLEANED = "(SELECT doc_id, text FROM documents WHERE NOT regexp_matches(text, '[$&<>#\\\\\\[]'))"


@query(rf"""SELECT sum(length(text))::BIGINT AS chars_in, sum(length(trim(regexp_replace(regexp_replace(text, '\s+([,.;:!?])', '\1', 'g'), '\s+', ' ', 'g'))))::BIGINT AS chars_out FROM {CLEANED}""")
def cleanup_character_counts(t):
    """Characters before and after the cleanup, of the texts without markup signs: there SQL can state the whole cleanup."""
    plain = t("documents").where(~F.rlike("text", F.lit(r"[$&<>#\\\[]")))
    return plain.agg(F.sum(F.length("text")).alias("chars_in"), F.sum(F.length(clean.clean_text_udf("text"))).alias("chars_out"))


@query("SELECT doc_id, length(nfc_normalize(text))::BIGINT AS n FROM documents")
def nfc_text_length(t):
    return t("documents").select("doc_id", F.length(clean.nfc_udf("text")).cast("long").alias("n"))


@query("SELECT page_id, length(html)::BIGINT AS n_html, true AS no_tags, true AS no_comments FROM pages")
def page_text_lengths(t):
    """HTML to text: no tag and no comment is left in a page's lines."""
    text = clean.html_text_udf("html")
    return t("pages").select("page_id", F.length("html").cast("long").alias("n_html"), (~F.rlike(text, F.lit(r"</?[a-zA-Z][^<>]*>"))).alias("no_tags"), (~F.contains(text, F.lit("<!--"))).alias("no_comments"))


@query(r"""SELECT item_id, replace(replace(strip_accents(regexp_replace(lower(trim(regexp_replace(replace(regexp_replace(text, '(\p{Ll})(\p{Lu})', '\1 \2', 'g'), '_', ' '), '[ \t\n\r]+', ' ', 'g'))), ' \([^()]*\)$', '')), 'đ', 'd'), 'Đ', 'D') AS low, length(text)::BIGINT AS n FROM benchmark""")
def normalised_benchmark(t):
    return t("benchmark").select("item_id", native.normalise_for_scoring(F.col("text")).alias("low"), F.length("text").cast("long").alias("n"))


# answers of a model as literal rows, with what becomes of each
def _answers(name: str, cases: list[tuple]):
    """Cases: (answer, outcome...); the SQL states the outcomes by the case's number."""

    def register(f):
        columns = f.__annotations__["return"].strip("'\"").split()
        values = ", ".join("(" + ", ".join(map(str, [i])) + ", " + ", ".join("NULL" if v is None else f"'{str(v).lower()}'" if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" for v in c[1:]) + ")" for i, c in enumerate(cases))
        names = ", ".join(["case_id", *columns])
        f.__annotations__ = {}
        run = lambda t: f(t("region").sparkSession.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "case_id long, answer string"))
        run.__name__ = name
        return query(f"SELECT case_id::BIGINT AS case_id, {', '.join(columns)} FROM (VALUES {values}) AS v({names})")(run)

    return register


@_answers("verdict_outcomes", [
    ('{"passed": true, "feedback": ""}', True, "", None), ('{"passed": false, "feedback": "two"}', False, "two", None), ('{"passed": false, "feedback": "x", "score": 1}', False, "x", None),
    ('{"passed": "false", "feedback": "x"}', None, None, "invalid"), ('{"passed": true, "feedback": null}', None, None, "invalid"), ('{"passed": true}', None, None, "invalid"), ('{"passed": false, "feedback": " "}', None, None, "failed without feedback"),
    ('{"passed": false, "feedback": "not do', None, None, "truncated"), ('{"passed": false, "feedback": "done"', None, None, "truncated"), ('{"passed":, "feedback": "x"}', None, None, "invalid"), ("[]", None, None, "invalid"), ("fine", None, None, "invalid"),
])
def _verdicts(rows) -> "passed feedback error":  # noqa: F722
    return rows.withColumn("v", parsing.verdict_udf("answer")).select("case_id", F.col("v.passed").cast("string").alias("passed"), "v.feedback", "v.error")


def _offer(**fields) -> str:
    import json

    return json.dumps({"action": "rewrite", "text": "1 + 2? A. 3 B. 4", "answer": None, "explanation": None, "reason": "checked", **fields}, ensure_ascii=False)


_SOLVED = "1 + 2? A. 3 B. 4\nĐáp án: A\nGiải thích: the sum is 3."


@_answers("candidate_outcomes", [
    (_offer(), "keep", "1 + 2? A. 3 B. 4", None, None), (_offer(action="keep", text="2 + 1?"), "rewrite", "2 + 1?", None, None), (_offer(action="drop", text=""), "drop", "", None, None), (_offer(action="drop"), None, None, None, "drop with content"),
    (_offer(answer="A", explanation="the sum is 3."), "rewrite", _SOLVED, "A", None), (_offer(text=_SOLVED, answer="A", explanation="the sum is 3."), "rewrite", _SOLVED, "A", None),
    (_offer(text="1 + 2? A. 3 B. 4\nĐáp án: B", answer="A", explanation="x"), None, None, None, "conflicting answer"), (_offer(answer="A"), None, None, None, "explanation"), (_offer(text=5), None, None, None, "fields"), (_offer(reason=""), None, None, None, "fields"),
    (_offer(text=" "), None, None, None, "empty rewrite"), (_offer(more=1), None, None, None, "fields"), (_offer()[:25], None, None, None, "truncated"), ("none", None, None, None, "invalid"), ("```json\n" + _offer(action="keep") + "\n```", "keep", "1 + 2? A. 3 B. 4", None, None),
])
def _candidates(rows) -> "action text answer error":  # noqa: F722
    return rows.withColumn("c", parsing.candidate_udf("answer", F.lit("1 + 2? A. 3 B. 4"))).select("case_id", "c.action", "c.text", "c.answer", "c.error")


@query("""WITH RECURSIVE r AS (SELECT conv_id, turn, role, length(role) + length(text) + 32 AS cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations),
w AS (SELECT conv_id, turn, n, cost <= 200 AS kept, CASE WHEN cost <= 200 THEN 200 - cost ELSE 200 END AS room FROM r WHERE n = 1
UNION ALL SELECT r.conv_id, r.turn, r.n, r.cost <= w.room, CASE WHEN r.cost <= w.room THEN w.room - r.cost ELSE w.room END FROM w JOIN r ON r.conv_id = w.conv_id AND r.n = w.n + 1)
SELECT conv_id, turn FROM w WHERE kept""")
def rule_budget(t):
    """Turns as rules, newest first, into a budget; one that doesn't fit is passed over."""
    # the rules of one prompt
    per = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("r"))
    kept = parsing.budgeted_udf(F.transform("r", lambda x: x["role"]), F.transform("r", lambda x: x["text"]), F.lit(200))
    return per.select("conv_id", "r", F.explode(kept).alias("k")).select("conv_id", F.get("r", F.col("k"))["turn"].alias("turn"))


@query("SELECT record_id, unnest(string_split(f, ',')) AS check_name FROM (SELECT doc_id AS record_id, concat_ws(',', CASE WHEN quality <> 1 THEN 'quality' END, CASE WHEN toxic <> 0 THEN 'toxic' END) AS f FROM labels) WHERE f <> ''")
def failed_checks(t):
    checks = F.explode(F.array(F.struct(F.lit("quality").alias("check"), (F.col("quality") == 1).alias("passed")), F.struct(F.lit("toxic").alias("check"), (F.col("toxic") == 0).alias("passed"))))
    done = review.accepted(t("labels").select(F.col("doc_id").alias("record_id"), checks.alias("v")).select("record_id", "v.check", "v.passed"))
    return done.where("failed_checks <> ''").select("record_id", F.explode(F.split("failed_checks", ",")).alias("check_name"))


# --- triples

@query(f"WITH {STAR_SQL} SELECT graph_id, pos, s, p, o FROM gold")
def star_schema_triples(t):
    return gold_pred(t)[0]


@query("WITH x AS (SELECT c_nationkey::BIGINT AS graph_id, c_custkey AS pos, c_mktsegment AS s, 'sold_in' AS p, n_name AS o FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT graph_id, s, p, o, min(pos) AS pos FROM x GROUP BY ALL")
def triple_dedupe(t):
    c = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return triples.distinct_in_order(c.select(F.col("c_nationkey").cast("long").alias("graph_id"), F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("s"), F.lit("sold_in").alias("p"), F.col("n_name").alias("o")), "graph_id")


PER_SQL = f"""WITH {STAR_SQL}, k AS (SELECT graph_id, s, p, o, max(g) AS g, max(h) AS h FROM (SELECT graph_id, %s AS s, %s AS p, %s AS o, 1 AS g, 0 AS h FROM gold UNION ALL SELECT graph_id, %s, %s, %s, 0, 1 FROM pred) GROUP BY ALL)"""


@query(PER_SQL % (("lower(trim(s))", "lower(trim(p))", "lower(trim(o))") * 2) + " SELECT sum(g * h)::BIGINT AS tp, sum(g)::BIGINT AS n_gold, sum(h)::BIGINT AS n_pred, round(sum(g * h) / sum(h), 6) AS precision, round(sum(g * h) / sum(g), 6) AS recall, round(2.0 * sum(g * h) / (sum(g) + sum(h)), 6) AS f1 FROM k")
def triple_micro_prf(t):
    return triples.micro_scores(*gold_pred(t))


@query(PER_SQL % (("s", "p", "o") * 2) + ", c AS (SELECT s, p, o, sum(g * h) AS tp, sum(g) AS g, sum(h) AS h FROM k GROUP BY s, p, o) SELECT round(avg(CASE WHEN h > 0 THEN tp / h ELSE 0 END), 6) AS precision, round(avg(CASE WHEN g > 0 THEN tp / g ELSE 0 END), 6) AS recall, round(avg(2.0 * tp / (g + h)), 6) AS f1, count(*) AS classes FROM c")
def triple_macro_prf(t):
    return triples.macro_scores(*gold_pred(t))


@query(f"WITH {STAR_SQL} SELECT round(avg(((graph_id, lower(trim(s)), lower(trim(p)), lower(trim(o))) IN (SELECT (graph_id, lower(trim(s)), lower(trim(p)), lower(trim(o))) FROM gold))::INT), 6) AS accuracy, count(*) AS n_pred FROM pred")
def triple_accuracy(t):
    return triples.match_accuracy(*gold_pred(t))


JUDGED_SQL = f"WITH {STAR_SQL}, kept AS (SELECT graph_id, pos, s, p, o FROM star WHERE c_acctbal >= 0)"


@query(f"{JUDGED_SQL} SELECT g.graph_id, g.n AS n_before, coalesce(k.n, 0) AS n_after, round(100.0 * coalesce(k.n, 0) / g.n, 4) AS retained_pct FROM (SELECT graph_id, count(*) AS n FROM gold GROUP BY 1) g LEFT JOIN (SELECT graph_id, count(*) AS n FROM kept GROUP BY 1) k USING (graph_id)")
def retention_by_doc(t):
    rows = star(t)
    return triples.retention(rows, rows.where("c_acctbal >= 0"))


@query(f"{JUDGED_SQL} SELECT * FROM kept")
def judge_filter_keyed(t):
    rows = star(t)
    return triples.judge_filter(rows.select("graph_id", "pos", "s", "p", "o"), rows.select("graph_id", "pos", (F.col("c_acctbal") >= 0).alias("verdict")))


@query(f"""WITH {STAR_SQL}, d AS (SELECT DISTINCT graph_id, o FROM gold), n AS (SELECT graph_id, o, lead(o) OVER w AS up, first(o) OVER w AS low FROM d WINDOW w AS (PARTITION BY graph_id ORDER BY o))
SELECT graph_id, pos, s, p, o, coalesce(up, CASE WHEN low <> o THEN low END) AS negative_tail FROM gold JOIN n USING (graph_id, o)""")
def negative_tail_sampling(t):
    return triples.negative_tails(gold_pred(t)[0])


@query(f"WITH {STAR_SQL} SELECT p, p = 'lives_in' AS known, count(*) AS n FROM gold GROUP BY ALL")
def known_vs_unknown_relations(t):
    rows = gold_pred(t)[0]
    schema = rows.sparkSession.createDataFrame([("lives_in", "a person has a home in a country")], "relation string, definition string")
    known, unknown = triples.split_known(rows, schema)
    return known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False))).groupBy("p", "known").agg(F.count("*").alias("n"))


@query(f"WITH {STAR_SQL} SELECT graph_id, pos, 'Is this true: ' || s || ' ' || p || ' ' || o || '?' AS prompt FROM gold")
def triple_questions(t):
    return gold_pred(t)[0].select("graph_id", "pos", native.triple_question(F.col("s"), F.col("p"), F.col("o")).alias("prompt"))


@query(f"WITH {STAR_SQL}, x AS (SELECT graph_id, pos, lower(s) || CASE WHEN pos % 3 = 0 THEN ' ' || p ELSE ' ' || p || ' ' || upper(o) END AS sentence, s, o, pos % 5 = 0 AS four FROM gold) SELECT graph_id, pos, sentence FROM x WHERE NOT four AND contains(lower(sentence), lower(s)) AND contains(lower(sentence), lower(o))")
def tekgen_filter(t):
    """Sentences of every star triple; a third lack the object, a fifth have a triple of four fields."""
    fields = F.when(F.col("pos") % 5 == 0, F.array("s", "p", "o", "p")).otherwise(F.array("s", "p", "o"))
    sentence = F.concat_ws(" ", F.lower("s"), "p", F.when(F.col("pos") % 3 != 0, F.upper("o")))
    return readers.tekgen(gold_pred(t)[0].select("graph_id", "pos", sentence.alias("sentence"), F.array(fields).alias("triples"))).select("graph_id", "pos", "sentence")


@query("""WITH x AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM x) WHERE rank <= 5""")
def topk_relations(t):
    """Queries: every row whose id is divisible by 100, against all rows."""
    v = t("embeddings")
    return triples.top_k(v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), v, 5)


PAIRS_SQL = """WITH x AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
y AS (SELECT vec_id, e, lead(e) OVER (PARTITION BY label ORDER BY vec_id) AS pos, lead(e) OVER (ORDER BY label, vec_id) AS nxt FROM x),
z AS (SELECT list_inner_product(e, pos) AS p, list_inner_product(e, list_reverse(pos)) AS n, sqrt(list_inner_product(e, e) * list_inner_product(pos, pos)) AS c FROM y WHERE pos IS NOT NULL)"""


def _pairs(t) -> DataFrame:
    """Each vector with the next of its label as positive and that one reversed as negative."""
    v = numbering.next_in_group(t("embeddings").select("vec_id", "label", "embedding"), "vec_id", "label", "embedding").withColumnRenamed("next_embedding", "pos")
    return v.select(native.dot(F.col("embedding"), F.col("pos")).alias("p"), native.dot(F.col("embedding"), F.reverse("pos")).alias("n"), F.sqrt(native.dot(F.col("embedding"), F.col("embedding")) * native.dot(F.col("pos"), F.col("pos"))).alias("c"))


@query(f"{PAIRS_SQL} SELECT round(avg((p > n)::INT), 6) AS accuracy, count(*) AS pairs FROM z")
def retrieval_accuracy(t):
    return _pairs(t).agg(F.round(F.avg((F.col("p") > F.col("n")).cast("double")), 6).alias("accuracy"), F.count("*").alias("pairs"))


@query(f"{PAIRS_SQL} SELECT round(avg(greatest((n - p) / c / 0.02, 0) + ln(1 + exp(-abs((n - p) / c / 0.02)))), 4) AS loss FROM z")
def infonce_loss(t):
    """log(1 + exp((negative - positive) / temperature)), in a form that can't overflow."""
    x = (F.col("n") - F.col("p")) / F.col("c") / 0.02
    return _pairs(t).agg(F.round(F.avg(F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))), 4).alias("loss"))


def _sides(t) -> DataFrame:
    """All star triples of each nation's graph, gold and predicted."""
    gold, pred = gold_pred(t)
    return gold.select(F.lit("gold").alias("side"), "*").unionByName(pred.select(F.lit("pred").alias("side"), "*"))


# gold and predicted edges differ in the object alone, and only where the prediction puts the segment for the country
WRONG_SQL = f"""WITH {STAR_SQL}, g AS (SELECT graph_id, count(*) AS n FROM gold GROUP BY 1), w AS (SELECT gold.graph_id, count(*) AS wrong FROM gold JOIN pred USING (graph_id, pos) WHERE gold.o <> pred.o GROUP BY 1)"""


@query(f"{WRONG_SQL} SELECT g.graph_id, coalesce(wrong, 0) = 0 AS isomorphic_if_right, true AS bounded, true AS perfect_if_right FROM g LEFT JOIN w USING (graph_id)")
def graph_matching_scores(t):
    """Scores of every graph, as what must hold: 1 for a right prediction, between 0 and 1 otherwise, precision = recall = F1 for as many edges."""
    gold, pred = gold_pred(t)
    scores = graphs.graph_scores(_sides(t))
    wrong = gold.join(pred.select("graph_id", "pos", F.col("o").alias("guess")), ["graph_id", "pos"]).groupBy("graph_id").agg(F.max((F.col("o") != F.col("guess")).cast("int")).alias("wrong"))
    near = lambda c, x: F.abs(F.col(c) - x) < 1e-9
    bounded = F.lit(True)
    for k in ("bleu", "rouge"):
        bounded = bounded & F.col(f"{k}_f1").between(0, 1 + 1e-9) & near(f"{k}_p", F.col(f"{k}_r")) & near(f"{k}_p", F.col(f"{k}_f1"))
    perfect = (F.col("wrong") == 1) | (near("rouge_f1", 1.0) & (F.col("edit_distance") == 0))  # BLEU smooths the orders that an edge is too short for
    return scores.join(wrong, "graph_id").select("graph_id", (F.col("isomorphic") & (F.col("wrong") == 0)).alias("isomorphic_if_right"), bounded.alias("bounded"), perfect.alias("perfect_if_right"))


@query(f"""{WRONG_SQL}, n AS (SELECT g.graph_id, g.n, coalesce(wrong, 0) AS wrong FROM g LEFT JOIN w USING (graph_id)), s AS (SELECT unnest(['ent_type', 'partial', 'strict', 'exact']) AS scheme),
k AS (SELECT unnest(['ALL', 'SUB', 'PRED', 'OBJ']) AS tag, unnest([3, 1, 1, 1]) AS slots, unnest([1, 0, 0, 1]) AS hit)
SELECT graph_id, scheme, tag, (slots * n - hit * wrong)::BIGINT AS correct, 0::BIGINT AS incorrect, 0::BIGINT AS partial, (hit * wrong)::BIGINT AS missed, (hit * wrong)::BIGINT AS spurious,
round((slots * n - hit * wrong) / (slots * n), 6) AS precision, round((slots * n - hit * wrong) / (slots * n), 6) AS recall, round((slots * n - hit * wrong) / (slots * n), 6) AS f1 FROM n, s, k""")
def slot_scores(t):
    """Each triple's slots against its prediction; a wrong object shares no word with the right one, so it is missed and spurious."""
    got = graphs.slot_scores(_sides(t))
    return got.select("graph_id", "scheme", "tag", *graphs.KINDS, *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


# --- review, resume, normalisation

VERDICTS_SQL = "v AS (SELECT doc_id AS record_id, 'quality' AS c, quality = 1 AS passed FROM labels UNION ALL SELECT doc_id, 'toxic', toxic = 0 FROM labels)"


@query(f"WITH {VERDICTS_SQL} SELECT record_id, bool_and(passed) AS accepted, coalesce(string_agg(c, ',' ORDER BY c) FILTER (NOT passed), '') AS failed_checks FROM v GROUP BY record_id")
def review_accept(t):
    checks = F.explode(F.array(F.struct(F.lit("quality").alias("check"), (F.col("quality") == 1).alias("passed")), F.struct(F.lit("toxic").alias("check"), (F.col("toxic") == 0).alias("passed"))))
    return review.accepted(t("labels").select(F.col("doc_id").alias("record_id"), checks.alias("v")).select("record_id", "v.check", "v.passed"))


# conversations as books: a user's turn is saved, a system's failed and was tried again, the rest is pending
SAVED_SQL = "saved AS (SELECT conv_id AS source_path, turn AS index, 1 AS ord, CASE WHEN role = 'system' THEN 'model_failed' ELSE 'accepted' END AS status FROM conversations WHERE role <> 'assistant' UNION ALL SELECT conv_id, turn, 2, 'accepted' FROM conversations WHERE role = 'system' AND length(text) > 40)"


def _saved(t) -> DataFrame:
    c = t("conversations")
    first = c.where("role <> 'assistant'").select(F.col("conv_id").alias("source_path"), F.col("turn").alias("index"), F.lit(1).alias("ord"), F.when(F.col("role") == "system", "model_failed").otherwise("accepted").alias("status"))
    again = c.where("role = 'system' and length(text) > 40").select(F.col("conv_id").alias("source_path"), F.col("turn").alias("index"), F.lit(2).alias("ord"), F.lit("accepted").alias("status"))
    return first.unionByName(again)


def _chunks(t) -> DataFrame:
    return t("conversations").select(F.col("conv_id").alias("source_path"), F.col("turn").alias("index"))


@query(f"WITH {SAVED_SQL} SELECT source_path, index, max(ord) AS ord, arg_max(status, ord) AS status FROM saved GROUP BY source_path, index")
def checkpoint_latest(t):
    return review.latest_checkpoint(_saved(t))


@query(f"WITH {SAVED_SQL} SELECT conv_id AS source_path, turn AS index FROM conversations WHERE (conv_id, turn) NOT IN (SELECT (source_path, index) FROM saved)")
def pending_chunks(t):
    return review.pending(_chunks(t), _saved(t))


@query(f"WITH {SAVED_SQL}, s AS (SELECT DISTINCT source_path, index FROM saved), x AS (SELECT conv_id AS source_path, count(*) AS n_chunks, count(s.index) AS n_done FROM conversations LEFT JOIN s ON conv_id = s.source_path AND turn = s.index GROUP BY 1) SELECT * FROM x WHERE n_chunks = n_done")
def publishable_books(t):
    return review.publishable(_chunks(t), _saved(t))


@query(r"""WITH x AS (SELECT conv_id, bool_or(role = 'system') AS dropped, string_agg(CASE role WHEN 'system' THEN '' WHEN 'user' THEN replace(text, 'e', 'E') ELSE text END, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN dropped THEN trim(regexp_replace(text, '\n(?:[ \t]*\n){2,}', chr(10) || chr(10), 'g'), chr(10)) ELSE text END AS text FROM x""")
def assemble_text(t):
    """Turns as chunks of a book: a system's are dropped, a user's rewritten, all others kept."""
    # one conversation
    per = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("r"))
    sizes = F.transform("r", lambda x: F.length(x["text"]) + 2)
    begin = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, x: a + x)
    status = lambda x: F.when(x["role"] == "system", "dropped").when(x["role"] == "user", "accepted").otherwise("model_failed")
    done = F.transform("r", lambda x, i: F.struct(begin(i).alias("start"), (begin(i) + F.length(x["text"])).alias("end"), status(x).alias("status"), F.when(x["role"] == "user", F.replace(x["text"], F.lit("e"), F.lit("E"))).otherwise("").alias("text")))
    whole = F.array_join(F.transform("r", lambda x: x["text"]), "\n\n")
    return per.select("conv_id", segment.assemble_udf(whole, done).alias("text"))


@query("""WITH w AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
SELECT conv_id, role, min(turn) AS first_at, least(count(*), 4) AS label, count(*) AS run FROM w GROUP BY conv_id, role, g""")
def mask_run_labels(t):
    return review.run_labels(t("conversations"), "conv_id", "turn", "role")


@query("SELECT item_id, sent_len, (row_number() OVER (PARTITION BY sent_len ORDER BY item_id) - 1) // 16 AS batch FROM (SELECT item_id, len(string_split(text, ' '))::BIGINT AS sent_len FROM benchmark)")
def length_buckets(t):
    return review.length_buckets(t("benchmark"), "item_id", F.size(F.split("text", " ")).cast("long"), 16)


@query("SELECT doc_id, sent_len, (row_number() OVER (PARTITION BY sent_len ORDER BY doc_id) - 1) // 16 AS batch FROM (SELECT doc_id, len(string_split(text, ' '))::BIGINT AS sent_len FROM documents)")
def length_buckets_documents(t):
    return review.length_buckets(t("documents"), "doc_id", F.size(F.split("text", " ")).cast("long"), 16)


@query("""WITH x AS (SELECT item_id AS batch, unnest(string_split(text, ' ')) AS source FROM benchmark), y AS (SELECT batch, source, lower(source) AS target, CASE WHEN length(source) > 3 THEN lower(source) ELSE source END AS predicted FROM x),
b AS (SELECT batch, coalesce(count(*) FILTER (source <> target AND predicted = target) / nullif(count(*) FILTER (source <> target), 0), 0) AS r, coalesce(count(*) FILTER (source <> target AND predicted = target) / nullif(count(*) FILTER (predicted <> source), 0), 0) AS p,
coalesce(count(*) FILTER (source = target AND predicted = target) / nullif(count(*) FILTER (source = target), 0), 0) AS k, avg((predicted = target)::INT) AS a FROM y GROUP BY batch)
SELECT round(100 * avg(r), 4) AS recall, round(100 * avg(p), 4) AS precision, round(100 * avg(k), 4) AS kept_recall, round(100 * avg(a), 4) AS accuracy FROM b""")
def lexnorm_metrics(t):
    tokens = t("benchmark").select(F.col("item_id").alias("batch"), F.explode(F.split("text", " ")).alias("source"))
    return review.lexnorm_metrics(tokens.withColumn("target", F.lower("source")).withColumn("predicted", F.when(F.length("source") > 3, F.lower("source")).otherwise(F.col("source"))))


@query("""WITH x AS (SELECT doc_id AS batch, unnest(string_split(text, ' ')) AS source FROM documents), y AS (SELECT batch, source, lower(source) AS target, CASE WHEN length(source) > 3 THEN lower(source) ELSE source END AS predicted FROM x),
b AS (SELECT batch, coalesce(count(*) FILTER (source <> target AND predicted = target) / nullif(count(*) FILTER (source <> target), 0), 0) AS r, coalesce(count(*) FILTER (source <> target AND predicted = target) / nullif(count(*) FILTER (predicted <> source), 0), 0) AS p,
coalesce(count(*) FILTER (source = target AND predicted = target) / nullif(count(*) FILTER (source = target), 0), 0) AS k, avg((predicted = target)::INT) AS a FROM y GROUP BY batch)
SELECT round(100 * avg(r), 4) AS recall, round(100 * avg(p), 4) AS precision, round(100 * avg(k), 4) AS kept_recall, round(100 * avg(a), 4) AS accuracy FROM b""")
def lexnorm_metrics_documents(t):
    tokens = t("documents").select(F.col("doc_id").alias("batch"), F.explode(F.split("text", " ")).alias("source"))
    return review.lexnorm_metrics(tokens.withColumn("target", F.lower("source")).withColumn("predicted", F.when(F.length("source") > 3, F.lower("source")).otherwise(F.col("source"))))


@query("SELECT item_id, text, 'A. ' || split_part(text, ' ', 1) || chr(10) || 'B. ' || split_part(text, ' ', 2) || chr(10) || 'C. None of the above' AS choices FROM benchmark")
def choice_blocks(t):
    words = F.slice(F.split("text", " "), 1, 2)
    return t("benchmark").select("item_id", "text", native.choice_block(words).alias("choices"))


@query(f"WITH {STAR_SQL}, q AS (SELECT graph_id, pos, 'Is this true: ' || s || ' ' || p || ' ' || o || '?' AS prompt FROM gold) SELECT graph_id, pos, list_extract(['YES', 'NO', 'UNSURE'], 1 + ('0x' || substr(sha256(prompt), 1, 2))::INT % 3) AS label, NULL::VARCHAR AS error FROM q")
def judged_offline(t):
    """Model stage with the offline backend: distinct questions, one call each, verdicts joined back."""
    rows = gold_pred(t)[0].select("graph_id", "pos", native.triple_question(F.col("s"), F.col("p"), F.col("o")).alias("prompt"))
    keyed = model_stage.with_prompt_id(rows, "offline")
    found = model_stage.call(keyed.select("prompt_id", "prompt").distinct(), model_stage.offline)
    return keyed.join(found, "prompt_id").select("graph_id", "pos", native.strict_judgment(F.col("response")).alias("label"), "error")


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k FROM events GROUP BY 1")
def json_records(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


# --- lexical normalisation

@query(r"""WITH w AS (SELECT item_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM benchmark),
p AS (SELECT item_id, i, regexp_extract_all(w, '.{1,3}') AS s, regexp_extract_all(replace(w, 'e', 'eee'), '.{1,3}') AS t, regexp_extract_all(replace(w, 'n', 'm') || 'xxxx', '.{1,3}') AS r FROM w),
q AS (SELECT *, unnest(range(1, greatest(len(s), len(t)) + 1)) AS k FROM p),
f AS (SELECT item_id, count(*) + 2 AS n, string_agg(coalesce(s[k], '<mask>'), ' ' ORDER BY i, k) AS a, string_agg(coalesce(t[k], '<space>'), ' ' ORDER BY i, k) AS b, string_agg(i::VARCHAR, ' ' ORDER BY i, k) AS g, string_agg(coalesce(r[k], '<space>'), ' ' ORDER BY i, k) AS v FROM q GROUP BY item_id)
SELECT item_id, '<s> ' || a || ' </s>' AS input, '<s> ' || b || ' </s>' AS output, g AS align_index, '<s> ' || v || ' </s>' AS votes, n::BIGINT AS sent_len FROM f""")
def aligned_pieces(t):
    pieces = lambda change: F.transform(F.split("text", " "), lambda w: F.regexp_extract_all(change(w), F.lit(".{1,3}"), F.lit(0)))
    rows = t("benchmark").select("item_id", pieces(lambda w: w).alias("source"), pieces(lambda w: F.replace(w, F.lit("e"), F.lit("eee"))).alias("target"), pieces(lambda w: F.concat(F.replace(w, F.lit("n"), F.lit("m")), F.lit("xxxx"))).alias("rule_01"))
    done = lexnorm.aligned(rows, rules=("rule_01",))
    return done.select("item_id", F.array_join("input_pieces", " ").alias("input"), F.array_join("output_pieces", " ").alias("output"), F.array_join(F.transform("align_index", lambda i: i.cast("string")), " ").alias("align_index"), F.array_join(F.flatten("weak_labels"), " ").alias("votes"), F.col("sent_len").cast("long").alias("sent_len"))


@query(r"""WITH w AS (SELECT item_id AS doc_id, unnest(string_split(text, ' ')) AS source, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM benchmark),
c AS (SELECT *, replace(source, 'e', 'a') AS replacement, (85 + pos % 14) / 100 AS confidence FROM w),
g AS (SELECT doc_id, source, replacement, max(confidence) AS confidence, min(pos) AS pos FROM c WHERE length(source) >= 3 AND confidence >= 0.9 AND source <> replacement AND regexp_full_match(source, '\p{L}+') AND source = lower(source) AND regexp_full_match(replacement, '\p{L}+') AND replacement = lower(replacement) GROUP BY ALL)
SELECT doc_id, source, replacement, confidence, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, replacement) AS rank FROM g) WHERE rank <= 12""")
def ranked_suggestions(t):
    words = t("benchmark").select(F.col("item_id").alias("doc_id"), F.posexplode(F.split("text", " ")).alias("pos", "source"))
    found = words.withColumn("replacement", F.replace("source", F.lit("e"), F.lit("a"))).withColumn("confidence", (85 + F.col("pos") % 14) / F.lit(100))
    return lexnorm.suggestions(found).select("doc_id", "source", "replacement", "confidence", F.col("rank").cast("long").alias("rank"))


SPANS_SQL = """x AS (SELECT conv_id, turn, role, text, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS e FROM conversations),
y AS (SELECT conv_id, e - length(text) AS b, e, text FROM x WHERE turn % 3 <> 1)"""


@query(f"""WITH {SPANS_SQL}, z AS (SELECT *, CASE WHEN lag(e) OVER (PARTITION BY conv_id ORDER BY b, e) = b THEN 0 ELSE 1 END AS o FROM y),
r AS (SELECT *, sum(o) OVER (PARTITION BY conv_id ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS g FROM z)
SELECT conv_id, min(b)::BIGINT AS "begin", max(e)::BIGINT AS "end", string_agg(text, '' ORDER BY b, e) AS text FROM r GROUP BY conv_id, g""")
def merged_spans(t):
    end = F.sum(F.length("text")).over(Window.partitionBy("conv_id").orderBy("turn"))
    spans = t("conversations").withColumn("end", end).where("turn % 3 <> 1")
    return lexnorm.merged_spans(spans.select("conv_id", (F.col("end") - F.length("text")).alias("begin"), "end", "text"), "conv_id")


@query("""WITH v AS (SELECT vec_id, label, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) AS z, label AS v1, (vec_id % 4)::INT AS v2, CASE WHEN vec_id % 3 = 0 THEN -1 ELSE label END AS v3 FROM embeddings),
r AS (SELECT vec_id, unnest([{'v': v1, 'w': 1 / (1 + exp(-(0.1 * z + 0.5)))}, {'v': v2, 'w': 1 / (1 + exp(-(0.2 * z)))}, {'v': v3, 'w': 1 / (1 + exp(-(0.3 * z - 0.5)))}]) AS x FROM v),
m AS (SELECT vec_id, x.v AS v, sum(x.w) AS mass, count(*) AS n FROM r WHERE x.v <> -1 GROUP BY ALL),
b AS (SELECT vec_id, sum(n) AS fired, sum(mass) AS total, max(mass) AS mass, arg_max(v, mass) AS v FROM m GROUP BY vec_id),
p AS (SELECT vec_id, v, (mass + (fired - total) / 16 + 1e-5) / (fired + 16 * 1e-5) AS p FROM b)
SELECT vec_id, CASE WHEN p >= 0.5 THEN v ELSE -1 END AS label_pred, round(p, 4) AS probability FROM p""")
def rule_attention(t):
    e = t("embeddings")
    votes = F.array(F.col("label"), (F.col("vec_id") % 4).cast("int"), F.when(F.col("vec_id") % 3 == 0, lexnorm.ABSTAIN).otherwise(F.col("label")))
    found = lexnorm.attended(e.select("vec_id", "embedding", votes.alias("votes")), "votes", "embedding", [[w] * 64 for w in (0.1, 0.2, 0.3)], [0.5, 0.0, -0.5], 16)
    return found.select("vec_id", "label_pred", F.round("probability", 4).alias("probability"))


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def downsampled_documents(t):
    """A sampling operator: the number of rows is its feature."""
    return lexnorm.downsampled(t("documents"), "doc_id", 100, seed=7).select("doc_id", "lang")


@query(f"SELECT doc_id, {BARE} AS text, true AS augmented FROM documents UNION ALL SELECT doc_id, text, false FROM documents")
def unaccented_augmentation(t):
    return lexnorm.with_unaccented(t("documents").select("doc_id", "text"), "text")


# --- hints and the choice of sentences

@query("""WITH run AS (SELECT c_name AS s, 'trades_in_' || lower(c_mktsegment) AS relation, n_name AS o, md5('0' || chr(31) || c_name || chr(31) || 'trades_in_' || lower(c_mktsegment) || chr(31) || n_name) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT relation, arg_min(s, k) AS s, arg_min(o, k) AS o FROM run GROUP BY relation),
k AS (SELECT DISTINCT 'trades_in_' || lower(c_mktsegment) AS relation, 'the segment is ' || c_mktsegment AS definition FROM customer),
w AS (SELECT s_suppkey AS doc_id, unnest(['trades_in_machinery', 'trades_in_building', 'unknown']) AS relation, unnest(CASE WHEN s_suppkey % 2 = 0 THEN [0, 1, 2] ELSE [2, 1, 0] END) AS pos FROM supplier),
l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, relation || ': ' || definition || ' Example: [' || s || ', ' || relation || ', ' || o || ']' AS line FROM w JOIN k USING (relation) JOIN e USING (relation))
SELECT doc_id, string_agg(n || '. ' || line, chr(10) ORDER BY n) AS hint FROM l GROUP BY doc_id""")
def refinement_hints(t):
    named = lambda c: F.concat(F.lit("trades_in_"), F.lower(c))
    run = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("s"), named("c_mktsegment").alias("p"), F.col("n_name").alias("o"))
    schema = t("customer").select(named("c_mktsegment").alias("relation"), F.concat(F.lit("the segment is "), "c_mktsegment").alias("definition")).distinct()
    order = [F.lit("trades_in_machinery"), F.lit("trades_in_building"), F.lit("unknown")]
    even = F.col("s_suppkey") % 2 == 0
    rows = t("supplier").select(F.col("s_suppkey").alias("doc_id"), F.when(even, F.array(*order[:1])).otherwise(F.array(*order[:0:-1])).alias("before"), F.when(even, F.array(*order)).otherwise(F.array(*order[:1])).alias("retrieved"))
    return hints.relation_hints(rows, schema, run)


@query()
def relation_covering_documents(t):
    """Documents in order whose capitalised words no chosen one before holds; held against the plain walk in the tests."""
    return hints.first_sentences(t("documents").select(F.col("doc_id").alias("pos"), native.spans(F.col("text"), native.CAPITALISED).alias("relations")))


# --- samples for a retriever

@query("""WITH r AS (SELECT s_suppkey AS row_id, s_name || ' of ' || n_name AS sentence, s_name AS s, n_name AS o, 'rel_' || s_suppkey % 23 AS r1, 'rel_' || s_suppkey % 5 AS r2 FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT DISTINCT row_id, relation, 'meaning ' || row_id AS definition FROM (SELECT row_id, unnest([r1, r2, 'rel_0']) AS relation FROM r)),
t AS (SELECT relation, definition, row_number() OVER (PARTITION BY relation ORDER BY md5('0' || chr(31) || row_id || chr(31) || relation)) - 1 AS number FROM g),
c AS (SELECT relation, count(*) AS nd FROM g GROUP BY 1), n AS (SELECT relation, nd, row_number() OVER (ORDER BY md5('0' || chr(31) || relation)) - 1 AS number, count(*) OVER () AS total FROM c),
p AS (SELECT row_id, CASE WHEN r1 = r2 THEN [r1] ELSE [r1, r2] END AS pos, ('0x' || substr(md5('0' || chr(31) || row_id), 1, 8))::BIGINT AS start FROM r),
o AS (SELECT row_id, relation, nd, len(pos) AS np, row_number() OVER (PARTITION BY row_id ORDER BY (number - start % total + total) % total) AS k FROM p JOIN n ON NOT list_contains(pos, relation)),
h AS (SELECT row_id, relation, k, ('0x' || substr(md5('0' || chr(31) || row_id || chr(31) || k), 1, 8))::BIGINT % nd AS number FROM o WHERE k <= 2 AND k <= np)
SELECT row_id, k::INT AS k, sentence, p.pos[k] || ': meaning ' || row_id AS positive, h.relation || ': ' || t.definition AS negative, p.pos[k] AS positive_relation, h.relation AS negative_relation, array_to_string(list_transform(list_filter([r1, r2], lambda x: x = p.pos[k]), lambda x: s || ', ' || x || ', ' || o), '; ') AS triples
FROM h JOIN t USING (relation, number) JOIN p USING (row_id) JOIN r USING (row_id)""")
def retriever_samples(t):
    """One sentence a supplier; its third triple isn't in the sentence, so its relation is no positive for that reason."""
    s = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    rel = lambda k: F.concat(F.lit("rel_"), (F.col("s_suppkey") % k).cast("string"))
    of = lambda r, o="n_name": F.array(F.col("s_name"), r, F.col(o))
    meaning = F.concat(F.lit("meaning "), F.col("s_suppkey").cast("string"))
    known = F.map_from_entries(F.transform(F.array_distinct(F.array(rel(23), rel(5), F.lit("rel_0"))), lambda r: F.struct(r, meaning)))
    rows = s.withColumn("absent", F.lit("nowhere")).select(F.col("s_suppkey").alias("row_id"), F.concat_ws(" of ", "s_name", "n_name").alias("sentence"), F.array(of(rel(23)), of(rel(5)), of(F.lit("rel_0"), "absent")).alias("triples"), known.alias("definitions"))
    found = retriever.retriever_samples(rows)
    return found.withColumn("triples", F.array_join(F.transform("positive_triples", lambda x: F.array_join(x, ", ")), "; ")).drop("positive_triples")


@query("WITH x AS (SELECT doc_id, ('0x' || substr(md5('5' || chr(31) || doc_id), 1, 8))::BIGINT / 4294967296.0 AS u FROM documents) SELECT doc_id, CASE WHEN u < 0.75 THEN 'train' WHEN u < 0.875 THEN 'test' ELSE 'valid' END AS split FROM x")
def split_documents(t):
    return retriever.split_shares(t("documents").select("doc_id"), "doc_id", {"train": 0.75, "test": 0.125, "valid": 0.125}, seed=5)


# --- rounds of generation and review

@query()
def reviewed_benchmark(t):
    """Benchmark texts through rounds of an offline writer and reviewer; held against a record-after-record walk in the tests."""
    rows = t("benchmark").select(F.col("item_id").cast("string").alias("record_id"), "text")
    found = agents.adaptive_rounds(rows, agents.offline_writer, agents.offline_reviewer)[0]
    return found.select(F.col("record_id").cast("long").alias("item_id"), "status", "action", "text", "attempts", "error")


# --- canonical relations

@query(f"WITH {STAR_SQL} SELECT graph_id AS doc_id, pos, s, CASE WHEN p = 'lives_in' THEN p WHEN pos % 8 = 1 THEN 'trades_in' WHEN pos % 8 = 3 THEN 'works_for' END AS p, o, CASE WHEN p = 'lives_in' THEN 'known' WHEN pos % 8 IN (1, 3) THEN 'chosen' ELSE 'unmatched' END AS how FROM gold")
def canonical_relations(t):
    """Answers stand in for a model's: by place A, B, the letter after the options, and none."""
    rows = gold_pred(t)[0].withColumnRenamed("graph_id", "doc_id")
    response = F.element_at(F.array(*[F.lit(x) for x in ("A", "B. works_for", "C", "")]), F.floor(F.col("pos") % 8 / 2).cast("int") + 1)
    answers = rows.select("doc_id", "pos", F.array(F.lit("trades_in"), F.lit("works_for")).alias("options"), response.alias("response"))
    return canonical.canonicalised(rows, rows.sparkSession.createDataFrame([("lives_in",)], "relation string"), answers)


# --- the chain from texts to a graph

NAMES_SQL = r"""w AS (SELECT doc_id, text, regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ][\p{L}]*') AS w FROM documents),
t AS (SELECT doc_id, text, i - 1 AS pos, w[i] AS s, w[i + 1] AS o FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w))"""


def _texts(t) -> DataFrame:
    return t("documents").select(F.col("doc_id").cast("string").alias("index"), F.col("text").alias("input_text"))


def _schema(t) -> DataFrame:
    """Relations with definitions: one that names follow in, and one for each region."""
    regions = t("region").select(F.concat(F.lit("located_in_"), F.lower(F.translate("r_name", " ", "_"))).alias("relation"), F.concat(F.lit("a place lies in "), "r_name").alias("definition"))
    return regions.unionByName(regions.sparkSession.createDataFrame([("followed_by", "one name followed by another")], "relation string, definition string"))


@query(f"WITH {NAMES_SQL} SELECT CASE WHEN s <= o THEN 'followed_by' END AS p, count(*) AS n FROM t GROUP BY 1")
def refined_graph(t):
    """Every document through extraction, definition, canonicalisation and one round of refinement: an unknown relation that
    no schema relation shares a word with is lost."""
    stages, _ = edc.refined(_texts(t), _schema(t), edc.offline, iterations=1)
    return stages.select(F.explode("canonical").alias("t")).groupBy("t.p").agg(F.count("*").alias("n"))


@query(f"WITH {NAMES_SQL} SELECT DISTINCT CASE WHEN s <= o THEN 'followed_by' ELSE 'comes_after' END AS relation FROM t UNION SELECT 'followed_by' UNION SELECT 'located_in_' || lower(replace(r_name, ' ', '_')) FROM region")
def enriched_schema(t):
    """The schema after a run that adds the relations that nothing fits."""
    return edc.refined(_texts(t), _schema(t), edc.offline, enrich=True)[1].select("relation")


def _records(t) -> DataFrame:
    return t("documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("source_id"))


@query(f"SELECT doc_id::VARCHAR AS record, CASE WHEN {BARE_TEXT} = '' THEN 'skipped_empty_after_cleanup' ELSE 'ready' END AS status, true AS numbered, true AS named, true AS fits FROM documents")
def prepared_documents(t):
    """Segments of every document: status, parts numbered from 1, ids that name their part where there are several, the limit."""
    rows = corpus.prepared(_records(t)).withColumn("record", F.substring_index("id", "::part", 1))
    n = F.count("part")
    named = F.bool_and(F.col("part").isNull() | (F.col("id") == F.col("record")) | (F.col("id") == F.concat("record", F.lit("::part"), F.col("part").cast("string"))))
    fits = F.bool_and((F.length("clean_text") <= 1800) | F.contains("clean_text", F.lit("$")) | ~F.rlike("clean_text", F.lit(r"(?U)\s")))
    return rows.groupBy("record").agg(F.min("status").alias("status"), ((n == 0) | ((F.max("part") == n) & (F.min("part") == 1))).alias("numbered"), named.alias("named"), fits.alias("fits"))


@query(rf"""WITH {NAMES_SQL}, d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\s+([,.;:!?])', '\1', 'g'), '\s+', ' ', 'g')) AS text FROM documents WHERE NOT regexp_matches(text, '[$&<>#\\\[]') AND length(text) <= 1800),
x AS (SELECT DISTINCT d.doc_id, d.text, s, o FROM t JOIN d USING (doc_id))
SELECT CASE WHEN contains(text, s || ' ' || o) THEN 'YES' ELSE 'NO' END AS label, count(*) AS n FROM x GROUP BY 1""")
def verified_triples(t):
    """Triples of the documents that are one segment without markup (there SQL can state the cleanup), each once, judged by their text."""
    records = _records(t).where(~F.rlike("text", F.lit(r"[$&<>#\\\[]")) & (F.length("text") <= 1800))
    segments = cut(corpus.prepared(records))
    schema = _schema(t).unionByName(t("region").sparkSession.createDataFrame([("comes_after", "one name comes after another")], "relation string, definition string"))
    stages, _ = edc.refined(corpus.model_inputs(segments), schema, edc.offline)
    return corpus.judged(segments, stages).groupBy("label").agg(F.count("*").alias("n"))


# --- checkpoints and runs

@query(f"WITH {SAVED_SQL}, l AS (SELECT source_path, index, arg_max(status, ord) AS status FROM saved GROUP BY 1, 2), c AS (SELECT conv_id, count(*) AS n, count(status) AS done, count(*) FILTER (status = 'accepted') AS a, count(*) FILTER (status = 'model_failed') AS f FROM conversations LEFT JOIN l ON conv_id = source_path AND turn = index GROUP BY 1) SELECT count(*) AS books, sum(n)::BIGINT AS chunks, sum(done)::BIGINT AS processed, count(*) FILTER (n = done) AS completed, sum(a)::BIGINT AS accepted, 0::BIGINT AS dropped, 0::BIGINT AS review_rejected, sum(f)::BIGINT AS model_failed FROM c")
def run_summary(t):
    return review.run_summary(_chunks(t), _saved(t))


@query("SELECT conv_id AS source_path, turn AS index, CASE WHEN turn % 4 = 1 THEN 'status' WHEN turn % 4 = 2 THEN 'saved before' WHEN turn % 4 = 3 THEN 'another source or offsets' END AS reason FROM conversations WHERE turn % 4 > 0")
def checkpoint_errors(t):
    """Turns as saved chunks: each fourth is sound, the others are saved with an unknown status, saved again after success, or again with other offsets."""
    c = t("conversations").select(F.col("conv_id").alias("source_path"), F.col("turn").alias("index"), F.md5("role").alias("source_sha256"), F.lit(0).alias("start"), F.length("text").alias("end"), "text", (F.col("turn") % 4).alias("k"))
    first = c.withColumn("ord", F.lit(1)).withColumn("status", F.when(F.col("k") == 1, "done").when(F.col("k") == 2, "accepted").otherwise("model_failed"))
    again = c.where("k > 1").withColumn("ord", F.lit(2)).withColumn("status", F.lit("accepted")).withColumn("end", F.when(F.col("k") == 3, F.col("end") + 1).otherwise(F.col("end")))
    return review.checkpoint_errors(first.unionByName(again)).select("source_path", "index", "reason")


@query(f"""WITH {STAR_SQL}, d AS (SELECT DISTINCT graph_id, o FROM gold), n AS (SELECT graph_id, o, lead(o) OVER w AS up, first(o) OVER w AS low FROM d WINDOW w AS (PARTITION BY graph_id ORDER BY o)),
x AS (SELECT graph_id, pos, s, p, o, coalesce(up, CASE WHEN low <> o THEN low END) AS z FROM gold JOIN n USING (graph_id, o))
SELECT graph_id, pos, 'Is this true: ' || s || ' ' || p || ' ' || o || '?' AS instruction, 'Yes, this is true.' AS output, true AS label FROM x UNION ALL SELECT graph_id, pos, 'Is this true: ' || s || ' ' || p || ' ' || z || '?', 'No, this is not true.', false FROM x WHERE z IS NOT NULL""")
def labelled_instructions(t):
    return triples.labelled_questions(gold_pred(t)[0])


@query(f"WITH {STAR_SQL}, k AS (SELECT graph_id, list(DISTINCT p ORDER BY p) AS r, list(DISTINCT e ORDER BY e) AS e FROM (SELECT graph_id, p, unnest([s, o]) AS e FROM gold) GROUP BY 1) SELECT graph_id, array_to_string(r, '|') AS relations, array_to_string(e, '|') AS entities FROM k")
def graph_vocabulary(t):
    """Distinct relations and entities of every graph, sorted."""
    # one graph
    per = gold_pred(t)[0].groupBy("graph_id").agg(F.collect_list(F.struct("s", "p", "o")).alias("oie"))
    relations, entities = edc.relations_and_entities(F.col("oie"))
    return per.select("graph_id", F.array_join(relations, "|").alias("relations"), F.array_join(entities, "|").alias("entities"))


@query(f"WITH {STAR_SQL}, x AS (SELECT graph_id, pos, s, p, o, chr(39) AS q FROM gold WHERE pos % 7 > 0) SELECT graph_id, '[' || string_agg('[' || q || s || q || ', ' || q || p || q || ', ' || q || o || q || ']', ', ' ORDER BY pos) || ']' AS value FROM x GROUP BY 1")
def printed_graphs(t):
    """Canonical triples of every graph in printed form; those without a relation are left out."""
    p = F.when(F.col("pos") % 7 > 0, F.col("p"))
    # one graph
    per = gold_pred(t)[0].groupBy(F.col("graph_id").alias("index")).agg(F.array_sort(F.collect_list(F.struct("pos", "s", p.alias("p"), "o"))).alias("canonical"))
    return sinks.canon_lines(per).select(F.col("index").alias("graph_id"), "value")


@query("SELECT label, count(*) AS n FROM (SELECT NOT (contains(h, 'no') OR contains(h, 'false') OR contains(h, 'không') OR contains(h, 'sai')) AS label FROM (SELECT lower(substr(text, 1, 15)) AS h FROM conversations)) GROUP BY 1")
def judge_label_short(t):
    return t("conversations").select(native.short_judgment(F.col("text")).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderpriority AS word, n AS meaning FROM orders JOIN (SELECT '1-URGENT' AS w, 'at once' AS n UNION ALL SELECT '5-LOW', 'some day') d ON o_orderpriority = w")
def dictionary_lookup(t):
    """Words that a dictionary has, with their meaning; the others are for a model."""
    known = t("orders").sparkSession.createDataFrame([("1-URGENT", "at once"), ("5-LOW", "some day")], "word string, meaning string")
    hits, _ = triples.found_or_missing(t("orders").select("o_orderkey", F.col("o_orderpriority").alias("word")), known)
    return hits.select("o_orderkey", "word", "meaning")
