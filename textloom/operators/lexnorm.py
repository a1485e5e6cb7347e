"""Lexical normalisation on arrays of word pieces: alignment, suggestions, spans, weak labels. All of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.native import dot, strip_accents
from textloom.functions.segment import split_udf

# The special pieces of the protocol, the label of an abstaining rule and the smoothing of its votes.
MASK, SPACE, FIRST, LAST = "<mask>", "<space>", "<s>", "</s>"
ABSTAIN = -1
SMOOTHING = 1e-5


def with_ends(pieces: Column) -> Column:
    return F.concat(F.array(F.lit(FIRST)), pieces, F.array(F.lit(LAST)))


def without_ends(pieces: Column) -> Column:
    """Entries (place, piece) of the pieces that are no ends; places are those of the input."""
    marked = F.transform(pieces, lambda x, i: F.struct(i.alias("place"), x.alias("piece")))
    return F.filter(marked, lambda x: ~x["piece"].isin(FIRST, LAST))


def _fitted(pieces: Column, size: Column, filler: str) -> Column:
    """Exactly size pieces: cut, or filled up."""
    return F.concat(F.slice(pieces, 1, size), F.array_repeat(F.lit(filler), F.greatest(size - F.size(pieces), F.lit(0))))


def aligned(rows: DataFrame, source: str = "source", target: str | None = "target", rules: tuple[str, ...] = ()) -> DataFrame:
    """Columns source, target and rules hold a list of pieces for each word, from whatever tokenizer.

    Adds input_pieces, output_pieces (if there is a target), align_index (the word of each piece, ends left out),
    weak_labels (for each piece one vote a rule) and sent_len. A word takes as many pieces as the longer of its source and target; rules
    are cut or filled to that.
    """
    src = F.col(source)
    wide = F.transform(src, lambda x: F.size(x)) if target is None else F.zip_with(src, F.col(target), lambda s, t: F.greatest(F.size(s), F.size(t)))
    out = rows.withColumn("_wide", wide)
    fit = lambda c, filler: F.flatten(F.zip_with(F.col(c), "_wide", lambda x, n: _fitted(x, n, filler)))
    out = out.withColumn("input_pieces", with_ends(fit(source, MASK)))
    if target is not None:
        out = out.withColumn("output_pieces", with_ends(fit(target, SPACE)))
    votes = [with_ends(fit(r, SPACE)) for r in rules]
    weak = F.transform("input_pieces", lambda x: F.array().cast("array<string>"))
    for v in votes:  # transposed by one pass a rule
        weak = F.zip_with(weak, v, lambda have, x: F.concat(have, F.array(x)))
    return (
        out.withColumn("align_index", F.flatten(F.transform("_wide", lambda n, i: F.array_repeat(i, n))))
        .withColumn("weak_labels", weak).withColumn("sent_len", F.size("input_pieces")).drop("_wide")
    )


def suggestions(found: DataFrame, least: float = 0.9, most: int = 12) -> DataFrame:
    """found (doc_id, pos, source, replacement, confidence): per document the surest of each distinct pair, at most `most` in order of first sight.

    Words of three lower-case letters or more, replaced by other lower-case letters, with the least confidence.
    """
    letters = lambda c: F.col(c).rlike(r"^\p{L}+$") & (F.col(c) == F.lower(c))
    good = found.where((F.length("source") >= 3) & (F.col("confidence") >= least) & letters("source") & letters("replacement") & (F.col("source") != F.col("replacement")))
    pairs = good.groupBy("doc_id", "source", "replacement").agg(F.max("confidence").alias("confidence"), F.min("pos").alias("pos"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "replacement")))
    return ranked.where(F.col("rank") <= most)


def suggestion_status(parts_skipped: Column, n_suggestions: Column) -> Column:
    return F.when(parts_skipped > 0, "partial").when(n_suggestions > 0, "suggested").otherwise("unchanged")


def merged_spans(spans: DataFrame, by: str) -> DataFrame:
    """spans (by, begin, end, text): those that begin where the one before ends become one."""
    w = Window.partitionBy(by).orderBy("begin", "end")
    opens = F.coalesce((F.col("begin") != F.lag("end").over(w)).cast("int"), F.lit(1))
    runs = spans.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("begin", "end", "text")))
    return runs.groupBy(by, "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text")).drop("_run")


def attended(rows: DataFrame, votes: str, hidden: str, embedding: list[list[float]], bias: list[float], labels: int, least: float = 0.5) -> DataFrame:
    """Adds label_pred and probability: the rules' votes (one each, ABSTAIN for none) weighed by attention to the hidden state.

    A rule's weight is the logistic of hidden . embedding + bias; the weight its vote lacks to one goes to all labels
    evenly. Labels without a vote share the even part alone, so only those voted for are held: their probability is
    (mass + even + smoothing) / (fired + labels * smoothing). Below `least`, or without a vote, the label is ABSTAIN; of
    equal ones the smallest stands.
    """
    weight = F.array(*[1 / (1 + F.exp(-(dot(F.col(hidden), F.lit(e)) + b))) for e, b in zip(embedding, bias)])
    cast = F.filter(F.zip_with(F.col(votes), weight, lambda v, w: F.struct(v.alias("v"), w.alias("w"))), lambda x: x["v"] != ABSTAIN)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["w"])
    out = rows.withColumn("_cast", cast)
    fired, kinds = F.size("_cast"), F.array_distinct(F.transform("_cast", lambda x: x["v"]))
    mass = F.transform(kinds, lambda v: F.struct(total(F.filter("_cast", lambda x: x["v"] == v)).alias("mass"), (-v).alias("order")))
    out = out.withColumn("_best", F.array_max(mass))
    p = (F.coalesce(F.col("_best.mass"), F.lit(0.0)) + (fired - total(F.col("_cast"))) / labels + SMOOTHING) / (fired + labels * SMOOTHING)
    out = out.withColumn("probability", p)
    return out.withColumn("label_pred", F.when((fired > 0) & (F.col("probability") >= least), -F.col("_best.order")).otherwise(ABSTAIN)).drop("_cast", "_best")


def without_silent(rows: DataFrame, labels: str) -> DataFrame:
    """Rows with at least one label that is not ABSTAIN."""
    return rows.where(F.exists(labels, lambda x: x != ABSTAIN))


def downsampled(rows: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, chosen by a digest of the id: the same ones on every run."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")), id_col).limit(n)


def with_unaccented(rows: DataFrame, text: str) -> DataFrame:
    """Every row twice: its text without accents (augmented true), and as it is."""
    return rows.withColumn(text, strip_accents(F.col(text))).withColumn("augmented", F.lit(True)).unionByName(rows.withColumn("augmented", F.lit(False)))


def nonstandard_spans(rows: DataFrame, by: str, pieces: str, flags: str) -> DataFrame:
    """rows (by, pieces: texts of the tokens in order, flags: whether each is non-standard) -> merged spans of the flagged ones.

    Offsets are code points of the joined pieces; spans that touch are one (by, begin, end, text).
    """
    place = lambda xs, i: F.aggregate(F.slice(xs, 1, i), F.lit(0), lambda a, x: a + F.length(x))
    marked = F.transform(F.arrays_zip(F.col(pieces).alias("piece"), F.col(flags).alias("flag")), lambda x, i: F.struct(x["piece"].alias("text"), x["flag"].alias("flag"), place(F.col(pieces), i).alias("begin")))
    found = rows.select(by, F.explode(F.filter(marked, lambda x: x["flag"])).alias("x")).select(by, "x.begin", (F.col("x.begin") + F.length("x.text")).alias("end"), "x.text")
    return merged_spans(found, by)


def word_confidence(pieces: Column) -> Column:
    """Of a word whose pieces have a confidence each (a list), the least one."""
    return F.array_min(pieces)


def likeliest(probabilities: Column, k: int) -> Column:
    """The k likeliest places of a list of probabilities, (place, probability), ties by place."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("order"), i.alias("place")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda x: F.struct(x["place"].alias("place"), (-x["order"]).alias("probability")))


def best_epoch(epochs: DataFrame) -> DataFrame:
    """The epoch of the highest performance, of equal ones the last: epochs (epoch, performance)."""
    return epochs.agg(F.max_by("epoch", F.struct("performance", "epoch")).alias("epoch"), F.max("performance").alias("performance"))


#: Tokens that a suggester takes at once, and the characters of a part where a text has more signs than LONG.
MOST_TOKENS, LONG, PART = 768, 500, 500


def suggested(texts: DataFrame, suggest: Column, tokens: Column, round_trip: Column) -> DataFrame:
    """texts (id, text) -> id, suggestions and suggestion_status.

    suggest: the model's list of (source, replacement, confidence) for column `part`; tokens and round_trip: how many
    tokens `part` has, and whether they spell it again. A text that is too long is asked for in parts; parts that still
    don't fit are skipped: status partial, or skipped where no part is left. Else suggested or unchanged.
    """
    fits = (tokens <= MOST_TOKENS) & round_trip
    whole = texts.withColumn("part", F.col("text")).withColumn("fits", fits)
    parts = whole.withColumn("part", F.explode(F.when(F.col("fits") | (F.length("text") <= LONG), F.array("text")).otherwise(split_udf("text", F.lit(PART)))))
    asked = parts.withColumn("fits", fits).withColumn("found", F.when(F.col("fits"), suggest).otherwise(F.array()))
    numbered = asked.select("id", "fits", F.explode_outer(F.when(F.size("found") > 0, F.col("found"))).alias("x")).select("id", "fits", "x.source", "x.replacement", "x.confidence", F.monotonically_increasing_id().alias("pos"))
    kept = suggestions(numbered.where("source is not null").select(F.col("id").alias("doc_id"), "pos", "source", "replacement", "confidence"))
    # at most twelve of a text
    lists = kept.groupBy(F.col("doc_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "source", "replacement", "confidence"))), lambda x: F.struct(x["source"].alias("source"), x["replacement"].alias("replacement"), x["confidence"].alias("confidence"))).alias("suggestions"))
    counts = asked.groupBy("id").agg(F.count("*").alias("n"), F.count(F.when(~F.col("fits"), 1)).alias("skipped"))
    both = counts.join(lists, "id", "left")
    status = F.when(F.col("n") == F.col("skipped"), "skipped").otherwise(suggestion_status(F.col("skipped"), F.coalesce(F.size("suggestions"), F.lit(0))))
    return both.select("id", F.coalesce("suggestions", F.array().cast(both.schema["suggestions"].dataType)).alias("suggestions"), status.alias("suggestion_status"))
