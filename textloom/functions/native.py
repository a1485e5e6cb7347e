"""Column expressions that stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Protected spans, numbers and capitalised words as the reference protocol defines them.
MATH = r"(?s)\$\$.*?\$\$|\$[^$]*\$"
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
CAPITALISED = r"\p{Lu}[\p{L}\p{M}]*"


def _accents() -> dict[str, str]:
    """Latin letters and what is left of them without their marks, by Unicode's own decomposition; d with a stroke has none."""
    found = {"đ": "d", "Đ": "D"}
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        whole = unicodedata.normalize("NFD", chr(code))
        if len(whole) > 1 and whole[0].isascii() and all(unicodedata.combining(c) for c in whole[1:]):
            found[chr(code)] = whole[0]
    return found


ACCENTS = _accents()
ACCENTED, PLAIN = "".join(ACCENTS), "".join(ACCENTS.values())


def spans(text: Column, pattern: str) -> Column:
    """All matches, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r]+", " "))


def strict_judgment(response: Column) -> Column:
    """YES, NO or UNSURE where that is the whole answer, else UNSURE."""
    word = F.upper(F.regexp_extract(response, r"(?i)^\s*(YES|NO|UNSURE)\s*[.!]?\s*$", 1))
    return F.when(word == "", "UNSURE").otherwise(F.coalesce(word, F.lit("UNSURE")))


def prefix_judgment(response: Column, chars: int = 100) -> Column:
    """False if `no` or `false` occurs in the first characters (also inside words), or without a response."""
    head = F.lower(F.substring(response, 1, chars))
    return F.coalesce(~(F.contains(head, F.lit("no")) | F.contains(head, F.lit("false"))), F.lit(False))


# What an answer of either language holds near its start when it denies.
DENIALS = ("no", "false", "không", "sai")


def short_judgment(response: Column, chars: int = 15) -> Column:
    """As prefix_judgment, for short answers of two languages."""
    head = F.lower(F.substring(response, 1, chars))
    denied = F.lit(False)
    for word in DENIALS:
        denied = denied | F.contains(head, F.lit(word))
    return F.coalesce(~denied, F.lit(False))


def scored_judgment(response: Column) -> tuple[Column, Column]:
    """(verdict, confidence) of a classifier's answer such as `Yes, this is true. (confidence: 0.912)`; null where it has neither."""
    word = F.lower(F.regexp_extract(response, r"^\s*(?i:(yes|no))\b", 1))
    number = F.regexp_extract(response, r"\(confidence: ([0-9]*\.?[0-9]+)\)\s*$", 1)
    return F.when(word != "", word == "yes"), F.when(number != "", number.cast("double"))


def relation_definitions(text: Column) -> Column:
    """Entries (relation, definition) of lines with a colon; relation `Answer` is left out; of one relation the last stays."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("relation"), F.trim(F.substr(x, F.locate(":", x) + 1)).alias("definition")))
    pairs = F.filter(pairs, lambda p: p["relation"] != "Answer")
    return F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["relation"] == p["relation"]))


def triple_question(s: Column, p: Column, o: Column) -> Column:
    return F.concat(F.lit("Is this true: "), F.concat_ws(" ", s, p, o), F.lit("?"))


def cells_question(cells: Column) -> Column:
    """Of three cells a question; two have no question mark in the protocol; of others there is none."""
    joined = F.concat(F.lit("Is this true: "), F.array_join(cells, " "))
    return F.when(F.size(cells) == 3, F.concat(joined, F.lit("?"))).when(F.size(cells) == 2, joined)


def edge_text(s: Column, p: Column, o: Column, quirk: bool = False) -> Column:
    """An edge as text: its cells joined by semicolons. quirk: the sign-by-sign form of the protocol's own scores, in which
    every sign of the list's printed form stands alone."""
    if not quirk:
        return F.concat_ws(";", s, p, o)
    printed = F.concat(F.lit("['"), F.concat_ws("', '", s, p, o), F.lit("']"))
    return F.array_join(F.split(printed, ""), ";")


def strip_accents(text: Column) -> Column:
    """Latin letters without their marks, whether composed or followed by combining ones."""
    return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), "[\u0300-\u036f]", "")


def sentence_case(text: Column) -> Column:
    """First letter upper, the rest lower, no blank before `,` and `.`, a final stop."""
    low = F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))
    tight = F.replace(F.replace(low, F.lit(" ,"), F.lit(",")), F.lit(" ."), F.lit("."))
    return F.when(F.endswith(tight, F.lit(".")), tight).otherwise(F.concat(tight, F.lit(".")))


def book_id(relative_path: Column) -> Column:
    return F.concat(F.lit("book:"), F.substring(F.sha2(relative_path, 256), 1, 16))


def numbered_id(parent: Column, kind: str, number: Column) -> Column:
    """Ids of what a parent is cut into: chunk_ with six digits, seg_ with five, part_ with three."""
    return F.concat(parent, F.lit(f"::{kind}_"), F.lpad(number.cast("string"), {"chunk": 6, "seg": 5, "part": 3}[kind], "0"))


def part_id(record_id: Column, part: Column, parts: Column) -> Column:
    return F.when(parts == 1, record_id).otherwise(F.concat(record_id, F.lit("::part"), part.cast("string")))


def dot(a: Column, b: Column) -> Column:
    """Inner product, summed from the left in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def choice_block(candidates: Column) -> Column:
    """Lettered lines, the last of them `None of the above`."""
    with_none = F.concat(candidates, F.array(F.lit("None of the above")))
    return F.array_join(F.transform(with_none, lambda c, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), c)), "\n")


def normalise_for_scoring(text: Column) -> Column:
    """Camel case split, underscores to blanks, white space collapsed, lower case, a trailing bracket left off."""
    out = F.regexp_replace(text, r"(\p{Ll})(\p{Lu})", "$1 $2")
    out = F.lower(collapse_space(F.replace(out, F.lit("_"), F.lit(" "))))
    return strip_accents(F.regexp_replace(out, r" \([^()]*\)$", ""))
