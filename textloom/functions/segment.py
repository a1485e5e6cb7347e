"""Formula-safe splitting, packing and offset-preserving chunks.

Places where a text may be cut are found once, in order, and looked up by position, so the work grows with the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain, zip_longest

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.clean import MATH, clean_text, keep_lines

# What parts paragraphs, the formulas of books, and the least limit of the reference protocol.
GAP = re.compile(r"\n[ \t]*\n(?:[ \t]*\n)*")
LINE_MATH = re.compile(r"\$\$.*?\$\$|(?<!\$)\$(?!\$)[^$\n]*\$(?!\$)", re.S)
LEAST = 100
_BLANK = re.compile(r"\s+")


class Places:
    """Runs of white space of a text (begin, end) and its formulas."""

    def __init__(self, text: str, formulas: re.Pattern[str], begin: int = 0, end: int | None = None):
        end = len(text) if end is None else end
        spans = [(begin + m.start(), begin + m.end()) for m in formulas.finditer(text[begin:end])]
        self.formula_begins, self.formula_ends = [a for a, _ in spans], [b for _, b in spans]
        runs = [m.span() for m in _BLANK.finditer(text, begin, end)]
        self.begins, self.ends = [a for a, _ in runs], [b for _, b in runs]

    def inside(self, at: int) -> bool:
        """Whether a formula begins before this place and ends after it."""
        i = bisect_left(self.formula_begins, at) - 1
        return i >= 0 and at < self.formula_ends[i]


def _limited(limit: int) -> int:
    if limit < LEAST:
        raise ValueError(f"the limit is at least {LEAST} characters")
    return limit


def _cut(text: str, places: Places, begin: int, end: int, limit: int) -> int:
    """Where a piece that begins here ends: after the last sentence in the second half of what fits, after the last white
    space that fits, after the first that doesn't, or at the end."""
    reach, blank = begin + limit + 1, None
    for k in range(bisect_left(places.begins, reach) - 1, -1, -1):
        at = min(places.ends[k], reach)
        if at <= begin:
            break
        if blank is not None and at - begin < limit // 2:
            break
        if places.inside(at):
            continue
        blank = at if blank is None else blank
        before = places.begins[k] - 1
        if at - begin >= limit // 2 and before >= begin and text[before] in ".!?":
            return at
    if blank is not None:
        return blank
    beyond = (e for e in places.ends[bisect_right(places.ends, begin + limit) :] if e <= end and not places.inside(e))
    return next(beyond, end)


def split_text(text: str, limit: int) -> list[str]:
    """Pieces of at most limit characters, unless one formula or word is longer, without white space around them."""
    _limited(limit)
    if len(text) <= limit:
        return [text] if text else []
    places, out = Places(text, MATH), []
    begin, end, trimmed = 0, len(text), len(text.rstrip())
    while end - begin > limit:
        at = _cut(text, places, begin, end, limit)
        out.append(text[begin:at].strip())
        run = bisect_right(places.begins, at) - 1
        begin, end = max(at, places.ends[run]) if run >= 0 else at, trimmed
    return [*out, text[begin:end]] if begin < end else out


def pack(markdown: str, limit: int) -> list[dict]:
    """Segments of a book: cleaned blocks of lines, split, joined by a blank line while they fit; with source lines."""
    lines, original = keep_lines(markdown).split("\n"), markdown.split("\n")
    full = [bool(line.strip()) for line in lines]
    begins = [i for i, x in enumerate(full) if x and not (i and full[i - 1])]
    ends = [i + 1 for i, x in enumerate(full) if x and not (i + 1 < len(full) and full[i + 1])]
    out: list[dict] = []
    for a, b in zip(begins, ends):
        for piece in split_text(clean_text("\n".join(lines[a:b])) or "", limit):
            if out and out[-1]["size"] + 2 + len(piece) <= limit:
                out[-1]["parts"].append(piece)
                out[-1].update(end_line=b, size=out[-1]["size"] + 2 + len(piece))
            else:
                out.append({"parts": [piece], "size": len(piece), "start_line": a + 1, "end_line": b})
    return [{"text": "\n\n".join(s["parts"]), "start_line": s["start_line"], "end_line": s["end_line"], "raw_text": "\n".join(original[s["start_line"] - 1 : s["end_line"]])} for s in out]


def _paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """What stands between blank lines, white space at the edges included, unless it is nothing else."""
    edges = [0, *(x for m in GAP.finditer(text) for x in m.span()), len(text)]
    return ((a, b) for a, b in zip(edges[::2], edges[1::2]) if not text[a:b].isspace() and a < b)


def _fitting(text: str, begin: int, end: int, limit: int) -> Iterator[tuple[int, int]]:
    """A paragraph cut at white space outside formulas, the last that fits or else the first there is."""
    if end - begin > limit:
        places = Places(text, LINE_MATH, begin, end)
        legal = [(a, b) for a, b in zip(places.begins, places.ends) if begin < a and b < end and not places.inside(a) and not places.inside(b)]
        starts, first = [a for a, _ in legal], 0
        while end - begin > limit and first < len(legal):
            at = max(first, bisect_right(starts, begin + limit) - 1)
            yield begin, legal[at][0]
            begin, first = legal[at][1], at + 1
    yield begin, end


def chunks(text: str, limit: int) -> list[tuple[int, int]]:
    """Half-open offsets: paragraphs, long ones cut, neighbours merged while they fit. With the gaps between them they are the text."""
    _limited(limit)
    out: list[tuple[int, int]] = []
    for a, b in (piece for span in _paragraphs(text) for piece in _fitting(text, *span, limit)):
        if out and b - out[-1][0] <= limit:
            a = out.pop()[0]
        out.append((a, b))
    return out


def assemble(text: str, done: list[tuple[int, int, str, str]]) -> str:
    """Results (start, end, status, text) in place of their chunks: accepted text replaces, dropped leaves, all else stays."""
    done = sorted(done)
    gaps = [text[a:b] for a, b in zip([0, *(d[1] for d in done)], [*(d[0] for d in done), len(text)])]
    bodies = [{"accepted": new, "dropped": ""}.get(status, text[a:b]) for a, b, status, new in done]
    out = "".join(chain.from_iterable(zip_longest(gaps, bodies, fillvalue="")))
    if any(status == "dropped" for _, _, status, _ in done):
        out = re.sub(r"\n(?:[ \t]*\n){2,}", "\n\n", out).strip("\n")
        return out + "\n" if text.endswith("\n") and out.strip() else out
    return out + "\n" if text.endswith("\n") and out and not out.endswith("\n") else out


@F.pandas_udf(T.ArrayType(T.StringType()))
def split_udf(texts: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([split_text(t, int(n)) if t is not None else None for t, n in zip(texts, limit)])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def chunks_udf(texts: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([[{"start": a, "end": b} for a, b in chunks(t, int(n))] if t is not None else None for t, n in zip(texts, limit)])


@F.pandas_udf(T.StringType())
def assemble_udf(texts: pd.Series, done: pd.Series) -> pd.Series:
    """done: lists of (start, end, status, text)."""
    return pd.Series([assemble(t, [(d["start"], d["end"], d["status"], d["text"]) for d in parts]) for t, parts in zip(texts, done)])


PACKED = "doc_id long, part int, text string, raw_text string, start_line int, end_line int"


def pack_books(batches: Iterator[pa.RecordBatch], limit: int = 1800) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text): doc_id, part, text, raw_text, start_line, end_line."""
    for books in batches:
        found = [(i, k, s) for i, t in zip(books.column("doc_id").to_pylist(), books.column("text").to_pylist()) for k, s in enumerate(pack(t or "", limit), 1)]
        columns = [pa.array([i for i, _, _ in found], pa.int64()), pa.array([k for _, k, _ in found], pa.int32())]
        columns += [pa.array([s[c] for _, _, s in found], kind) for c, kind in (("text", pa.string()), ("raw_text", pa.string()), ("start_line", pa.int32()), ("end_line", pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "text", "raw_text", "start_line", "end_line"])
