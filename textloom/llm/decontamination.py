"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark windows.

Texts and items are lower-cased (A-Z) and reduced to words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. Every window of 13
item words (an item of fewer, but not none, as a whole) is a pattern; one automaton scans each document once. Each
occurrence marks its words, and their offsets are mapped to the original text.

The benchmark is read to the driver in shards whose patterns stay under a byte limit, so what is broadcast has a
proven bound; a benchmark within the limit is one automaton and one scan, a larger one is scanned shard by shard and
the hits of a document are united.

Defined results: a null text has no words and no hits; null items and items without words have no windows; an id or
item_id may repeat or be null (each row by its own text; a null item_id counts as an item of that name only in the
count). Empty tables give empty results, or no hits. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpoint
from textloom.llm.words import LOWER, NON_ALNUM, flat, slices

WINDOW = 13
#: Bytes of pattern text in one automaton.
SHARD_BYTES = 8 << 20
_TRANSLATE = bytes(0x20 if NON_ALNUM[LOWER[b]] else int(LOWER[b]) for b in range(256))
_BUILT: dict[str, object] = {}


def normalised_words(text: str | None) -> list[str]:
    return [w for w in (text or "").encode().translate(_TRANSLATE).decode().split(" ") if w]


def patterns(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> dict[str, tuple[int, list[str | None]]]:
    """window text -> (its words, ids of the items that have it)."""
    out: dict[str, tuple[int, list[str | None]]] = {}
    for item, text in items:
        words = normalised_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            ids = out.setdefault(" ".join(words[i : i + size]), (size, []))[1]
            if item not in ids:
                ids.append(item)
    return out


def automaton(found: dict[str, tuple[int, list[str | None]]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for text, value in found.items():
        a.add_word(f" {text} ", value)
    if found:
        a.make_automaton()
    return a


def scan(a: ahocorasick.Automaton, text: str) -> tuple[int, list[tuple[int, int]], set[str | None]]:
    """(words, word ranges hit, items): text holds normalised words, each between single spaces, from the first on."""
    ranges, items = [], set()
    spaces = None
    for end, (size, ids) in a.iter(text) if len(a) else ():
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 0x20)
        last = int(np.searchsorted(spaces, end))  # words before this space
        ranges.append((last - size, last))
        items.update(ids)
    return text.count(" ") - 1 if len(text) > 1 else 0, ranges, items


def _normalised(part: pa.RecordBatch) -> list[str]:
    """All texts of a slice as ' word word ... '; one translation of the whole byte buffer."""
    data, offsets = flat(part.column("text"))
    raw = data.tobytes().translate(_TRANSLATE)
    out = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        words = b" ".join(raw[a:b].split())  # after the translation 0x20 is the only ASCII space left
        out.append(f" {words.decode()} " if words else " ")
    return out


def _shards(benchmark: DataFrame, window: int, limit: int) -> Iterator[dict]:
    """Patterns in shards: items in order of a hash, cut where the text of a shard would pass the limit."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).where("text is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] * window
    count = max(1, -(-size // limit))
    for k in range(count):
        some = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        got = some.toArrow()
        yield patterns(sorted(zip(got["item_id"].to_pylist(), got["text"].to_pylist()), key=lambda r: (r[0] or "", r[1])), window)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Columns of keep, n_words, spans (start and end of each hit word range, in code points of the original), words
    (word ranges, united), items, for every row of docs."""
    names = keep or ["doc_id", "text"]
    spark = docs.sparkSession
    spans = "array<struct<start:int,end:int>>"

    def run_with(shard, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, digest, found = shard.value
            if digest not in _BUILT:
                _BUILT.clear()
                _BUILT[digest] = automaton(found)
            a = _BUILT[digest]
            for batch in batches:
                for part in slices(batch):
                    n_words, words, items, at = [], [], [], []
                    olds = [None] * part.num_rows if first else list(zip(part.column("words").to_pylist(), part.column("items").to_pylist()))
                    texts = part.column("text")
                    for i, text in enumerate(_normalised(part)):
                        n, ranges, ids = scan(a, text)
                        if olds[i]:
                            ranges += [(r["start"], r["end"]) for r in olds[i][0]]
                            ids |= set(olds[i][1])
                        ranges = united(ranges)
                        n_words.append(n)
                        words.append([{"start": x, "end": y} for x, y in ranges])
                        items.append(sorted(ids, key=lambda v: (v is None, v or "")))
                        at.append(original(texts[i].as_py(), ranges) if ranges else [])
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(at, kind), pa.array(words, kind), pa.array(items, pa.list_(pa.string()))],
                        [*names, "n_words", "spans", "words", "items"],
                    )

        return run

    out = docs.select(*dict.fromkeys([*names, "text"]))
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    before = None
    for k, p in enumerate(_shards(benchmark, window, shard_bytes)):
        if before is not None:  # one shard is held at a time: its results are stored before the next is built
            if "text" not in names:
                raise ValueError("a benchmark of several shards needs text among the kept columns")
            out = checkpoint(out)
            before.destroy()
        before = spark.sparkContext.broadcast((k, hashlib.sha256(repr(sorted(p)).encode()).hexdigest(), p))
        out = out.mapInArrow(run_with(before, k == 0), f"{fields}, n_words long, spans {spans}, words {spans}, items array<string>")
    return out


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges as code-point offsets of the unnormalised text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sep = NON_ALNUM[np.minimum(np.where(codes < 128, LOWER[np.minimum(codes, 127)], 255), 255)]
    before = np.r_[True, sep[:-1]]
    after = np.r_[sep[1:], True]
    starts, ends = np.flatnonzero(~sep & before), np.flatnonzero(~sep & after) + 1
    return [{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in ranges]


def with_verdict(found: DataFrame) -> DataFrame:
    """n_hit, n_items, contaminated from the word ranges."""
    n_hit = F.aggregate("words", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["start"]).cast("long"))
    return found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op4(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = with_verdict(hits(docs.select("doc_id", "text"), benchmark))
    ids = F.array_join(F.filter("items", lambda x: x.isNotNull()), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")
