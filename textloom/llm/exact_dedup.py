"""Exact deduplication by Patricia tries.

Texts are equal when their bytes are, after each run of `[\\x20\\x09-\\x0D]` became one space. Rows are dealt by length and
content hash; each partition inserts full byte strings into a compressed radix trie whose terminal nodes hold the
smallest identifier and the number of rows. A trie over its memory limit spills the largest subtrees below its first fork,
to the task's own scratch files, until it is half empty, and takes each up again, as a trie of its own, once the rest is
done; strings that share a long beginning share a spilled subtree's path, not its memory.

Copies within a batch are folded before the shuffle, so a hot text reaches its partition once per batch rather than
once per row.

Defined results: null counts as empty text; of equal texts the smallest doc_id stays (null ids after all others; rows
that share both text and id are one group in which each of them has kept = true only if its id is the smallest, so
repeated rows of the kept id are all marked kept). Very long texts are inserted whole. Empty tables give empty results;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import SPACES, flat, slices

TRIE_BYTES = 96 << 20
#: Reckoned for a node besides its label.
NODE_BYTES = 200
#: Stands for a null id among others.
NO_ID = (1 << 63) - 1


class Node:
    __slots__ = ("label", "children", "value", "file")

    def __init__(self, label: bytes):
        self.label, self.children, self.value, self.file = label, {}, None, None

    def size(self) -> int:
        size, left = 0, [self]
        while left:
            node = left.pop()
            size += len(node.label) + NODE_BYTES
            left.extend(node.children.values())
        return size


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Patricia:
    """A compressed radix trie: string -> (smallest id, rows, payload). held: its own estimate of its bytes."""

    def __init__(self, limit: int = TRIE_BYTES):
        self.root, self.limit, self.held, self.spills = Node(b""), limit, 0, 0

    def insert(self, key: bytes, owner: int, rows: int, payload: object = None) -> None:
        node, at = self.root, 0
        while at < len(key) and node.file is None:
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held += len(child.label) + NODE_BYTES
            n = _common(child.label, key[at : at + len(child.label)])
            if n < len(child.label):
                fork = Node(child.label[:n])
                fork.children[child.label[n]] = child
                child.label = child.label[n:]
                node.children[key[at]] = fork
                self.held += NODE_BYTES
                child = fork
            node, at = child, at + n
        if node.file is not None:
            pickle.dump((key[at:], owner, rows, payload), node.file)
            return
        old = node.value
        node.value = (owner, rows, payload) if old is None else (min(owner, old[0]), rows + old[1], payload)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        fork = self.root
        while len(live := [c for c in fork.children.values() if c.file is None]) == 1:
            fork = live[0]
        sizes = sorted(((c.size(), k) for k, c in fork.children.items() if c.file is None), reverse=True)
        for size, k in sizes:
            if self.held <= self.limit // 2:
                break
            top = fork.children[k]
            top.file = tempfile.TemporaryFile()
            for path, value in self._walk(top):
                pickle.dump((path[len(top.label) :], *value), top.file)
            top.children, top.value = {}, None
            self.held -= size - len(top.label) - NODE_BYTES
            self.spills += 1

    @staticmethod
    def _walk(top: Node, spilled: list | None = None) -> Iterator[tuple[bytes, tuple]]:
        """Terminal strings and values below top; to spilled go (string so far, file) of the subtrees on file."""
        left = [(top, b"")]
        while left:
            node, path = left.pop()
            path += node.label
            if node.file is not None and spilled is not None:
                spilled.append((path, node.file))
            if node.value is not None:
                yield path, node.value
            left.extend((child, path) for child in node.children.values())

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """Terminal strings and values; spilled subtrees afterwards, one at a time under the same limit."""
        spilled: list = []
        yield from self._walk(self.root, spilled)
        self.root, self.held = Node(b""), 0
        while spilled:
            prefix, file = spilled.pop()
            again = Patricia(self.limit)
            with file:
                file.seek(0)
                while True:
                    try:
                        again.insert(*pickle.load(file))
                    except EOFError:
                        break
            for key, value in again.items():
                yield prefix + key, value


def normalised(texts: pa.Array) -> Iterator[bytes]:
    """Each run of white space as one space."""
    data, offsets = flat(texts)
    sep = SPACES[data]
    keep = ~sep
    keep[1:] |= ~sep[:-1]
    if len(offsets) > 1:
        keep[offsets[:-1]] = True
        keep[offsets[1:] - 1] = False  # the separator that flat() added
    # a text that ends in white space keeps that one
    raw = np.where(sep, np.uint8(0x20), data)[keep].tobytes()
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    cuts = at[offsets].tolist()
    for a, b in zip(cuts, cuts[1:]):
        yield raw[a:b]


def owners(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """n_bytes, sha256, keep_id, group_size of each distinct text."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                found: dict[bytes, list[int]] = {}
                for doc_id, text in zip(part.column("doc_id").to_pylist(), normalised(part.column("text"))):
                    doc_id = NO_ID if doc_id is None else doc_id
                    have = found.get(text)
                    if have is None:
                        found[text] = [doc_id, 1]
                    else:
                        have[0], have[1] = min(have[0], doc_id), have[1] + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(t) for t in found], pa.int64()), pa.array([hashlib.sha256(t).digest() for t in found], pa.binary()), pa.array(found.keys(), pa.binary()), pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                    ["n_bytes", "sha256", "bytes", "owner", "rows"],
                )

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia(limit)
        for batch in batches:
            for digest, raw, owner, rows in zip(*(batch.column(c).to_pylist() for c in ("sha256", "bytes", "owner", "rows"))):
                trie.insert(raw, owner, rows, digest)
        out: list[tuple] = []
        for raw, (owner, rows, digest) in trie.items():
            out.append((len(raw), digest, None if owner == NO_ID else owner, rows))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RESULT.types)], schema=RESULT)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RESULT.types)], schema=RESULT)

    folded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(fold, "n_bytes long, sha256 binary, bytes binary, owner long, rows long")
    dealt = folded.repartition("n_bytes", "sha256")
    return dealt.mapInArrow(insert, "n_bytes long, sha256 binary, keep_id long, group_size long")


RESULT = pa.schema([("n_bytes", pa.int64()), ("sha256", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, sha256 of the normalised text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                texts = list(normalised(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["doc_id", "n_bytes", "sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, sha256 binary")


def op8(docs: DataFrame) -> DataFrame:
    found = digests(docs).join(owners(docs), ["n_bytes", "sha256"], "left")
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256"))
