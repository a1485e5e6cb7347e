"""Vectorised word and span handling over Arrow text columns.

Texts are laid end to end in one byte array, each followed by a separator, so that words, hashes and
windows of a whole slice of documents come out of a few numpy passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE, _SPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of lower-cased `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """data: bytes of all texts, each with one separator after it; offsets: where texts begin.

    Word j is data[starts[j]:ends[j]]; text i has words first[i] to first[i + 1].
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words, each followed by one space, and where each begins (one more entry for the end)."""
        at = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts + 1, out=at[1:])
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.starts] += 1
        edge[self.ends + 1] -= 1
        packed = self.data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
        packed[at[1:] - 1] = 0x20
        return packed.tobytes(), at


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each followed by a newline, and offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    joined = pc.binary_join_element_wise(texts, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    _, offs, data = joined.buffers()
    offsets = np.frombuffer(offs, np.int64)[joined.offset : joined.offset + len(joined) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    data, offsets = flat(texts)
    return split_bytes(LOWER[data] if lower else data, offsets, separators)


def split_bytes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    sep = separators[data]
    before = np.ones(len(sep), bool)
    before[1:] = sep[:-1]
    starts, ends = np.flatnonzero(~sep & before), np.flatnonzero(sep & ~before)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch | pa.Table, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of about limit bytes of text, at least one row each; all rows, in order."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 5 << 20:
            _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of values[starts:ends] for many spans, by prefix sums of powers modulo 2**64.

    values: bytes, or 64-bit numbers such as hashes of words.
    """
    if values.dtype == np.uint8:
        values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 257 * seed)) * _SPREAD)[values]
    else:
        values = values ^ np.uint64(seed)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers("up", _BASE, len(values)), out=sums[1:])
    out = (sums[ends] - sums[starts]) * _powers("down", _INVERSE, len(values) + 1)[starts]
    return mix(out ^ (ends - starts).astype(np.uint64) * _SPREAD)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one span of each distinct content, for each span its place among those).

    A second hash guards the first; where they disagree the seed moves on.
    """
    for seed in range(8):
        h, guard = span_hashes(data, starts, ends, 2 * seed), span_hashes(data, starts, ends, 2 * seed + 1)
        _, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        if np.array_equal(guard[index][inverse], guard):
            return index, inverse
    raise RuntimeError("no hash seed tells these spans apart")
