"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64 bits over lower-cased 3-word shingles. Two fingerprints that differ in at most `radius` bits agree
on at least m - radius of m bands of the 64 bits (pigeonhole), so each distinct fingerprint goes to one bucket for every
choice of that many bands. m follows the number of distinct fingerprints (`bands_for`): keys widen as the table grows, so
that a bucket of evenly spread fingerprints keeps about `LOAD` of them while their copies stay few. A bucket stores its fingerprints vertically, one bit plane per bit; a query is compared with 64 of them per word
operation: planes that differ are added into bitwise counters by carry-save steps, and a block is abandoned once every
lane has passed the radius. A bucket yields a spanning forest of its links, not all pairs; no link is lost to the
components. A bucket over `chunk` fingerprints is dealt as pairs of chunks to separate tasks.

Defined results: text without words (null, empty) has fingerprint zero, linked like any other; ids may repeat (rows of
one text are one fingerprint) or be null (a null id never names a component unless all its members are null).
Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpoint, shuffle_partitions
from textloom.llm.components import components
from textloom.llm.words import slices, split

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Fingerprints of a bucket that one task compares with each other.
CHUNK = 512
#: Fingerprints that an evenly filled bucket should hold at most.
LOAD = 64
#: Buckets up to this size are compared together, a lane for each pair.
SMALL = 64
_FULL = np.uint64((1 << 64) - 1)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes."""
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """Columns of keep (doc_id) and fingerprint as a bigint with the same bits, for every row."""
    names = keep or ["doc_id"]
    rows = docs.select(*dict.fromkeys([*names, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh64_intdigest
        for batch in batches:
            for part in slices(batch):
                w = split(part.column("text"), lower=True)
                raw, at = w.joined()
                out = np.zeros(part.num_rows, np.uint64)
                for i, (a, b) in enumerate(zip(w.first.tolist(), w.first[1:].tolist())):
                    if b > a:
                        size = min(shingle, b - a)
                        begin, end = at[a : b - size + 1].tolist(), (at[a + size : b + 1] - 1).tolist()
                        out[i] = fingerprint(np.array([hashed(raw[x:y], seed) for x, y in zip(begin, end)], np.uint64))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(out.view(np.int64))], [*names, "fingerprint"])

    fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{fields}, fingerprint long")


def bit_planes(prints: np.ndarray, bits: int = 64) -> np.ndarray:
    """(bits, blocks) words: bit k of lane j of block b is bit k of fingerprint 64 b + j."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros(blocks * 64, np.uint64)
    padded[: len(prints)] = prints
    rows = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # lane, bit
    packed = np.packbits(rows.reshape(blocks, 64, 64).transpose(2, 0, 1).reshape(64, -1), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")[:bits]


def within(planes: np.ndarray, n: int, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the query, places of the fingerprints at radius or fewer differing bits), for queries that have any.

    Saturating counters: bits c0, c1, ... and `over` for lanes past the radius; queries advance together, a row each.
    """
    width = max(1, int(radius).bit_length())
    blocks = planes.shape[1]
    valid = np.full(blocks, _FULL)
    if n % 64:
        valid[-1] = np.uint64((1 << (n % 64)) - 1)
    step = max(1, (1 << 16) // max(1, blocks))
    for lo in range(0, len(queries), step):
        q = queries[lo : lo + step]
        counters = np.zeros((width, len(q), blocks), np.uint64)
        over = np.broadcast_to(~valid, (len(q), blocks)).copy()
        live = np.arange(len(q))
        for k in range(planes.shape[0]):
            bit = ((q[live] >> np.uint64(k)) & np.uint64(1)).astype(bool)
            carry = planes[k][None] ^ np.where(bit, _FULL, np.uint64(0))[:, None]
            for c in range(width):  # carry-save increment of every lane's counter
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry | _above(counters, radius)
            if k >= 8 and k % 8 == 0:
                open_rows = (over != _FULL).any(axis=1)
                if not open_rows.all():  # a query whose every block has passed the radius is abandoned
                    live, counters, over = live[open_rows], counters[:, open_rows], over[open_rows]
                    if not len(live):
                        break
        for row, i in enumerate(live.tolist()):
            lanes = np.flatnonzero(np.unpackbits((~over[row]).astype("<u8").view(np.uint8), bitorder="little"))
            if len(lanes):
                yield lo + i, lanes


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is larger than the radius (never, if the radius fills the counter's bits)."""
    more = np.zeros(counters.shape[1:], np.uint64)
    equal = np.full(counters.shape[1:], _FULL)
    for c in range(len(counters) - 1, -1, -1):
        if not radius >> c & 1:
            more |= equal & counters[c]
            equal &= ~counters[c]
        else:
            equal &= counters[c]
    return more


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Whether left[i] and right[i] differ in at most radius bits: one lane per pair, counted plane by plane."""
    planes = bit_planes(left ^ right)
    counters = np.zeros((max(1, int(radius).bit_length()), planes.shape[1]), np.uint64)
    over = np.zeros(planes.shape[1], np.uint64)
    for plane in planes:
        carry = plane
        for c in range(len(counters)):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over |= carry | _above(counters, radius)
        if (over == _FULL).all():
            break
    return np.unpackbits((~over).view(np.uint8), bitorder="little")[: len(left)].astype(bool)


def within_small(prints: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each of many small buckets that lie one after another."""
    rank = np.arange(len(prints)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    after = np.repeat(sizes, sizes) - 1 - rank
    left = np.repeat(np.arange(len(prints)), after)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    near = close_pairs(prints[left], prints[right], radius) if len(left) else np.zeros(0, bool)
    return prints[left[near]], prints[right[near]]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all that links between left and right connect (right empty: within left)."""
    alone = not len(right)
    right = left if alone else right
    nodes = np.unique(np.concatenate([left, right]))
    group = np.arange(len(nodes))
    place, mine = np.searchsorted(nodes, right), np.searchsorted(nodes, left)
    edges: list[tuple[int, int]] = []
    for i, lanes in within(bit_planes(right), len(right), left, radius):
        x = int(mine[i])
        others, one = np.unique(group[place[lanes]], return_index=True)
        for other, lane in zip(others.tolist(), lanes[one].tolist()):
            if other != group[x]:
                group[group == other] = group[x]
                edges.append((x, int(place[lane])))
    at = np.array(edges, np.int64).reshape(-1, 2)
    return nodes[at[:, 0]], nodes[at[:, 1]]


def bands_for(n: int, radius: int = RADIUS, load: int = LOAD) -> int:
    """The fewest bands with which n evenly spread fingerprints fill a bucket with at most load of them on average.

    With radius 3: 4 bands (4 keys of 16 bits) up to 4 million, 5 (10 of about 26) up to 3 thousand million, 6 (20 of
    32) up to 270 thousand million.
    """
    bands = radius + 1
    while bands < 64 and n > load << min((64 // bands) * (bands - radius), 60):
        bands += 1
    return bands


def masks(bands: int, radius: int = RADIUS) -> list[int]:
    """The bits of each choice of bands - radius of the bands, as signed 64-bit numbers."""
    cuts = [64 * b // bands for b in range(bands + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in map(sum, itertools.combinations(one, bands - radius))]


def links(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, bands: int | None = None) -> DataFrame:
    """(u, v): links among distinct fingerprints (column fingerprint, bigint), enough to connect each component.

    bands: as `bands_for` says for the number of fingerprints, unless given. Only a bucket that is fuller than evenly
    spread fingerprints make it is dealt as pairs of chunks.
    """
    chosen = masks(bands or bands_for(prints.count(), radius), radius)
    keyed = prints.select(F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")) for m in chosen])).alias("band", "key"), "fingerprint")
    load = keyed.groupBy("band", "key").agg(F.count("*").alias("n"))
    large = load.where(F.col("n") > chunk).select("band", "key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    # at most a chunk-th of the keyed rows are large buckets: Spark chooses the join
    dealt = keyed.join(large, ["band", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int"))
    # a bucket of one chunk meets itself, chunk i of several meets every chunk
    pairs = dealt.select("band", "key", "fingerprint", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    pairs = pairs.select(F.xxhash64("band", "key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("task"), "band", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "fingerprint")
    placed = pairs.repartition(shuffle_partitions(prints.sparkSession), "task").sortWithinPartitions("task", "band", "key", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def settle(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            cols = {c: t.column(c).to_numpy() for c in ("band", "key", "i", "j", "chunk", "fingerprint")}
            turn = np.zeros(t.num_rows, bool)
            for c in ("band", "key", "i", "j"):
                turn[1:] |= cols[c][1:] != cols[c][:-1]
            prints = cols["fingerprint"].view(np.uint64)
            sizes = np.diff(np.r_[0, np.flatnonzero(turn), t.num_rows])
            small = (sizes <= SMALL) & (cols["i"] == cols["j"])[np.cumsum(sizes) - sizes]
            yield within_small(prints[np.repeat(small, sizes)], sizes[small], radius)
            ends = np.cumsum(sizes)
            for a, b in zip((ends - sizes)[~small].tolist(), ends[~small].tolist()):
                if b - a > 1:
                    own = cols["chunk"][a:b] == cols["i"][a]
                    if cols["i"][a] == cols["j"][a]:
                        yield forest(prints[a:b], prints[:0], radius)
                    elif own.any() and not own.all():
                        yield forest(prints[a:b][own], prints[a:b][~own], radius)

        def out(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            u, v = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            last = tuple(t.column(c)[t.num_rows - 1].as_py() for c in ("band", "key", "i", "j")) if t.num_rows else ()
            n = t.num_rows
            if n:
                whole = np.ones(n, bool)
                for c, x in zip(("band", "key", "i", "j"), last):
                    whole &= t.column(c).to_numpy() == x
                cut = n - int(whole.sum())
                yield out(list(settle(t.slice(0, cut))) if cut else [])
                rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield out(list(settle(rest)))

    return placed.mapInArrow(compare, "u long, v long")


def near_duplicates(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Of each distinct fingerprint: component_id (smallest doc_id reachable) and root, its component's own name.

    Components of unlike texts may share a component_id where ids repeat or are null; never a root.
    """
    distinct = checkpoint(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    linked = components(links(distinct.select("fingerprint"), radius, chunk))
    joined = distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("component", "fingerprint"))
    lowest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(lowest, "root").select("fingerprint", "component_id", "root")


def op7(docs: DataFrame) -> DataFrame:
    prints = checkpoint(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    found = prints.join(near_duplicates(prints), "fingerprint", "left")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
