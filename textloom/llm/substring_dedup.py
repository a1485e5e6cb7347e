"""Substring deduplication over super-k-mers of words.

A window is `size` consecutive words. The minimiser of a window is the smallest hash among its runs of `m` words;
consecutive windows of a document that share a minimiser form a super-k-mer, which travels as one packed string to the
minimiser's bucket. There windows are sorted and counted exactly: equal hashes are confirmed byte for byte. Every
window whose words start anywhere else too covers its words in its own document.

Traffic. A slice of documents folds equal super-k-mers before it sends them (copies cover themselves on the spot), and
packs what goes to one bucket into one compressed blob. Buckets follow the input's size, so each is a few megabytes.
A bucket over a multiple of the mean load is hot (a passage in a great many documents): its windows travel singly,
dealt by the hash of the whole window instead, which spreads them evenly and keeps equal windows together. A task sends
each single window once, however many of its slices hold it (as far as it remembers them: `REMEMBERED`; more are sent
again, with the same result). Hot buckets are those over `hot` times the mean and over a `HOT_BUCKETS`-th of the whole
load, so there are never more than `HOT_BUCKETS` of them to broadcast.

Defined results: a null text has no words; texts under `size` words lose nothing. Rows are judged by place, so a
repeated row is a copy. Null and repeated ids: intervals are matched by id and text, which are equal only where the
result is. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpoint, estimated_bytes, shuffle_partitions, text_key
from textloom.llm.words import SPACES, Words, mix, slices, span_hashes, split, split_bytes

SIZE, RUN = 35, 5
BUCKET_BYTES = 3 << 20
#: A bucket is hot from this many times the mean load.
HOT = 3.0
#: The most hot buckets there can be: four megabytes of numbers.
HOT_BUCKETS = 1 << 20
#: Single windows that a task remembers.
REMEMBERED = 50_000


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for each i with a whole range, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def super_kmers(w: Words, size: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, one past the last, minimiser) of each super-k-mer, by word places; and hashes of all words."""
    h = span_hashes(w.data, w.starts, w.ends)
    n = len(h)
    if n < size:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64), h
    places = np.arange(n - run + 1)
    low = sliding_min(span_hashes(h, places, places + run), size - run + 1)
    stop = w.first[1:][w.owner()]
    valid = np.arange(len(low)) + size <= stop[: len(low)]
    before = np.zeros(len(low), bool)
    before[1:] = valid[:-1] & (low[1:] == low[:-1])
    begin = np.flatnonzero(valid & ~before)
    after = np.ones(len(low), bool)
    after[:-1] = ~(valid[1:] & (low[1:] == low[:-1]))
    end = np.flatnonzero(valid & after) + 1
    return begin, end, low[begin], h


def bucket_of(minimiser: np.ndarray, buckets: int) -> np.ndarray:
    return (minimiser >> np.uint64(11)) % np.uint64(buckets)


def _pack(entries: list[tuple[int, int, int, bytes]]) -> bytes:
    """entries: key_id, key_text, place of the first word (-1: no answer is wanted), words joined by spaces."""
    head = np.array([(a, b, c, len(d)) for a, b, c, d in entries], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(entries)).tobytes() + head.tobytes() + b"".join(e[3] for e in entries))


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.frombuffer(raw, np.int64, 4 * n, 8).reshape(n, 4), raw[8 + 32 * n :]


def _send(keyed: DataFrame, size: int, run: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """bucket, payload (entries for the bucket) or, where payload is null, key_id, key_text, begin, end of covered words."""
    shared = keyed.sparkSession.sparkContext.broadcast(hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value  # sorted
        sent: dict[bytes, list] = {}  # single windows of this task: key_id, key_text, place of the first, whether that is covered
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                w = split(part.column("text"))
                begin, end, low, h = super_kmers(w, size, run)
                if not len(begin):
                    continue
                to = bucket_of(low, buckets)
                singly = hot[np.minimum(np.searchsorted(hot, to), len(hot) - 1)] == to if len(hot) else np.zeros(len(to), bool)
                n_whole = int((~singly).sum())
                if singly.any():
                    n = (end - begin)[singly]
                    one = np.repeat(begin[singly] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    begin, end = np.concatenate([begin[~singly], one]), np.concatenate([end[~singly], one + 1])
                    to = np.concatenate([to[~singly], bucket_of(span_hashes(h, one, one + size, 5), buckets)])
                raw, at = w.joined()
                doc = np.searchsorted(w.first, begin, "right") - 1
                ids, texts = (part.column(c).to_numpy() for c in ("key_id", "key_text"))
                place = begin - w.first[doc]
                words = [raw[a:b] for a, b in zip(at[begin].tolist(), (at[end + size - 1] - 1).tolist())]
                seen: dict[bytes, int] = {}
                copies = np.zeros(len(words), bool)
                for i, s in enumerate(words):
                    j = seen.setdefault(s, i)
                    if j != i:
                        copies[i] = copies[j] = True
                known: list[int] = []
                late: list[tuple[int, int, int]] = []
                if n_whole < len(words):
                    for s, i in seen.items():
                        if i < n_whole:
                            continue
                        first = sent.get(s)
                        if first is not None:
                            known.append(i)
                            copies[i] = True
                            if not first[3]:
                                first[3] = True
                                late.append((first[0], first[1], first[2]))
                        elif len(sent) < REMEMBERED:
                            sent[s] = [int(ids[doc[i]]), int(texts[doc[i]]), int(place[i]), bool(copies[i])]
                send = np.setdiff1d(np.fromiter(seen.values(), np.int64, len(seen)), np.array(known, np.int64))
                order = send[np.argsort(to[send], kind="stable")]
                cuts = np.flatnonzero(np.diff(to[order].astype(np.int64))) + 1
                out_to, blobs = [], []
                for group in np.split(order, cuts) if len(order) else ():
                    rows = group.tolist()
                    blobs.append(_pack([(int(ids[doc[i]]), int(texts[doc[i]]), -1 if copies[i] else int(place[i]), words[i]) for i in rows]))
                    out_to.append(int(to[rows[0]]))
                none = [None] * len(blobs)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((out_to, blobs, none, none, none, none), DEALT.types)], schema=DEALT)
                if late:
                    a, b, c = (np.array(x, np.int64) for x in zip(*late))
                    yield pa.RecordBatch.from_arrays([pa.array((mix(a.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)), pa.nulls(len(a), pa.binary()), pa.array(a), pa.array(b), pa.array(c), pa.array(c + size)], schema=DEALT)
                some = np.flatnonzero(copies)
                if len(some):
                    a, b = _merge(doc[some], place[some], (place + (end - begin) + size - 1)[some])
                    d, a, b = a[:, 0], a[:, 1], b
                    spread = (mix(ids[d].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)  # by id: copies differ in nothing else
                    yield pa.RecordBatch.from_arrays([pa.array(spread), pa.nulls(len(d), pa.binary()), pa.array(ids[d]), pa.array(texts[d]), pa.array(a), pa.array(b)], schema=DEALT)

    return keyed.select("key_id", "key_text", "text").mapInArrow(deal, "bucket int, payload binary, key_id long, key_text long, begin long, end long")


def _merge(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping ranges of a document as one: ((document, begin), end)."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    # ends of ranges of one super-k-mer sequence grow with their begins but for repeats; a running maximum holds in general
    shift = np.int64(1) << 40
    top = np.maximum.accumulate(end + doc * shift)
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (begin[1:] + doc[1:] * shift > top[:-1])]
    cut = np.flatnonzero(fresh)
    last = np.r_[cut[1:] - 1, len(doc) - 1]
    return np.stack([doc[cut], begin[cut]], axis=1), top[last] - doc[cut] * shift


DEALT = pa.schema([("bucket", pa.int32()), ("payload", pa.binary()), ("key_id", pa.int64()), ("key_text", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
COVERED = pa.schema([("key_id", pa.int64()), ("key_text", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def count_windows(heads: np.ndarray, raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, first word, one past the last) of runs covered by windows that occur more than once in the bucket.

    Windows are sorted by hash; neighbours with one hash are compared byte for byte.
    """
    lengths = heads[:, 3]
    offsets = np.zeros(len(heads) + 1, np.int64)
    np.cumsum(lengths + 1, out=offsets[1:])
    data = np.full(offsets[-1], 0x20, np.uint8)
    inside = np.ones(offsets[-1], bool)
    inside[offsets[1:] - 1] = False
    data[inside] = np.frombuffer(raw, np.uint8)
    w = split_bytes(data, offsets, SPACES)
    h = span_hashes(w.data, w.starts, w.ends)
    count = np.diff(w.first) - size + 1
    entry = np.repeat(np.arange(len(heads)), count)
    first = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + w.first[entry]
    key = span_hashes(h, first, first + size, 3)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    twice = np.zeros(len(entry), bool)
    if len(same):
        text = data.tobytes()
        a, b = order[same], order[same + 1]
        spans = [(w.starts[first[x]].tolist(), w.ends[first[x] + size - 1].tolist()) for x in (a, b)]
        equal = np.fromiter((text[p:q] == text[r:s] for p, q, r, s in zip(*spans[0], *spans[1])), bool, len(same))
        if equal.all():
            twice[a] = twice[b] = True
        else:  # different windows share a hash: group the runs with that hash by content
            groups: dict[bytes, list[int]] = {}
            for i in np.unique(np.concatenate([a, b])).tolist():
                groups.setdefault(text[w.starts[first[i]] : w.ends[first[i] + size - 1]], []).append(i)
            for members in groups.values():
                if len(members) > 1:
                    twice[members] = True
    hit = np.flatnonzero(twice & (heads[entry, 2] >= 0))
    if not len(hit):
        return (np.zeros(0, np.int64),) * 3
    at = first[hit] - w.first[entry[hit]]
    left, right = _merge(entry[hit], at, at + size)
    return left[:, 0], left[:, 1], right


def covered(keyed: DataFrame, size: int = SIZE, run: int = RUN, hot: float = HOT) -> DataFrame:
    """key_id, key_text, begin, end: ranges of words to remove (ranges of a document may overlap)."""
    spark = keyed.sparkSession
    parts = shuffle_partitions(spark)
    buckets = int(min(1 << 30, max(2 * parts, estimated_bytes(keyed, BUCKET_BYTES * parts * 2) * 6 // BUCKET_BYTES)))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                w = split(part.column("text"))
                begin, end, low, h = super_kmers(w, size, run)
                # equal super-k-mers of a slice count once, as they travel once
                _, one = np.unique(span_hashes(h, begin, end + size - 1, 9), return_index=True) if len(begin) else (None, np.zeros(0, int))
                keys, place = np.unique(bucket_of(low[one], buckets).astype(np.int64), return_inverse=True)
                for k, n in zip(keys.tolist(), np.bincount(place, (end - begin + size)[one], len(keys)).tolist()):
                    total[k] = total.get(k, 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], ["bucket", "words"])

    loads = keyed.select("text").mapInArrow(load, "bucket int, words long").groupBy("bucket").agg(F.sum("words").alias("words"))
    heavy = _heavy(loads, hot, buckets)
    dealt = _send(keyed, size, run, buckets, heavy).repartition(parts, "bucket").sortWithinPartitions("bucket")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now = None

        def answer(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
            if blobs:
                heads, raws = zip(*map(_unpack, blobs))
                head = np.concatenate(heads)
                entry, a, b = count_windows(head, b"".join(raws), size)
                place = head[entry, 2]
                yield pa.RecordBatch.from_arrays([pa.array(head[entry, 0]), pa.array(head[entry, 1]), pa.array(place + a), pa.array(place + b)], schema=COVERED)

        for batch in batches:
            direct = pc.is_null(batch.column("payload"))
            yield pa.RecordBatch.from_arrays([batch.filter(direct).column(c) for c in COVERED.names], schema=COVERED)
            rest = batch.filter(pc.invert(direct))
            for bucket, payload in zip(rest.column("bucket").to_pylist(), rest.column("payload").to_pylist()):
                if bucket != now:
                    yield from answer(held)
                    held, now = [], bucket
                held.append(payload)
        yield from answer(held)

    return dealt.mapInArrow(sort, "key_id long, key_text long, begin long, end long")


def _heavy(loads: DataFrame, hot: float, buckets: int, most: int = HOT_BUCKETS) -> np.ndarray:
    """Buckets over hot times the mean load and a most-th of the whole load, sorted: fewer than most of them."""
    loads = checkpoint(loads)
    total = loads.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    return np.sort(loads.where(F.col("words") > max(hot * total / buckets, total / most)).select("bucket").toArrow()["bucket"].to_numpy().astype(np.uint64))


def remove(docs: DataFrame, size: int = SIZE, run: int = RUN, hot: float = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row: the words that no repeated window covers, joined by spaces."""
    keyed = text_key(docs)
    ranges = covered(keyed, size, run, hot).groupBy("key_id", "key_text").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    joined = keyed.join(ranges, ["key_id", "key_text"], "left").select("doc_id", "text", "ranges")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = split(part.column("text"))
                raw, at = w.joined()
                lists = part.column("ranges")
                flat_ranges = lists.flatten()
                a, b = (flat_ranges.field(i).to_numpy() for i in (0, 1))
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), n)
                edge = np.zeros(len(w.starts) + 1, np.int64)
                np.add.at(edge, w.first[doc] + a, 1)
                np.add.at(edge, w.first[doc] + b, -1)
                gone = np.cumsum(edge[:-1]) > 0
                sums = np.zeros(len(gone) + 1, np.int64)
                np.cumsum(gone, out=sums[1:])
                n_words, n_removed = np.diff(w.first), sums[w.first[1:]] - sums[w.first[:-1]]
                texts = []
                for i in range(part.num_rows):
                    x, y = int(w.first[i]), int(w.first[i + 1])
                    if not n_removed[i]:
                        texts.append(raw[at[x] : max(at[x], at[y] - 1)])
                        continue
                    turn = np.flatnonzero(np.diff(np.r_[True, gone[x:y], True].astype(np.int8)))
                    texts.append(b" ".join(raw[at[x + p] : at[x + q] - 1] for p, q in turn.reshape(-1, 2).tolist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")


def op2(docs: DataFrame) -> DataFrame:
    return remove(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
