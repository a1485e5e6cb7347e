"""Language-model scoring with Brown class-based n-grams.

Every word has a type: one of the most frequent words of the training texts, or a tail type made of its last bytes.
The exchange algorithm assigns types to classes so that the classes' bigrams carry the most mutual information.
Then every other training word leaves its tail for the class that its own neighbours' classes gain most from (to first
order: the sum of log N(k, next) - log N(k) and log N(previous, k) - log N(k)), and the classes' bigrams are counted anew.
Only words that no training text has keep the class of their tail.
A token's probability is P(class | previous class) * P(word | class), both smoothed by additive counts; the word
probability has one share for unseen words. A text begins and ends in the class of the end token.

What is gathered: counts of all words of all training texts. Documents are dealt to groups, whose number follows the
input's size, so that a task holds one group's texts and words at most; a group sends each of its
distinct words once with its neighbours' classes, rows sorted by word add the groups' counts, and each group gets back
the counts and classes of its own words - nothing of the vocabulary's size is ever broadcast. Broadcast and sent to the driver: the `frequent` words and
a table of at most (frequent + tails + 1) ** 2 counts of type pairs.

Defined results: a null text is empty (one end token). Null ids count as empty text where remainders are taken.
Without training texts N = 0, V = 0 and every base probability is 0.5 / 0.5 = 1. Repeated rows and ids: each row by its
own text. Words of equal count are taken by their hash, classes of equal gain by their number. Very long texts are
scored whole. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import estimated_bytes, fresh_dir, id_remainder, shuffle_partitions, text_key
from textloom.llm.words import Words, distinct_spans, slices, span_hashes, split

FREQUENT, TAILS, CLASSES = 768, 256, 48
#: Of the exchange, which ends sooner where no single move helps.
SWEEPS = 200
#: Bytes of documents (as their files hold them) that a group is dealt.
GROUP_BYTES = 32 << 20


@dataclass
class Types:
    """Hashes of the frequent words, sorted, and the type of each; tails follow, the end token is last."""

    keys: np.ndarray
    places: np.ndarray
    tails: int

    @property
    def end(self) -> int:
        return len(self.keys) + self.tails

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        tail = span_hashes(data, np.maximum(starts, ends - 3), ends, 1) % np.uint64(self.tails)
        out = tail.astype(np.int64) + len(self.keys)
        if len(self.keys):
            h = span_hashes(data, starts, ends)
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            out = np.where(self.keys[at] == h, self.places[at], out)
        return out


def frequent_types(hashes: np.ndarray, tails: int) -> Types:
    order = np.argsort(hashes)
    return Types(hashes[order], order, tails)


def exchange(pairs: np.ndarray, classes: int, sweeps: int = SWEEPS, fixed: int | None = None) -> np.ndarray:
    """The class of each type: move types one by one to the class that gives the most mutual information.

    pairs[i, j]: how often type j follows type i. fixed: a type that keeps the last class to itself.
    """
    n = len(pairs)
    weight = pairs.sum(axis=1) + pairs.sum(axis=0)
    free = [int(i) for i in np.argsort(-weight, kind="stable") if i != fixed and weight[i] > 0]
    usable = max(1, classes - (fixed is not None))
    group = np.zeros(n, np.int64)
    for rank, i in enumerate(free):
        group[i] = rank % usable
    idle = [i for i in range(n) if weight[i] == 0 and i != fixed]
    group[idle] = usable - 1
    if fixed is not None:
        group[fixed] = classes - 1
    onehot = np.zeros((n, classes))
    onehot[np.arange(n), group] = 1
    out = pairs @ onehot  # type -> following class
    into = pairs.T @ onehot  # type -> preceding class
    table = onehot.T @ out
    xlogx = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)
    for _ in range(sweeps):
        moved = 0
        for i in free:
            old = group[i]
            o, t, self_pairs = out[i], into[i], pairs[i, i]
            # take type i out of its class
            table[old] -= o
            table[:, old] -= t
            table[old, old] += self_pairs
            o, t = o.copy(), t.copy()
            o[old] -= self_pairs
            t[old] -= self_pairs
            rows, cols = table.sum(axis=1) + t, table.sum(axis=0) + o  # wherever i goes, it follows and is followed
            so, st = o.sum() + self_pairs, t.sum() + self_pairs
            gain = (xlogx(table + o[None]) - xlogx(table)).sum(axis=1) + (xlogx(table + t[:, None]) - xlogx(table)).sum(axis=0)
            cross = np.diag(table)
            gain += xlogx(cross + o + t + self_pairs) - xlogx(cross + o) - xlogx(cross + t) + xlogx(cross)
            gain -= xlogx(rows + so) - xlogx(rows) + xlogx(cols + st) - xlogx(cols)
            best = int(np.argmax(gain[:usable]))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            table[best] += o
            table[:, best] += t
            table[best, best] += self_pairs
            if best != old:
                moved += 1
                group[i] = best
                out[:, old] -= pairs[:, i]
                out[:, best] += pairs[:, i]
                into[:, old] -= pairs[i]
                into[:, best] += pairs[i]
        if not moved:
            break
    return group


@dataclass
class ClassModel:
    end: int
    class_tokens: np.ndarray
    class_kinds: np.ndarray
    tokens: int
    kinds: int
    ends: int

    def word_log(self, counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.class_tokens[groups] + 0.5 * (self.class_kinds[groups] + 1)))

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))


def deal(docs: DataFrame) -> DataFrame:
    """Rows with held_out (crc32 mod 5 is 1) and the group that a document belongs to."""
    groups = min(1 << 30, max(2 * shuffle_partitions(docs.sparkSession), estimated_bytes(docs, 0) // GROUP_BYTES))
    return text_key(docs).select("doc_id", "text", (id_remainder(F.col("doc_id"), 5) == 1).alias("held_out"), F.pmod(F.xxhash64("key_id", "key_text"), F.lit(groups)).cast("int").alias("g"))


WORDS = pa.schema([("g", pa.int32()), ("word", pa.binary()), ("n", pa.int64()), ("near", pa.binary())])
Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def frequent_hashes(dealt: DataFrame, frequent: int) -> np.ndarray:
    """Hashes of the most frequent words of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = split(part.column("text"), lower=True)
                h, n = np.unique(span_hashes(w.data, w.starts, w.ends), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    every = dealt.where(~F.col("held_out")).select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))
    top = every.orderBy(F.col("c").desc(), "h").limit(frequent).collect()
    return np.array([r["h"] for r in top], np.int64).view(np.uint64)


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage through files in columns, which take a fraction of a checkpoint's room."""
    folder = fresh_dir(df.sparkSession, "brown")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def group_words(dealt: DataFrame, types: Types, group: np.ndarray) -> DataFrame:
    """g, word (bytes), n (its number in training texts), near for each distinct word of each group.

    near: the classes before and after each training token of a word that isn't frequent, two bytes a token.
    """
    shared = dealt.sparkSession.sparkContext.broadcast((types, group))
    placed = dealt.repartition(shuffle_partitions(dealt.sparkSession), "g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, have = None, None
        kinds, classes = shared.value

        def neighbours(w: Words, train: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
            """Of the n words how many tokens have neighbours here, and these, in the order of the words."""
            if not len(place):
                return np.zeros(n, np.int64), np.zeros((0, 2), np.uint8)
            before, after = sequences(w, kinds)
            at = np.arange(len(w.starts)) + w.owner()
            use = train & (after[at] >= len(kinds.keys))
            near = np.stack([classes[before[at[use]]], classes[after[at[use] + 1]]], axis=1).astype(np.uint8)
            return np.bincount(place[use], minlength=n), near[np.argsort(place[use], kind="stable")]

        def fold(rows: list[Found]) -> Found:
            """Distinct words of several lists (bytes with one space after each, offsets, counts, neighbours)."""
            data = np.concatenate([r[0] for r in rows])
            shift = np.cumsum([0, *(len(r[0]) for r in rows)])
            starts = np.concatenate([r[1][:-1] + s for r, s in zip(rows, shift)])
            ends = np.concatenate([r[1][1:] - 1 + s for r, s in zip(rows, shift)])
            index, inverse = distinct_spans(data, starts, ends)
            counts = np.bincount(inverse, np.concatenate([r[2] for r in rows]), len(index)).astype(np.int64)
            keep = Words(data, np.array([0, len(data)]), starts[index], ends[index], np.array([0, len(index)]))
            order = np.argsort(keep.starts)
            keep.starts, keep.ends = keep.starts[order], keep.ends[order]
            raw, at = keep.joined()
            owner = np.argsort(order)[np.repeat(inverse, np.concatenate([r[3] for r in rows]))]
            near = np.concatenate([r[4] for r in rows])[np.argsort(owner, kind="stable")]
            return np.frombuffer(raw, np.uint8), at, counts[order], np.bincount(owner, minlength=len(index)), near

        def close() -> Iterator[pa.RecordBatch]:
            if have:
                data, at, counts, tokens, near = fold(have) if len(have) > 1 else have[0]
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
                trimmed = pa.array([x[:-1] for x in words.to_pylist()], pa.binary())
                cuts = np.zeros(len(tokens) + 1, np.int64)
                np.cumsum(2 * tokens, out=cuts[1:])
                beside = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(tokens), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(near))]).cast(pa.binary())
                for i in range(0, len(counts), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(counts[i : i + 50_000]), now, np.int32)), trimmed[i : i + 50_000], pa.array(counts[i : i + 50_000]), beside[i : i + 50_000]], schema=WORDS)

        for batch in batches:
            g = batch.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if g[a] != now:
                    yield from close()
                    now, have = int(g[a]), []
                for part in slices(batch.slice(a, b - a)):
                    w = split(part.column("text"), lower=True)
                    if len(w.starts):
                        index, inverse = distinct_spans(w.data, w.starts, w.ends)
                        train = (~part.column("held_out").to_numpy(zero_copy_only=False))[w.owner()]
                        counts = np.bincount(inverse, train, len(index)).astype(np.int64)
                        order = np.argsort(w.starts[index])
                        raw, at = Words(w.data, w.offsets, w.starts[index][order], w.ends[index][order], w.first).joined()
                        have.append((np.frombuffer(raw, np.uint8), at, counts[order], *neighbours(w, train, np.argsort(order)[inverse], len(index))))
                        if len(have) >= 4:
                            have = [fold(have)]
        yield from close()

    return placed.select("g", "text", "held_out").mapInArrow(run, "g int, word binary, n long, near binary")


PLACED = pa.schema([("g", pa.int32()), ("word", pa.binary()), ("c", pa.int64()), ("lead", pa.bool_()), ("k", pa.int32())])


def pull(moves: np.ndarray, end: int) -> np.ndarray:
    """[c, k], [classes + c, k]: what a token gains in class k by class c before it, after it; the end's class takes none."""
    n = len(moves)
    to = np.log((moves + 0.5) / (moves.sum(axis=0, keepdims=True) + 0.5 * n))
    after = np.log((moves.T + 0.5) / (moves.sum(axis=1)[None] + 0.5 * n))
    out = np.concatenate([to, after])
    out[:, end] = -np.inf
    return out


def counted(dealt: DataFrame, types: Types, group: np.ndarray, moves: np.ndarray) -> DataFrame:
    """g, word, c (count in all training texts), lead (true once per word), k (its class)."""
    shared = dealt.sparkSession.sparkContext.broadcast((types, group, pull(moves, int(group[types.end]))))
    n = len(moves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, groups, gains = shared.value

        def close(t: pa.RecordBatch, lead: np.ndarray) -> pa.RecordBatch:
            word = np.cumsum(lead) - 1
            c = np.bincount(word, t.column("n").to_numpy(), word[-1] + 1).astype(np.int64)
            k = groups[kinds.of(*_spans(t.column("word").filter(pa.array(lead))))]
            data, starts, ends = _spans(t.column("near"))
            owner, pairs = np.repeat(word, (ends - starts) // 2), data.reshape(-1, 2)
            for i in range(0, len(c), 4096):
                m = min(4096, len(c) - i)
                x, y = np.searchsorted(owner, [i, i + m])
                at = (owner[x:y] - i) * 2 * n
                table = np.bincount(np.concatenate([at + pairs[x:y, 0], at + n + pairs[x:y, 1]]), minlength=2 * n * m).reshape(m, 2 * n)
                own = table.any(axis=1)
                k[i : i + m][own] = np.argmax(table[own] @ gains[:, :-1], axis=1)
            return pa.RecordBatch.from_arrays([t.column("g"), t.column("word"), pa.array(c[word]), pa.array(lead), pa.array(k[word].astype(np.int32))], schema=PLACED)

        rest = None
        for batch in batches:
            t = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not t.num_rows:
                continue
            word = t.column("word")
            lead = np.ones(len(word), bool)
            lead[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(lead)[-1])  # the last word may go on in the next batch
            if cut:
                yield close(t.slice(0, cut), lead[:cut])
            rest = t.slice(cut)
        if rest is not None:
            yield close(rest, np.arange(rest.num_rows) == 0)

    words = group_words(dealt, types, group).repartition(shuffle_partitions(dealt.sparkSession), "word").sortWithinPartitions("word", "g")
    return words.mapInArrow(run, "g int, word binary, c long, lead boolean, k int")


def pair_counts(dealt: DataFrame, types: Types) -> np.ndarray:
    """How often one type follows another in training texts; the end token stands before the first word too."""
    n = types.end + 1
    shared = dealt.sparkSession.sparkContext.broadcast(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = shared.value
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            for part in slices(batch):
                w = split(part.column("text"), lower=True)
                before, after = sequences(w, kinds)
                total += np.bincount(before * n + after, minlength=n * n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    got = dealt.where(~F.col("held_out")).select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n)
    out[got["pair"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(n, n)


def sequences(w: Words, types: Types) -> tuple[np.ndarray, np.ndarray]:
    """Types of (token before, token) for all tokens of all texts, each text's end last."""
    kind = types.of(w.data, w.starts, w.ends)
    at = np.arange(len(kind)) + w.owner()
    after = np.full(len(kind) + len(w), types.end, np.int64)
    after[at] = kind
    before = np.full(len(after), types.end, np.int64)
    before[1:] = after[:-1]  # the token before a text's first is the end of the text before it, or the beginning
    return before, after


def fit(dealt: DataFrame, frequent: int = FREQUENT, tails: int = TAILS, classes: int = CLASSES) -> tuple[DataFrame, ClassModel]:
    """The words with counts and classes, and the classes' own counts."""
    types = frequent_types(frequent_hashes(dealt, frequent), tails)
    pairs = pair_counts(dealt, types)
    group = exchange(pairs, classes, fixed=types.end)
    onehot = np.zeros((types.end + 1, classes))
    onehot[np.arange(types.end + 1), group] = 1
    words = stored(counted(dealt, types, group, onehot.T @ pairs @ onehot))
    tokens, kinds = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in words.where(F.col("lead") & (F.col("c") > 0)).groupBy("k").agg(F.sum("c").alias("tokens"), F.count("*").alias("kinds")).collect():
        tokens[r["k"]], kinds[r["k"]] = r["tokens"], r["kinds"]
    ends, end = dealt.where(~F.col("held_out")).count(), int(group[types.end])
    tokens[end] += ends
    kinds[end] += ends > 0
    return words, ClassModel(end, tokens, kinds, int(tokens.sum()), int(kinds.sum()), ends)


def _spans(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = words.cast(pa.large_binary())
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offs, data = words.buffers()
    offsets = np.frombuffer(offs, np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


PARTS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("word_score", pa.float64()), ("classes", pa.binary())])
KEPT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]


def parts(dealt: DataFrame, words: DataFrame, model: ClassModel) -> DataFrame:
    """For each text all but the classes' bigrams, and its tokens' classes, a byte each, the end's last."""
    shared = dealt.sparkSession.sparkContext.broadcast(model)

    def run(docs: pa.Table, own: pa.Table) -> pa.Table:
        m = shared.value
        data, starts, ends = _spans(own.column("word"))
        for seed in range(8):  # the group's own words must differ in hash for the look-up to be exact
            key = span_hashes(data, starts, ends, seed)
            order = np.argsort(key)
            key = key[order]
            if not (key[1:] == key[:-1]).any():
                break
        count, place = own.column("c").to_numpy()[order], own.column("k").to_numpy()[order]
        out = []
        for batch in docs.combine_chunks().to_batches():
            for part in slices(batch):
                w = split(part.column("text"), lower=True)
                c, g = np.full(len(w.starts) + len(w), m.ends, np.int64), np.full(len(w.starts) + len(w), m.end, np.int64)
                at = np.arange(len(w.starts)) + w.owner()
                if len(at):
                    found = np.searchsorted(key, span_hashes(w.data, w.starts, w.ends, seed))
                    c[at], g[at] = count[found], place[found]
                cuts = w.first + np.arange(len(w) + 1)
                per = [_per_text(x, cuts) for x in (m.word_log(c, g), m.base_log(c), (c > 0).astype(np.int64))]
                seq = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(g.astype(np.uint8))]).cast(pa.binary())
                out.append(pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(np.diff(cuts)), pa.array(per[2].astype(np.int64)), pa.array(np.full(len(w), m.tokens)), pa.array(per[1]), pa.array(per[0]), seq], schema=PARTS))
        return pa.Table.from_batches(out, PARTS)

    by_group = dealt.groupBy("g").cogroup(words.select("g", "word", "c", "k").groupBy("g"))
    return by_group.applyInArrow(lambda a, b: run(a, b), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, word_score double, classes binary")


def _steps(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of (token before, token) of all texts, and where texts begin."""
    data, starts, ends = _spans(batch.column("classes"))
    before = np.full(len(data), end, np.int64)
    before[1:] = data[:-1]
    return before, data.astype(np.int64), np.append(starts, len(data))


def score(dealt: DataFrame, words: DataFrame, model: ClassModel) -> DataFrame:
    rows, n, end = stored(parts(dealt, words, model)), len(model.class_tokens), model.end

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            before, after, _ = _steps(batch, end)
            total += np.bincount(before * n + after, minlength=n * n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * n)), pa.array(total)], ["pair", "n"])

    moves = np.zeros(n * n)
    for r in rows.where(~F.col("held_out")).select("classes").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        moves[r["pair"]] = r["n"]
    moves = moves.reshape(n, n)
    log_next = np.log10((moves + 0.5) / (moves.sum(axis=1, keepdims=True) + 0.5 * n))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, after, cuts = _steps(batch, end)
            total = batch.column("word_score").to_numpy() + _per_text(log_next[before, after], cuts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEPT), pa.array(total)], [*KEPT, "score"])

    return rows.mapInArrow(add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _per_text(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, cuts[:-1]) if len(cuts) > 1 else x[:0]  # every text has its end token


def op10(docs: DataFrame) -> DataFrame:
    dealt = deal(docs)
    words, model = fit(dealt)
    return score(dealt, words, model)
