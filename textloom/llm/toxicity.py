"""Toxicity by two class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a byte n-gram model over the words of its texts: absolute discounting at the
highest order over the class's own counts, backing off to one interpolated Kneser-Ney distribution whose
continuation counts both classes share. A text's score compares the two length-normalised log-likelihoods.
Where a class has not seen an n-gram, its probability is its backoff weight times the shared distribution; in the
difference of two log-likelihoods the shared factor cancels, so scoring needs the seen n-grams and contexts alone.
`KneserNey.log_likelihoods` has both likelihoods in full.

A logistic curve over that difference, fitted on the training texts, gives the probability.

Defined results: a null or empty text scores as the training prior. Very long texts are learnt and scored whole. Empty
tables give empty results; further columns are ignored. A score of exactly one half counts as toxic. Without training labels of both classes every
text gets score 0. Null and repeated ids: each row by its own text. Labels repeated for an id: toxic if any is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import bounded_sample, checkpoint, id_remainder, shuffle_partitions
from textloom.llm.words import SPACES, Words, distinct_spans, mix, slices, split

EDGE = np.uint64(257)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Punctuation at which words also end; digits too carry no expression.
BREAKS = SPACES.copy()
BREAKS[[*range(0x00, 0x61), *range(0x7B, 0x80)]] = True


@dataclass
class KneserNey:
    order: int
    discount: float
    grams: np.ndarray
    gram_ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray
    gram_counts: np.ndarray
    context_counts: np.ndarray
    shared: list[tuple[np.ndarray, np.ndarray]]
    curve: np.ndarray

    def ratios(self, symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log P(symbol | toxic) - log P(symbol | ordinary) at each position of padded words."""
        h = gram_hashes(symbols, self.order)
        inside = positions(symbols, begins, self.order)
        context, gram = h[self.order - 1][inside - 1], h[self.order][inside]
        out = _look_up(self.contexts, self.context_ratio, context, 0.0)
        seen = _look_up(self.grams, self.gram_ratio, gram, np.nan)
        out = np.where(np.isnan(seen), out, seen)
        full = np.zeros(len(symbols))
        full[inside] = out
        return full

    def log_likelihoods(self, word: bytes) -> tuple[float, float]:
        """Natural logarithms of one word's probability under (ordinary, toxic)."""
        symbols, begins = pad([word], self.order)
        h = gram_hashes(symbols, self.order)
        out = [0.0, 0.0]
        for i in positions(symbols, begins, self.order):
            base = self._shared(h, i)
            for c in range(2):
                a = _look_up(self.grams, self.gram_counts[:, c], h[self.order][[i]], 0.0)[0]
                total = _look_up(self.contexts, self.context_counts[:, c], h[self.order - 1][[i - 1]], 0.0)[0]
                kinds = _look_up(self.contexts, self.context_counts[:, 2 + c], h[self.order - 1][[i - 1]], 0.0)[0]
                p = base if not total else (max(a - self.discount, 0) + self.discount * kinds * base) / total
                out[c] += float(np.log(p))
        return out[0], out[1]

    def _shared(self, h: list[np.ndarray], i: int) -> float:
        p = 1 / 257
        for k in range(1, self.order):
            grams, contexts = self.shared[2 * (k - 1)], self.shared[2 * (k - 1) + 1]
            ctx = h[k - 1][[i - 1]] if k > 1 else np.zeros(1, np.uint64)
            a = _look_up(grams[0], grams[1], h[k][[i]], 0.0)[0]
            total = _look_up(contexts[0], contexts[1][:, 0], ctx, 0.0)[0]
            kinds = _look_up(contexts[0], contexts[1][:, 1], ctx, 0.0)[0]
            if total:
                p = (max(a - self.discount, 0) + self.discount * kinds * p) / total
        return p


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), absent)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], absent)


def pad(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return pad_spans(data, ends - [len(w) for w in words], ends, order)


def pad_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as symbols: order - 1 edges, the bytes, one edge; and where each word's padding begins."""
    sizes = ends - starts
    begins = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes + order, out=begins[1:])
    symbols = np.full(begins[-1], EDGE, np.uint64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[np.repeat(begins[:-1] + order - 1, sizes) + within] = data[np.repeat(starts, sizes) + within]
    return symbols, begins


def positions(symbols: np.ndarray, begins: np.ndarray, order: int) -> np.ndarray:
    keep = np.ones(len(symbols), bool)
    for k in range(order - 1):
        keep[begins[:-1] + k] = False
    return np.flatnonzero(keep)


def gram_hashes(symbols: np.ndarray, order: int) -> list[np.ndarray]:
    """[k]: at each position the hash of the k symbols that end there."""
    out = [np.zeros(len(symbols), np.uint64)]
    for k in range(1, order + 1):
        before = np.zeros(len(symbols), np.uint64)
        before[1:] = out[-1][:-1]
        out.append(mix((before + np.uint64(k)) * _STEP ^ mix(symbols + np.uint64(1))))
    return out


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of the rows of values."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
    return k[cut], np.add.reduceat(values[order], cut, axis=0) if len(k) else values


@dataclass
class Grams:
    """Distinct n-grams of the highest order: key, counts by class, below[k] (hash of its last k symbols, k from 1), before[k]
    (hash of the k - 1 symbols before its last, k from 1)."""

    key: np.ndarray
    counts: np.ndarray
    below: dict[int, np.ndarray]
    before: dict[int, np.ndarray]

    def merged(self) -> Grams:
        keys, counts = _sums(self.key, self.counts)
        _, one = np.unique(self.key, return_index=True)
        return Grams(keys, counts, {k: v[one] for k, v in self.below.items()}, {k: v[one] for k, v in self.before.items()})


#: Words whose n-grams are taken at a time.
BLOCK = 50_000


def grams_of(words: list[bytes], counts: np.ndarray, order: int) -> Grams:
    """All distinct n-grams; what is held grows with these, not with the words."""
    have: list[Grams] = []
    for i in range(0, max(len(words), 1), BLOCK):
        symbols, begins = pad(words[i : i + BLOCK], order)
        at = positions(symbols, begins, order)
        h = gram_hashes(symbols, order)
        below = {k: h[k][at] for k in range(1, order)}
        before = {k: h[k - 1][at - 1] if k > 1 else np.zeros(len(at), np.uint64) for k in range(1, order + 1)}
        word = np.searchsorted(begins, at, "right") - 1
        have.append(Grams(h[order][at], counts[i : i + BLOCK][word].astype(float), below, before).merged())
        if len(have) > 8:
            have = [_joined(have)]
    return _joined(have)


def _joined(parts: list[Grams]) -> Grams:
    if len(parts) == 1:
        return parts[0]
    glue = lambda pick: {k: np.concatenate([pick(p)[k] for p in parts]) for k in pick(parts[0])}
    return Grams(np.concatenate([p.key for p in parts]), np.concatenate([p.counts for p in parts]), glue(lambda p: p.below), glue(lambda p: p.before)).merged()


def estimate(words: list[bytes], counts: np.ndarray, order: int = 5, discount: float = 0.75) -> KneserNey:
    """counts: for each word its number in (ordinary, toxic) texts."""
    g = grams_of(words, counts, order)
    contexts, total = _sums(g.before[order], np.concatenate([g.counts, (g.counts > 0).astype(float)], axis=1))
    of = np.searchsorted(contexts, g.before[order])
    shared, rows = [], np.arange(len(g.key))
    for k in range(order - 1, 0, -1):
        # a continuation count: how many distinct symbols stand before the n-gram; rows: one of each n-gram of the order above
        keys, n = _sums(g.below[k][rows], np.ones(len(rows)))
        _, one = np.unique(g.below[k][rows], return_index=True)
        rows = rows[one]
        cs, t = _sums(g.before[k][rows], np.stack([n, np.ones(len(n))], axis=1))
        shared[:0] = [(keys, n), (cs, t)]
    model = KneserNey(order, discount, g.key, np.zeros(len(g.key)), contexts, np.zeros(len(contexts)), g.counts, total, shared, np.zeros(3))
    weight = np.where(total[:, :2] > 0, discount * total[:, 2:] / np.maximum(total[:, :2], 1), 1.0)
    model.context_ratio = np.log(weight[:, 1]) - np.log(weight[:, 0])
    base = _shared_all(model, g)
    p = np.where(total[of, :2] > 0, (np.maximum(g.counts - discount, 0) + discount * total[of, 2:] * base[:, None]) / np.maximum(total[of, :2], 1), base[:, None])
    model.gram_ratio = np.log(p[:, 1]) - np.log(p[:, 0])
    return model


def _shared_all(model: KneserNey, g: Grams) -> np.ndarray:
    p = np.full(len(g.key), 1 / 257)
    for k in range(1, model.order):
        grams, contexts = model.shared[2 * (k - 1)], model.shared[2 * (k - 1) + 1]
        a = _look_up(grams[0], grams[1], g.below[k], 0.0)
        total = _look_up(contexts[0], contexts[1][:, 0], g.before[k], 0.0)
        kinds = _look_up(contexts[0], contexts[1][:, 1], g.before[k], 0.0)
        p = np.where(total > 0, (np.maximum(a - model.discount, 0) + model.discount * kinds * p) / np.maximum(total, 1), p)
    return p


def scoring(model: KneserNey) -> KneserNey:
    """The model without its counts, which scoring doesn't read."""
    none = np.zeros((0, 4))
    return replace(model, gram_counts=none, context_counts=none, shared=[])


def differences(model: KneserNey, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: mean by symbols of the log-likelihood difference, mean of its words' positive parts by words, words."""
    n = np.diff(w.first)
    if not len(w.starts):
        return np.zeros(len(w)), np.zeros(len(w)), n
    index, inverse = distinct_spans(w.data, w.starts, w.ends)
    symbols, begins = pad_spans(w.data, w.starts[index], w.ends[index], model.order)
    r = np.zeros(len(symbols) + 1)
    np.cumsum(model.ratios(symbols, begins), out=r[1:])
    word = (r[begins[1:]] - r[begins[:-1]])[inverse]
    total = np.zeros(len(word) + 1)
    np.cumsum(word, out=total[1:])
    high = np.zeros(len(word) + 1)
    np.cumsum(np.maximum(word - 4.0, 0), out=high[1:])
    size = np.zeros(len(word) + 1)
    np.cumsum(w.ends - w.starts + 1, out=size[1:])
    per = lambda s: s[w.first[1:]] - s[w.first[:-1]]
    return per(total) / np.maximum(per(size), 1), per(high) / np.maximum(n, 1), n


def features(model: KneserNey, w: Words) -> np.ndarray:
    mean, high, n = differences(model, w)
    return np.stack([np.ones(len(n)), np.clip(mean * 20, -6, 6), np.log1p(40 * high)], axis=1)


def score(model: KneserNey, texts: pa.Array) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features(model, split(texts, BREAKS, lower=True)) @ model.curve, -30, 30)))


def calibrate(model: KneserNey, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> None:
    """Logistic regression by Newton's method."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) * np.eye(x.shape[1])
        b += np.linalg.solve(hess, x.T @ (y - p) - ridge * len(x) * b)
    model.curve = b


def word_counts(sample: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """All words of the sample, and of each its numbers in the four groups 2 * half + toxic, added up on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = split(part.column("text"), BREAKS, lower=True)
                if not len(w.starts):
                    continue
                index, inverse = distinct_spans(w.data, w.starts, w.ends)
                group = (2 * part.column("half").to_numpy() + part.column("toxic").to_numpy())[w.owner()]
                here = np.bincount(inverse * 4 + group, minlength=4 * len(index)).reshape(-1, 4).astype(np.int64)
                raw = w.data.tobytes()
                words = pa.array([raw[a:b] for a, b in zip(w.starts[index].tolist(), w.ends[index].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([words, *(pa.array(here[:, k]) for k in range(4))], ["word", "n0", "n1", "n2", "n3"])

    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]
    got = sample.mapInArrow(run, "word binary, n0 long, n1 long, n2 long, n3 long").groupBy("word").agg(*sums).toArrow()
    return got["word"].to_pylist(), np.stack([got[f"n{k}"].to_numpy() for k in range(4)], axis=1)


def measured(sample: DataFrame, model: KneserNey) -> tuple[np.ndarray, np.ndarray]:
    """Features and class of each text of the sample, in an order of their own."""
    shared = sample.sparkSession.sparkContext.broadcast(scoring(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = features(shared.value, split(part.column("text"), BREAKS, lower=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(3)), part.column("toxic")], ["x0", "x1", "x2", "toxic"])

    got = sample.mapInArrow(run, "x0 double, x1 double, x2 double, toxic int").toArrow()
    shared.destroy()
    x, y = np.stack([got[f"x{k}"].to_numpy() for k in range(3)], axis=1), got["toxic"].to_numpy()
    order = np.lexsort((x[:, 2], x[:, 1], y))
    return x[order], y[order]


def train(sample: DataFrame, order: int = 5) -> KneserNey | None:
    """Models from half of the texts set the curve on the other half, and the other way round; the last models see all.

    sample: text, toxic, half. Sent to the driver: the distinct words' counts and three numbers for each text.
    """
    sizes = np.zeros((2, 2), int)
    for r in sample.groupBy("half", "toxic").count().collect():
        sizes[r["half"], r["toxic"]] = r["count"]
    if not sizes.sum(axis=0).all():
        return None
    words, table = word_counts(sample)

    def counted(halves: tuple[int, ...]) -> KneserNey:
        n = sum(table[:, 2 * s : 2 * s + 2] for s in halves)
        some = n.sum(axis=1) > 0
        return estimate([x for x, ok in zip(words, some) if ok], n[some], order)

    found = []
    for side in (0, 1):
        if sizes[1 - side].all() and sizes[side].any():
            found.append(measured(sample.where(F.col("half") == side), counted((1 - side,))))
    model = counted((0, 1))
    if not found:
        found = [measured(sample, model)]
    calibrate(model, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]).astype(float))
    return model


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 2000, max_ordinary: int = 2500) -> KneserNey | None:
    """Train on the whole texts of a bounded sample of labelled documents: about max_toxic and max_ordinary rows."""
    marks = labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    wanted = None
    for value, bound in ((1, max_toxic), (0, max_ordinary)):
        some = bounded_sample(marks.where(F.col("toxic") == value), "doc_id", bound)
        wanted = some if wanted is None else wanted.unionByName(some)
    rows = (
        docs.where(F.col("text").isNotNull()).select("doc_id", "text")
        .join(F.broadcast(wanted), "doc_id")  # bounded by max_toxic + max_ordinary
        .select("text", "toxic", F.xxhash64("doc_id", "text").alias("k"))
    )
    turn = F.row_number().over(Window.partitionBy("toxic").orderBy("k"))
    halves = rows.withColumn("half", ((turn - 1) % 2).cast("int")).repartition(shuffle_partitions(docs.sparkSession), "k")
    return train(checkpoint(halves.select("text", "toxic", "half")))


def rate(docs: DataFrame, model: KneserNey | None, keep: list[str] | None = None) -> DataFrame:
    """doc_id and the columns named in keep, with score and predicted, for every row."""
    names = ["doc_id", *(keep or [])]
    rows = docs.select(*names, "text") if "text" not in names else docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else scoring(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch):
                s = np.zeros(part.num_rows) if model is None else score(model, part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{fields}, score double, predicted int")


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn labels only from ids whose crc32 mod 5 is not 0, score all."""
    model = fit(docs, labels.where(id_remainder(F.col("doc_id"), 5) != 0))
    return rate(docs.select("doc_id", "text", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out")), model, ["held_out"])
