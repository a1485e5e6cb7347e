"""Language identification by a byte convolutional network.

A text is cut into fixed-length byte windows. Each byte has a small embedding; filters of several widths slide
over the embeddings, each filter keeps its maximum over the window, and a softmax turns the maxima into language
probabilities. The network is trained in numpy on a bounded sample of labelled texts, so many of each language, from
crops drawn anywhere in them, and applied to batches of windows that cover every whole text.

Defined results: null text, or text without a letter: `und`, score 0. Null or repeated ids: each row is predicted
by its own text. No labelled rows at all: `und`, score 0. Languages of equal probability: the first by name. Very long
texts are read whole, a block of windows at a time. Empty tables give empty results. Only doc_id, text and the label are
read; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import id_remainder
from textloom.llm.words import LOWER, flat, slices

UNDETERMINED = "und"


@dataclass
class ByteConvNet:
    """Parameters. filters are stored as one matrix over the widest window, zero beyond each filter's own width."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    width: int
    window: int

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(n, window) bytes -> (n, window, width * dims): the embeddings under each filter position."""
        n, dims = len(windows), self.embedding.shape[1]
        e = np.zeros((n, self.window + self.width - 1, dims), np.float32)
        e[:, : self.window] = self.embedding[windows]
        s = e.strides
        view = np.lib.stride_tricks.as_strided(e, (n, self.window, self.width * dims), (s[0], s[1], s[2]))
        return np.ascontiguousarray(view)

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        n = len(columns)
        z = (columns.reshape(-1, columns.shape[2]) @ self.filters).reshape(n, self.window, -1)
        return z

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return np.zeros((0, len(self.languages)))
        top = self.pooled(self.columns(windows)).max(axis=1) + self.bias
        return _log_softmax(np.maximum(top, 0) @ self.out + self.out_bias)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def crops_of(text: bytes, window: int, crops: int) -> np.ndarray:
    """(n, window): crops from anywhere in the text, every second one short to teach short texts, by a seed of the text's own."""
    rng = np.random.default_rng(zlib.crc32(text))
    raw = LOWER[np.frombuffer(text, np.uint8)]
    out = np.zeros((crops if len(raw) > window else 2, window), np.uint8)
    for k, row in enumerate(out):
        size = window if k % 2 == 0 else int(rng.integers(8, window))
        at = int(rng.integers(0, max(1, len(raw) - size + 1)))
        row[: len(raw[at : at + size])] = raw[at : at + size]
    return out


def train(
    x: np.ndarray, labels: list[str], widths: tuple[int, ...] = (2, 3, 4), per_width: int = 12, dims: int = 6,
    epochs: int = 10, batch: int = 128, rate: float = 4e-3, seed: int = 7,
) -> ByteConvNet:
    """Adam on cross-entropy over crops (rows of bytes) and their languages."""
    rng = np.random.default_rng(seed)
    languages, y = np.unique(np.array(labels, dtype=object), return_inverse=True)
    languages, window = languages.tolist(), x.shape[1]
    width, count = max(widths), per_width * len(widths)
    mask = np.zeros((width * dims, count), np.float32)
    for i, w in enumerate(widths):
        mask[: w * dims, i * per_width : (i + 1) * per_width] = 1
    embedding = rng.normal(0, 0.5, (256, dims)).astype(np.float32)
    embedding[0] = 0
    net = ByteConvNet(
        languages, embedding, rng.normal(0, 0.3, mask.shape).astype(np.float32) * mask, np.zeros(count, np.float32),
        rng.normal(0, 0.2, (count, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32), width, window,
    )
    names = ("embedding", "filters", "bias", "out", "out_bias")
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            columns = net.columns(x[rows])
            z = net.pooled(columns)
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            p = np.exp(_log_softmax(hidden @ net.out + net.out_bias))
            p[np.arange(len(rows)), y[rows]] -= 1
            p = (p / len(rows)).astype(np.float32)
            d_top = (p @ net.out.T) * (top > 0)
            chosen = np.take_along_axis(columns, best[:, :, None], 1)  # n, filters, width * dims
            d_columns = d_top[:, :, None] * (net.filters.T)[None]
            d_embedding = np.zeros_like(net.embedding)
            padded = np.zeros((len(rows), window + width - 1), np.uint8)
            padded[:, :window] = x[rows]
            for k in range(width):
                under = np.take_along_axis(padded, best + k, 1)
                np.add.at(d_embedding, under.ravel(), d_columns[:, :, k * dims : (k + 1) * dims].reshape(-1, dims))
            d_embedding[0] = 0
            grads = {
                "embedding": d_embedding, "filters": np.einsum("nf,nfc->cf", d_top, chosen) * mask,
                "bias": d_top.sum(0), "out": hidden.T @ p, "out_bias": p.sum(0),
            }
            step += 1
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                getattr(net, k)[...] -= (rate * move).astype(np.float32)
    return net


def windows_of(texts: pa.Array, window: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (bytes of consecutive windows over whole texts, owner of each, bytes of text that are new in each).

    The last window of a text that has several begins early, so that it is full too.
    """
    data, offsets = flat(texts)
    sizes = np.diff(offsets) - 1
    counts = np.maximum(1, -(-sizes // window)) if len(sizes) else sizes
    first = np.cumsum(counts) - counts
    at = np.arange(window)[None]
    for lo in range(0, int(counts.sum()), block):
        place = np.arange(lo, min(lo + block, int(counts.sum())))
        owner = np.searchsorted(first, place, "right") - 1
        rank, whole = place - first[owner], sizes[owner]
        size = np.minimum(window, whole)
        index = np.minimum((offsets[owner] + np.minimum(rank * window, np.maximum(0, whole - window)))[:, None] + at, len(data) - 1)
        yield np.where(at < size[:, None], LOWER[data[index]], 0).astype(np.uint8), owner, np.minimum(size, whole - rank * window)


def predict(net: ByteConvNet, texts: pa.Array, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(place of the likeliest language, its probability) of each text: mean of its windows' log-probabilities by bytes."""
    total, weight = np.zeros((len(texts), len(net.languages))), np.zeros(len(texts))
    for rows, owner, fresh in windows_of(texts, net.window, block):
        np.add.at(total, owner, net.log_probabilities(rows) * fresh[:, None])
        np.add.at(weight, owner, fresh)
    p = np.exp(_log_softmax(total / np.maximum(weight, 1)[:, None]))
    return p.argmax(axis=1), p.max(axis=1)


def fit(docs: DataFrame, max_rows: int = 800, window: int = 128, crops: int = 6, **options) -> ByteConvNet | None:
    """Train on about max_rows documents of each language (text and lang not null), all of a rarer one: a bounded sample.

    Crops are drawn from whole texts on the executors; the driver gets crops * window bytes a document.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return None
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max_rows / n))])
    sample = rows.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [crops_of(t.encode(), window, crops).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), part.column("lang")], ["crops", "lang"])

    got = sample.select("text", "lang").mapInArrow(run, "crops binary, lang string").toArrow()
    drawn = sorted(zip(got["crops"].to_pylist(), got["lang"].to_pylist()))
    if not drawn:
        return None
    x = np.frombuffer(b"".join(c for c, _ in drawn), np.uint8).reshape(-1, window)
    return train(x, [lang for c, lang in drawn for _ in range(len(c) // window)], **options)


def identify(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """doc_id, held_out (if the input has it), lang_pred, score for every row."""
    rows = docs.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch):
                letters = part.column("has_letter").to_numpy(zero_copy_only=False)
                if model is None:
                    names, score = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                else:
                    best, score = predict(model, part.column("text"))
                    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
                    score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def op1(docs: DataFrame) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 4 is not 2, predict all."""
    marked = docs.select("doc_id", "text", "lang", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    net = fit(marked.where(~F.col("held_out")))
    return identify(marked.drop("lang"), net)
