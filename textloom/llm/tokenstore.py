"""Token ids on disk: a shared zstandard dictionary, one frame per document, an offset index.

Format of a store (a folder):
  dictionary/  Parquet, one row: sha256 of the dictionary, its bytes, width of an id in bytes, end id.
  shards/      Parquet, one row per shard, in ascending order of documents. A shard holds up to about SHARD_BYTES:
               part, shard (its place within the part), first_doc and last_doc, tokens_before (ids before it within
               the part), dictionary_sha256, doc_ids, n_tokens, offsets (n + 1 byte offsets of the frames), payload.
A document's ids are payload[offsets[i]:offsets[i + 1]], one zstandard frame under the dictionary, of little-endian
unsigned integers. A short document is read without its neighbours: Parquet's statistics on first_doc and last_doc
leave one shard, the index leaves one frame.

Documents are dealt by ranges of doc_id (null first; ties by text), so parts and shards are in order and no task holds
more than its range. Rows are written and committed by Spark's Parquet writer, on any file system.

Defined results: null text is empty (the end id alone). Repeated ids are separate documents next to each other. An
empty table gives a store without shards. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import bounded_sample, estimated_bytes, fresh_dir, shuffle_partitions
from textloom.llm.words import SPACES, flat, slices, split_bytes

SHARD_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS = 400
#: Pieces of one generation of an encoder's cache; two are held.
CACHE_ENTRIES = 250_000
#: Text that is cut, looked up and laid out at a time.
SLICE = 8 << 20
#: White space beyond ASCII, and ASCII controls that some pattern engines count as white space; rare texts with these are encoded whole.
ODD_SPACE = "[\x1c-\x1f\u0085   -     　]"


def _byte_signs() -> dict[int, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: b for b in printable}, **{b: 256 + k for k, b in enumerate(others)}}


BYTE_SIGNS = _byte_signs()
LETTERS, STOPS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOPS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Byte-level BPE of whole texts.

    The pre-tokenizer never joins a piece across a word boundary, so a slice of texts is cut into words (with one
    leading blank) and runs of white space. Arrow encodes the slice's pieces as places in a dictionary, each distinct
    piece is tokenised once, and ids are laid out by place.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.top_id = max(vocabulary.values())
        # letters alone, with a blank before them or none, are one word of the byte-level pre-tokenizer: the model takes them as they are
        self.direct = isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.normalizer is None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def pieces(self, raw: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each of the distinct pieces, through a cache of two generations."""
        young, old = self.young, self.old
        out = list(map(young.get, raw))
        missing = [i for i, x in enumerate(out) if x is None]
        fresh = []
        for i in missing:
            known = old.get(raw[i])
            if known is None:
                fresh.append(raw[i])
            else:
                young[raw[i]] = known
        rest, direct = [], self.direct
        tokenize = self.tokenizer.model.tokenize
        for p in fresh:
            word = p.decode()
            if direct and (word[1:] if word[0] == " " else word).isalpha():
                ids = [t.id for t in tokenize(p.decode("latin-1").translate(BYTE_SIGNS))]
                young[p] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(p)
        for i in range(0, len(rest), 4096):
            some = rest[i : i + 4096]
            for p, e in zip(some, self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)):
                young[p] = struct.pack(f"<{len(e)}I", *e.ids)
        for i in missing:
            out[i] = young[raw[i]]
        if len(young) > CACHE_ENTRIES:
            self.old, self.young = young, {}
        return out

    def batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each text's end id included; where each text begins, and the end of the last)."""
        odd = pc.fill_null(pc.match_substring_regex(texts, ODD_SPACE), False).to_numpy(zero_copy_only=False)
        tokens, cuts = self._plain(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts) if odd.any() else texts, end_id)
        if not odd.any():
            return tokens, cuts
        where = np.flatnonzero(odd)
        found = dict(zip(where.tolist(), self.whole([texts[int(i)].as_py() for i in where])))
        parts = [np.append(np.frombuffer(found[i], np.uint32), np.uint32(end_id)) if i in found else tokens[a:b] for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()))]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def _plain(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = flat(texts)
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        starts, _ = piece_spans(data, offsets)
        ends = offsets[1:] - 1  # the sign between texts stands for the end id
        more = stops(data) if self.direct else starts[:0]
        tiles = np.append(np.sort(np.concatenate([starts, ends, more]), kind="stable"), len(data))
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(tiles) - 1, [None, pa.py_buffer(tiles), pa.py_buffer(data)]).dictionary_encode()
        ids = [*self.pieces(cut.dictionary.to_pylist()), struct.pack("<I", end_id)]
        codes = cut.indices.to_numpy().copy()
        places = np.searchsorted(tiles[:-1], ends)
        codes[places] = len(ids) - 1
        begin = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in ids], out=begin[1:])
        laid = pa.ListArray.from_arrays(pa.array(begin), pa.array(np.frombuffer(b"".join(ids), np.uint32))).take(pa.array(codes))
        at = laid.offsets.to_numpy()
        return laid.values.to_numpy()[at[0] : at[-1]], np.append(0, at[places + 1] - at[0]).astype(np.int64)


def stops(data: np.ndarray) -> np.ndarray:
    """Where ASCII punctuation follows a Latin letter: a word of the byte-level pre-tokenizer ends there, but for apostrophes."""
    letter = LETTERS[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # A to y with accents, without the two signs among them
    return np.flatnonzero(STOPS[data[1:]] & letter[:-1]) + 1


def piece_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans, in order, that cover all texts: words with one leading blank, and what is left of white space.

    Of a run before a word the last character stands alone (a blank joins the word), the rest is one piece; a run at
    the end of a text is one piece.
    """
    w = split_bytes(data, offsets, SPACES)
    text_of = np.searchsorted(offsets, w.starts, "right") - 1
    lead = np.where(np.r_[True, text_of[1:] != text_of[:-1]] if len(text_of) else np.zeros(0, bool), offsets[text_of], np.r_[0, w.ends[:-1]] if len(w.ends) else 0)
    gap = w.starts > lead
    blank = gap & (data[np.maximum(w.starts - 1, 0)] == 0x20)
    last = gap & ~blank
    head_end = w.starts - gap
    head = head_end > lead
    texts = np.arange(len(offsets) - 1)
    some = w.first[1:] > w.first[:-1]
    tail_start = np.where(some, w.ends[np.maximum(w.first[1:] - 1, 0)] if len(w.ends) else 0, offsets[:-1])
    tail_end = offsets[1:] - 1
    tail = tail_end > tail_start
    starts = np.concatenate([w.starts - blank, lead[head], head_end[last], tail_start[texts[tail]]])
    ends = np.concatenate([w.ends, head_end[head], w.starts[last], tail_end[tail]])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, path: str, dtype: np.dtype, end_id: int, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """From the serialized ids of about rows whole documents, a bounded sample; a document gives a sample string for every 4096 ids."""
    sample = bounded_sample(docs.where(F.col("text").isNotNull()).select("doc_id", "text"), "doc_id", rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens, cuts = encoder(path).batch(part.column("text"), end_id)
                raw = tokens.astype(dtype)
                pieces = [raw[i : min(i + 4096, b)].tobytes() for a, b in zip(cuts.tolist(), cuts[1:].tolist()) for i in range(a, b, 4096)]
                yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], ["ids"])

    got = sorted(sample.mapInArrow(run, "ids binary").toArrow()["ids"].to_pylist())
    try:
        return zstandard.train_dictionary(size, got).as_bytes()
    except zstandard.ZstdError:  # too little to learn from: the sample itself, as a raw content dictionary
        return b"".join(got)[:size] or b"\0" * 8


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, id_bytes: int = 2, level: int = 3) -> str:
    """Write documents (doc_id, text) as a store; returns its folder."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    dtype = np.dtype(f"<u{id_bytes}")
    if max(encoder(path).top_id, end_id) > np.iinfo(dtype).max:
        raise ValueError(f"ids of this tokenizer don't fit in {id_bytes} bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = train_dictionary(rows, path, dtype, end_id)
    digest = hashlib.sha256(words).hexdigest()
    spark.createDataFrame([(digest, words, id_bytes, end_id)], "sha256 string, content binary, id_bytes int, end_id int").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(shared.value), write_content_size=True)
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            offsets = np.zeros(len(frames) + 1, np.int64)
            np.cumsum([len(f) for f in frames], out=offsets[1:])
            known = [i for i in ids if i is not None]
            row = {
                "part": part, "shard": shard, "first_doc": known[0] if known else None, "last_doc": known[-1] if known else None, "tokens_before": before, "dictionary_sha256": digest,
                "doc_ids": ids[:], "n_tokens": counts[:], "offsets": offsets.tolist(), "payload": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], SHARD)

        for batch in batches:
            for some in slices(batch, limit=SLICE):
                tokens, cuts = encoder(path).batch(some.column("text"), end_id)
                raw, places = memoryview(tokens.astype(dtype)).cast("B"), (cuts * dtype.itemsize).tolist()
                for doc_id, n, a, b in zip(some.column("doc_id").to_pylist(), np.diff(cuts).tolist(), places, places[1:]):
                    frames.append(pack.compress(raw[a:b]))
                    ids.append(doc_id)
                    counts.append(n)
                    held += len(frames[-1]) + 24
                    if held >= SHARD_BYTES:
                        yield close()
                        shard, before, held = shard + 1, before + sum(counts), 0
                        ids, counts, frames = [], [], []
        if frames:
            yield close()
        encoder(path).old = {}  # the worker lives on

    parts = max(shuffle_partitions(spark), min(1 << 17, estimated_bytes(rows, 0) >> 27))
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").drop("tie")
    fields = "part int, shard int, first_doc long, last_doc long, tokens_before long, dictionary_sha256 string, doc_ids array<long>, n_tokens array<long>, offsets array<long>, payload binary"
    ranged.mapInArrow(run, fields).write.option("compression", "uncompressed").parquet(f"{folder}/shards")
    return folder


SHARD = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("tokens_before", pa.int64()), ("dictionary_sha256", pa.string()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def dictionary(spark: SparkSession, folder: str) -> dict:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(row["content"]).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {folder} isn't the one its hash names")
    return row.asDict()


def decode(shards: DataFrame, words: dict) -> DataFrame:
    """doc_id, start (ids of all documents before it within its part), ids as bytes, for every document of the shards."""
    dtype = np.dtype(f"<u{words['id_bytes']}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(words["content"])))
        for batch in batches:
            for row in range(batch.num_rows):
                part, before, ids, n, offsets, raw, digest = (batch.column(c)[row].as_py() for c in ("part", "tokens_before", "doc_ids", "n_tokens", "offsets", "payload", "dictionary_sha256"))
                if digest != words["sha256"]:
                    raise ValueError("a shard was written with another dictionary")
                tokens = [np.frombuffer(unpack.decompress(raw[a:b]), dtype).astype("<u4") for a, b in zip(offsets, offsets[1:])]
                if [len(t) for t in tokens] != n:
                    raise ValueError("a frame doesn't hold as many ids as the index says")
                start = before + np.cumsum([0, *n])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), pa.array(ids, pa.int64()), pa.array(start.astype(np.int64)), pa.array(np.array(n, np.int64)), pa.array([zlib.crc32(t.tobytes()) for t in tokens], pa.int64())],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    return shards.mapInArrow(run, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    shards = spark.read.parquet(f"{folder}/shards")
    per_part = shards.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)).alias("tokens"))
    ahead, base = 0, []
    for part, tokens in sorted(map(tuple, per_part.collect())):  # one row for each part: as many as the writer's partitions
        base.append((part, ahead))
        ahead += tokens
    bases = spark.createDataFrame(base, "part int, base long")
    found = decode(shards, dictionary(spark, folder)).join(F.broadcast(bases), "part")
    return found.select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """The ids of one document: one shard, one frame."""
    row = spark.read.parquet(f"{folder}/shards").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id) & F.array_contains("doc_ids", doc_id)).first()
    if row is None:
        return None
    words = dictionary(spark, folder)
    i = row["doc_ids"].index(doc_id)
    frame = bytes(row["payload"])[row["offsets"][i] : row["offsets"][i + 1]]
    raw = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(words["content"]))).decompress(frame)
    return np.frombuffer(raw, f"<u{words['id_bytes']}").tolist()


def op6(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the store, in the shared folder unless another is given, and report what its files hold."""
    spark = docs.sparkSession
    return read_index(spark, write(docs, folder or fresh_dir(spark, "tokens"), tokenizer))
