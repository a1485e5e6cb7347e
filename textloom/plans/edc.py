"""Triples from texts: extraction, definition of relations, canonicalisation against a schema, refinement in rounds.

Models sit behind callables from prompt to answer (`model_stage.asked`); every stage is materialised, keyed by the
document's index and the triple's place. The bundled offline model is deterministic and proves the plumbing alone.

Departures: a relation that no schema relation fits is added (enrich) after all triples were matched, not between one
triple and the next, so a relation of the same run can't be matched to it; of several definitions the first by document
and place is taken. `streaming.resume.enrich` has the exact order.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import native, parsing
from textloom.operators import hints, triples
from textloom.plans.lineage import cut, stored
from textloom.plans.model_stage import HELD, asked, asker, at_once

Backend = Callable[[str], str]

#: Relations offered for a triple, and those a text is hinted at.
OFFERED, HINTED = 5, 10
DIMENSIONS = 64
TRIPLE = "struct<s:string,p:string,o:string>"


def offline(prompt: str) -> str:
    """Answers to all prompts of the chain, by rules."""
    return _answer(json.loads(prompt))


def _answer(ask: dict) -> str:
    names = re.findall(r"[A-ZÀ-ÖØ-Þ][^\W\d_]*", ask["text"]) if ask["task"] in ("triples", "entities") else []
    if ask["task"] == "triples":
        return "\n".join(json.dumps([a, "followed_by" if a <= b else "comes_after", b], ensure_ascii=False) for a, b in zip(names, names[1:]))
    if ask["task"] == "entities":
        return json.dumps(list(dict.fromkeys(names)), ensure_ascii=False)
    if ask["task"] == "merge":
        return json.dumps(list(dict.fromkeys([*ask["before"], *ask["found"]])), ensure_ascii=False)
    if ask["task"] == "definitions":
        return "\n".join(["Answer: below", *(f"{r}: one name {r.replace('_', ' ')} another" for r in ask["relations"])])
    if ask["task"] == "choose":
        own = set(ask["relation"].split("_"))
        fits = [i for i, option in enumerate(ask["options"]) if own & set(option.split("_"))]
        return chr(65 + (fits[0] if fits else len(ask["options"])))
    if ask["task"] == "denoise":
        return " ".join(ask["text"].split())
    raise ValueError(ask["task"])


#: A model may take a prompt's fields as they are: the text of a document isn't written out and read for each of its triples.
offline.fields = _answer


# --- embeddings


#: Characters as numbers of 21 bits, so that up to three are one number.
BITS, PACKED = 21, 3


def _grams(padded: str, size: int) -> list[tuple[str, int]]:
    """n-grams with their numbers; a text shorter than one is one."""
    if len(padded) <= size or size > PACKED:
        return list(Counter(padded[i : i + size] for i in range(max(1, len(padded) - size + 1))).items())
    letters = np.frombuffer(padded.encode("utf-32-le"), np.uint32).astype(np.int64)
    packed = np.zeros(len(letters) - size + 1, np.int64)
    for k in range(size):
        packed = packed << BITS | letters[k : k + len(packed)]
    grams, counts = np.unique(packed, return_counts=True)
    mask = (1 << BITS) - 1
    return [("".join(chr(g >> BITS * k & mask) for k in range(size - 1, -1, -1)), n) for g, n in zip(grams.tolist(), counts.tolist())]


@functools.lru_cache(1 << 15)
def _digest(gram: str) -> int:
    return int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")


def hashed_grams(text: str, size: int = 3, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A unit vector of the text's character n-grams, each at a place and with a sign by its digest."""
    out = np.zeros(dimensions, np.float32)
    padded = f" {text.lower()} "
    for gram, n in _grams(padded, size):
        h = _digest(gram)
        out[h % dimensions] += n if h >> 32 & 1 else -n
    length = float(np.linalg.norm(out))
    return out / length if length else out


@F.pandas_udf(T.ArrayType(T.FloatType()))
def embed_udf(texts: pd.Series) -> pd.Series:
    """Offline embeddings; distinct texts of a batch are embedded once."""
    known = {t: hashed_grams(t or "").tolist() for t in texts.unique()}
    return texts.map(known)


Embedder = Callable[[str], Column]


# --- stages


def relations_and_entities(oie: Column) -> tuple[Column, Column]:
    """Distinct relations and entities of a list of triples, sorted."""
    both = F.flatten(F.transform(oie, lambda t: F.array(t["s"], t["o"])))
    return F.array_sort(F.array_distinct(F.transform(oie, lambda t: t["p"]))), F.array_sort(F.array_distinct(both))


def _extracted(docs: DataFrame, model: Backend, **options) -> DataFrame:
    found = asked(docs, "triples", model, F.col("input_text").alias("text"), F.col("entity_hint"), F.col("relation_hint"), **options)
    return found.withColumn("oie", F.coalesce(parsing.triples_udf(F.coalesce("response", F.lit(""))), F.array()).cast(f"array<{TRIPLE}>")).withColumnRenamed("error", "oie_error").drop("response")


def extracted(docs: DataFrame, model: Backend, **options) -> DataFrame:
    """docs (index, input_text, entity_hint, relation_hint) -> with oie, a list of triples, and oie_error."""
    return cut(_extracted(docs, model, **options))


def defined(docs: DataFrame, model: Backend, **options) -> DataFrame:
    """docs with oie -> with schema_definition, a map of relation to definition, and undefined, the relations without one."""
    wanted = relations_and_entities(F.col("oie"))[0]
    found = asked(docs, "definitions", model, F.col("input_text").alias("text"), wanted.alias("relations"), where=F.size("oie") > 0, **options)
    pairs = F.coalesce(native.relation_definitions(F.col("response")), F.array().cast("array<struct<relation:string,definition:string>>"))
    found = found.withColumn("schema_definition", F.map_from_entries(pairs)).drop("response", "error")
    return found.withColumn("undefined", F.array_except(wanted, F.map_keys("schema_definition")))


def embedded(schema: DataFrame, embed: Embedder, stored: DataFrame | None = None) -> DataFrame:
    """schema (relation, definition) with vectors; of relations whose vectors are stored already none is made again."""
    if stored is None:
        return cut(schema.withColumn("embedding", embed("definition")))
    new = schema.join(stored, "relation", "left_anti").withColumn("embedding", embed("definition"))
    return cut(stored.select("relation", "definition", "embedding").unionByName(new.select("relation", "definition", "embedding")))


def offered(wanted: DataFrame, vectors: DataFrame, k: int, embed: Embedder) -> DataFrame:
    """wanted (key, text) -> key, options (relations) and scores, the k relations nearest by inner product."""
    named = cut(vectors.withColumn("vec_id", F.xxhash64("relation")))
    asking = cut(wanted.select("key", F.xxhash64("key").alias("query_id"), embed("text").alias("embedding")))
    near = triples.top_k(asking.select("query_id", "embedding"), named.select("vec_id", "embedding"), k)
    ranked = F.array_sort(F.collect_list(F.struct("rank", "relation", "score")))
    # k of each key
    per = near.join(named.select("vec_id", "relation"), "vec_id").groupBy("query_id").agg(ranked.alias("r")).join(asking.select("key", "query_id"), "query_id")
    return per.select("key", F.transform("r", lambda x: x["relation"]).alias("options"), F.transform("r", lambda x: x["score"]).alias("scores"))


def _told(rows: DataFrame, model: Backend, concurrency: int = 8, **options) -> DataFrame:
    """rows (index, shared, oie, infos) -> index, places, chosen: of each triple its relation's place in infos and the
    schema's relation, null where there is none.

    The prompt is `shared`, a JSON object of the task and the text, with the triple's fields added; a model with `fields`
    gets them without the text being written out for each triple. Equal triples of a document are asked about once.
    """
    fields = getattr(model, "fields", None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = asker(fields or (lambda prompt: model(prompt())), **options)
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in (whole.slice(k, HELD) for whole in batches for k in range(0, whole.num_rows, HELD)):
                jobs, rows = {}, []
                oie = batch.column("oie")
                ends = oie.offsets.to_pylist()
                held = oie.values.slice(ends[0], ends[-1] - ends[0])  # a slice of a batch has the values of all of it
                ends, cells = [e - ends[0] for e in ends], [held.field(c).to_pylist() for c in "spo"]
                for i, (shared, infos) in enumerate(zip(batch.column("shared").to_pylist(), batch.column("infos").to_pylist())):
                    place = {x["p"]: k for k, x in enumerate(infos)}
                    mine = list(zip(*(c[ends[i] : ends[i + 1]] for c in cells)))
                    places = [place[p] for _, p, _ in mine]
                    asks = [not x["known"] and bool(x["options"]) for x in infos]
                    base = json.loads(shared) if fields else None
                    for t, k in zip(mine, places):
                        if asks[k] and (i, t) not in jobs:
                            rest = {"triple": dict(zip("spo", t)), "relation": t[1], "definition": infos[k]["definition"], "options": infos[k]["options"]}
                            jobs[i, t] = {**base, **rest} if fields else functools.partial(_joined, shared, rest)
                    rows.append((mine, infos, places))
                answers = dict(zip(jobs, at_once(pool, ask, [(str(key), job) for key, job in jobs.items()], concurrency)))
                chosen = [[t[1] if infos[k]["known"] else _option(infos[k]["options"], answers.get((i, t))) for t, k in zip(mine, places)] for i, (mine, infos, places) in enumerate(rows)]
                yield pa.RecordBatch.from_arrays([batch.column("index"), pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array(chosen, pa.list_(pa.string()))], ["index", "places", "chosen"])

    return rows.mapInArrow(run, T.StructType([rows.schema["index"]]).add("places", T.ArrayType(T.IntegerType())).add("chosen", T.ArrayType(T.StringType())))


def _joined(shared: str, rest: dict) -> str:
    return f"{shared[:-1]},{json.dumps(rest, ensure_ascii=False, separators=(',', ':'))[1:]}"


def _option(options: list[str] | None, answer: tuple | None) -> str | None:
    """The option that the answer's first character names, as `canonical.chosen` has it."""
    place = ord(answer[1][0]) - ord("A") if answer and answer[1] else -1
    return options[place] if options and 0 <= place < len(options) else None


def canonicalised(docs: DataFrame, schema: DataFrame, model: Backend, embed: Embedder = embed_udf, k: int = OFFERED, enrich: bool = False, texts: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """docs (index, input_text, oie, schema_definition) -> (docs with canonical and candidates, the schema afterwards).

    canonical: triples with the schema's relation, p null where there is none. candidates: pos, options, scores of the
    triples that were offered some. Only relations that the schema lacks and that have a definition meet the model.
    Indexes are unlike and so are texts, else equal prompts of two documents are called twice. texts (index, input_text):
    where docs don't hold them. A text is never copied to its triples: relations are looked up for each document.
    """
    schema = schema.dropDuplicates(["relation"])
    own = docs.select("index", "schema_definition", F.explode(F.array_distinct(F.transform("oie", lambda t: t["p"]))).alias("p")).select("index", "p", F.element_at("schema_definition", F.col("p")).alias("definition"))
    own = own.join(schema.select(F.col("relation").alias("p"), F.lit(True).alias("known")), "p", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if schema.isEmpty():
        own = own.withColumn("options", F.lit(None).cast("array<string>")).withColumn("scores", F.lit(None).cast("array<double>"))
    else:
        # a definition is looked up once, however many triples have it
        own = own.withColumn("key", F.when(~F.col("known") & F.col("definition").isNotNull(), F.xxhash64("definition")))
        near = offered(own.where("key is not null").select("key", F.col("definition").alias("text")).distinct(), embedded(schema, embed), k, embed)
        own = own.join(near, "key", "left")
    # the relations of one document
    infos = own.groupBy("index").agg(F.collect_list(F.struct("p", "known", "definition", "options", "scores")).alias("infos"))
    rows = stored(docs.select("index", "oie").join(infos, "index"))
    open_ = F.exists("infos", lambda x: ~x["known"] & F.coalesce(F.size(x["options"]) > 0, F.lit(False)))
    shared = F.to_json(F.struct(F.lit("choose").alias("task"), F.col("input_text").alias("text"))).alias("shared")
    with_text = rows.where(open_).join((docs if texts is None else texts).select("index", "input_text"), "index").select("index", shared, "oie", "infos")
    without = rows.where(~open_).select("index", F.lit("{}").alias("shared"), "oie", "infos")
    told = stored(rows.join(_told(with_text.unionByName(without), model, **options), "index"))
    added = None
    chosen = F.col("chosen")
    if enrich:
        lost = told.select("index", F.posexplode(F.arrays_zip("places", "chosen")).alias("pos", "x"), "infos").where("x.chosen is null").select("index", "pos", F.get("infos", F.col("x.places")).alias("i"))
        added = stored(lost.where("i.definition is not null").groupBy(F.col("i.p").alias("relation")).agg(F.min_by("i.definition", F.struct("index", "pos")).alias("definition")))
        # a lost relation of any document takes the name that was added, with a definition of its own or not
        mine = told.select("index", F.explode("infos").alias("i")).select("index", F.col("i.p").alias("relation")).join(added.select("relation"), "relation", "left_semi").groupBy("index").agg(F.collect_set("relation").alias("new"))
        told = told.join(mine, "index", "left")
        chosen = F.zip_with("places", "chosen", lambda k, c: F.coalesce(c, F.when(F.array_contains(F.coalesce("new", F.array().cast("array<string>")), F.get("infos", k)["p"]), F.get("infos", k)["p"])))
    per = told.select(
        "index", F.zip_with("oie", chosen, lambda t, c: F.struct(t["s"].alias("s"), c.alias("p"), t["o"].alias("o"))).alias("canonical"),
        F.filter(F.transform("places", lambda k, i: F.struct(i.alias("pos"), F.get("infos", k)["options"].alias("options"), F.get("infos", k)["scores"].alias("scores"))), lambda x: F.coalesce(F.size(x["options"]) > 0, F.lit(False))).alias("candidates"),
    )
    empty = lambda c: F.coalesce(c, F.array().cast(per.schema[c].dataType))
    out = docs.join(per, "index", "left").withColumn("canonical", empty("canonical")).withColumn("candidates", empty("candidates"))
    return out, schema if added is None else cut(schema.select("relation", "definition").unionByName(added))


def hinted(docs: DataFrame, before: DataFrame, schema: DataFrame, model: Backend, embed: Embedder = embed_udf, k: int = HINTED, unlike: bool = False, **options) -> DataFrame:
    """docs (index, input_text) with entity_hint and relation_hint for another round, from the canonical triples before."""
    kept = before.select("index", F.filter("canonical", lambda t: t["p"].isNotNull()).alias("kept"))
    relations, entities = relations_and_entities(F.col("kept"))
    seen = kept.select("index", relations.alias("relations"), entities.alias("before"))
    found = asked(docs.select("index", "input_text"), "entities", model, F.col("input_text").alias("text"), unlike=unlike, **options).drop("input_text")
    found = found.withColumn("found", F.coalesce(parsing.entities_udf(F.coalesce("response", F.lit("")))["entities"], F.array().cast("array<string>"))).drop("response", "error").join(seen, "index")
    merged = asked(found, "merge", model, F.col("before"), F.col("found"), **options)
    merged = merged.withColumn("entity_hint", F.coalesce(parsing.entities_udf(F.coalesce("response", F.lit("")))["entities"], hints.entity_hint(F.col("before"), F.col("found"))))
    merged = stored(merged.select("index", "entity_hint", "relations"))
    near = offered(docs.select(F.col("index").alias("key"), F.col("input_text").alias("text")), embedded(schema, embed), k, embed)
    rows = merged.join(near, merged["index"] == near["key"], "left").select(F.col("index").alias("doc_id"), F.col("relations").alias("before"), F.col("options").alias("retrieved"))
    run = kept.select(F.explode("kept").alias("t")).select("t.s", "t.p", "t.o")
    text = hints.relation_hints(rows, schema, run).withColumnRenamed("doc_id", "index")
    told = stored(merged.join(text, "index").select("index", F.array_join("entity_hint", ", ").alias("entity_hint"), F.col("hint").alias("relation_hint")))
    return docs.select("index", "input_text").join(told, "index")


def refined(docs: DataFrame, schema: DataFrame, model: Backend, iterations: int = 0, embed: Embedder = embed_udf, enrich: bool = False, each: Callable[[int, DataFrame], None] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """docs (index, input_text) -> (stage results of the last round, the schema afterwards); iterations: rounds after the first.

    A round's hints come from the round before. each: called with the number and the stage results of every round.
    All that becomes of a document follows from its text, so equal texts go through the rounds once, under the first of
    their indexes, and every document gets its text's results. Stages are stored without texts.
    """
    digest = F.coalesce(F.sha2("input_text", 256), F.lit("")).alias("digest")
    first = F.min_by(F.struct("index", "input_text"), "index").alias("first")
    texts = stored(docs.select("index", "input_text", digest).groupBy("digest").agg(first).select("first.index", "first.input_text", "digest"))
    none = F.lit("").alias("entity_hint"), F.lit("").alias("relation_hint")
    now, stages, whole = texts.select("index", "input_text", *none), None, None
    for k in range(iterations + 1):
        if stages is not None:
            now = hinted(texts, stages, schema, model, embed, unlike=True, **options)
        found = stored(defined(_extracted(now, model, unlike=True, **options), model, unlike=True, **options).drop("input_text"))
        stages, schema = canonicalised(found, schema, model, embed, enrich=enrich, texts=texts, **options)
        if k < iterations or each is not None:
            stages = stored(stages)
        named = stages.join(texts.select("index", "digest"), "index").drop("index")
        whole = docs.select("index", "input_text", digest).join(named, "digest").drop("digest")
        if each is not None:
            each(k, whole)
    return whole, schema


def denoised_rounds(docs: DataFrame, model: Backend, rounds: int = 1, **options) -> DataFrame:
    """Entities, then a text without noise, then triples; each round reads the text that the one before left."""
    now = docs.select("index", "input_text")
    for _ in range(rounds):
        found = asked(now, "entities", model, F.col("input_text").alias("text"), **options)
        told = found.select("index", "input_text", F.coalesce(parsing.entities_udf(F.coalesce("response", F.lit("")))["entities"], F.array().cast("array<string>")).alias("entities"))
        clean = asked(told, "denoise", model, F.col("input_text").alias("text"), F.col("entities"), **options)
        # a text that the model didn't give back stays as it was
        now = cut(clean.select("index", F.coalesce("response", "input_text").alias("input_text"), "entities"))
    if "entities" not in now.columns:
        now = now.withColumn("entities", F.array().cast("array<string>"))
    hinted_ = now.select("index", "input_text", F.array_join("entities", ", ").alias("entity_hint"), F.lit("").alias("relation_hint"))
    return extracted(hinted_, model, **options).select("index", "input_text", "entity_hint", "oie")
