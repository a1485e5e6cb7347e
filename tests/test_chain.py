"""The chain from records to a verified graph, with offline models."""

import hashlib
import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import native, parsing
from textloom.plans import corpus, edc
from textloom.plans.progress import progress
from textloom.sources import sinks

TEXTS = [("d1", "Ann met Bob. Bob met Ann"), ("d2", "Zoe knows Ann"), ("d3", "no names here"), ("d4", "  ")]
SCHEMA = "relation string, definition string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "index string, input_text string")


def canonical(stages):
    return {r["index"]: [tuple(t) for t in r["canonical"]] for r in stages.collect()}


def test_known_relations_stay_and_unknown_ones_meet_the_model(spark, docs):
    schema = spark.createDataFrame([("followed_by", "one name followed by another"), ("lives_in", "a place")], SCHEMA)
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        if json.loads(prompt)["task"] == "choose":
            calls.add(1)
        return edc.offline(prompt)

    rounds = []
    stages, after = edc.refined(docs, schema, model, iterations=1, each=lambda k, s: rounds.append((k, s.count())))
    assert rounds == [(0, 4), (1, 4)] and after.count() == 2
    got = canonical(stages)
    assert got["d1"] == [("Ann", "followed_by", "Bob"), ("Bob", "followed_by", "Bob"), ("Bob", None, "Ann")] and got["d2"] == [("Zoe", None, "Ann")] and got["d3"] == got["d4"] == []
    assert calls.value == 4  # two unknown triples in each of two rounds
    row = {r["index"]: r for r in stages.collect()}["d1"]
    assert row["candidates"][0]["pos"] == 2 and set(row["candidates"][0]["options"]) == {"followed_by", "lives_in"}
    assert "1. followed_by: one name followed by another" in row["relation_hint"] and "Ann" in row["entity_hint"].split(", ")


def test_enrichment_adds_what_nothing_fits_and_an_empty_schema_grows(spark, docs):
    empty = spark.createDataFrame([], SCHEMA)
    lost, same = edc.refined(docs, empty, edc.offline)
    assert same.count() == 0 and all(t[1] is None for v in canonical(lost).values() for t in v)
    found, schema = edc.refined(docs, empty, edc.offline, enrich=True)
    assert {r["relation"] for r in schema.collect()} == {"followed_by", "comes_after"}
    assert canonical(found)["d1"] == [("Ann", "followed_by", "Bob"), ("Bob", "followed_by", "Bob"), ("Bob", "comes_after", "Ann")]


def test_failing_models_leave_rows_with_errors(spark, docs):
    def broken(prompt):
        raise RuntimeError("down")

    stages, _ = edc.refined(docs, spark.createDataFrame([("a", "b")], SCHEMA), broken, iterations=1)
    assert canonical(stages) == {k: [] for k, _ in TEXTS} and {r["oie_error"] for r in stages.collect()} == {"RuntimeError"}


def test_embeddings_are_unit_vectors_made_once(spark):
    schema = spark.createDataFrame([("a", "one thing"), ("b", "two things")], SCHEMA)
    first = edc.embedded(schema.limit(1), edc.embed_udf)
    both = edc.embedded(schema, edc.embed_udf, first).collect()
    assert len(both) == 2 and all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-5 for r in both)
    assert edc.hashed_grams("same").tolist() == edc.hashed_grams("Same").tolist()


def test_denoised_rounds(docs):
    got = {r["index"]: r for r in edc.denoised_rounds(docs, edc.offline, rounds=2).collect()}
    assert [t["s"] for t in got["d1"]["oie"]] == ["Ann", "Bob", "Bob"] and got["d1"]["entity_hint"] == "Ann, Bob"


RECORDS = [("a", "Ann met Bob. " * 30), ("b", "<p>Short &amp; sweet</p>"), ("c", "<br> "), ("d", None)]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(RECORDS, "id string, text string")


def test_prepared_segments(records):
    rows = {r["id"]: r for r in corpus.prepared(records, limit=100).collect()}
    assert rows["b"]["clean_text"] == "Short & sweet" and rows["b"]["status"] == "ready" and rows["c"]["status"] == rows["d"]["status"] == corpus.EMPTY
    parts = sorted((r for i, r in rows.items() if i.startswith("a::part")), key=lambda r: r["part"])
    assert len(parts) > 3 and all(len(p["clean_text"]) <= 100 and p["part"] == k and p["id"] == f"a::part{k}" for k, p in enumerate(parts, 1)) and " ".join(p["clean_text"] for p in parts) == ("Ann met Bob. " * 30).strip()
    assert parts[0]["source_id"] == "a" and parts[0]["raw_text"] == RECORDS[0][1] and parts[0]["correction_status"] == "not_requested"


def test_corrections_are_taken_only_where_safe(records):
    def model(prompt):
        text = json.loads(prompt)["text"]
        return text.replace("sweet", "sweat") if "Short" in text else "something else"

    rows = {r["id"]: r for r in corpus.prepared(records, limit=100, correct=model).collect()}
    assert (rows["b"]["clean_text"], rows["b"]["normalized_text"], rows["b"]["correction_status"]) == ("Short & sweat", "Short & sweet", "accepted")
    assert rows["a::part1"]["correction_status"] == "rejected" and rows["a::part1"]["clean_text"].startswith("Ann met Bob.")
    with pytest.raises(ValueError, match="not both"):
        corpus.prepared(records, correct=model, write=model, review=model)


def test_suggestions_are_recorded_and_agents_route(spark, records):
    def write(prompt):
        source = json.loads(prompt)["source"]
        return json.dumps({"action": "drop" if "Short" in source else "keep", "text": "" if "Short" in source else source, "answer": None, "explanation": None, "reason": "r"})

    suggest = lambda rows: rows.where("text like 'Short%'").select("id", F.array(F.struct(F.lit("sweet").alias("source"), F.lit("sweat").alias("replacement"), F.lit(0.95).alias("confidence"))).alias("suggestions"), F.lit("suggested").alias("suggestion_status"))
    rows = {r["id"]: r for r in corpus.prepared(records, limit=1000, suggest=suggest, write=write, review=lambda p: '{"passed": true, "feedback": ""}').collect()}
    assert rows["b"]["status"] == "skipped_dropped" and rows["a"]["status"] == "ready" and rows["a"]["agent_action"] == "keep"
    assert rows["b"]["suggestions"][0]["replacement"] == "sweat" and rows["b"]["clean_text"] == "Short & sweet" and rows["a"]["suggestion_status"] == "unchanged"


def test_results_must_belong_to_their_segments(spark, records):
    segments = corpus.prepared(records, limit=1000)
    stages = lambda rows: spark.createDataFrame(rows, "index string, input_text string, canonical array<struct<s:string,p:string,o:string>>")
    text = ("Ann met Bob. " * 30).strip()
    good = [("a", text, [("Bob", "r", "Ann"), ("Bob ", "r", "Ann"), ("met Bob.", "r", "Ann"), ("Ann", None, "x"), (" ", "r", "x")]), ("b", "Short & sweet", [])]
    assert corpus.mismatches(segments, stages(good)).count() == 0
    wrong = [("a", "other", []), ("b", "Short & sweet", []), ("b", "Short & sweet", []), ("z", "x", [])]
    assert {tuple(r) for r in corpus.mismatches(segments, stages(wrong)).collect()} == {("a", "another text"), ("b", "several results"), ("z", "no segment")}
    with pytest.raises(ValueError, match="a: no result"):
        corpus.judged(segments, stages(good[1:]))
    got = {r["pos"]: r for r in corpus.judged(segments, stages(good)).collect()}
    assert {k: (r["label"], r["error"]) for k, r in got.items()} == {0: ("NO", None), 2: ("YES", None), 4: (None, "blank cell")}
    down = corpus.judged(segments, stages(good), judge=lambda p: 1 / 0).where("pos = 0").first()
    assert (down["label"], down["error"]) == ("UNSURE", "ZeroDivisionError")


def test_outputs(spark, records, tmp_path):
    segments = corpus.prepared(records, limit=1000)
    sinks.write_prepared(segments, str(tmp_path / "run"))
    lines = [x for f in sorted(os.listdir(tmp_path / "run/input")) if f.startswith("part") for x in open(tmp_path / "run/input" / f).read().splitlines()]
    assert lines == [("Ann met Bob. " * 30).strip(), "Short & sweet"]
    schema = spark.createDataFrame([("followed_by", "x")], SCHEMA)
    stages, _ = edc.refined(corpus.model_inputs(segments), schema, edc.offline, each=lambda k, s: sinks.write_stages(s.withColumn("index", F.col("index")), str(tmp_path / "edc"), k))
    graph = corpus.graph(segments, corpus.judged(segments, stages))
    sinks.write_graph(graph, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/kg")).count() == 2
    stage = spark.read.json(str(tmp_path / "edc/iter0/result")).where("index = 'a'").first()
    assert stage["oie"][0] == ["Ann", "followed_by", "Bob"] and "schema_canonicalizaiton" in stage.asDict()
    printed = spark.read.text(str(tmp_path / "edc/iter0/canon")).collect()
    assert printed[0][0].startswith("[['Ann', 'followed_by', 'Bob']")


def test_judged_prompts_descriptions_and_classifiers(spark):
    def model(prompt):
        if "down" in prompt:
            raise RuntimeError
        return "I know this." if "know" in prompt else "Yes, this is true. (confidence: 0.912)"

    rows = spark.createDataFrame([("a",), ("down",), ("a know",), ("a",)], "prompt string")
    got = {(r["prompt"], r["verdict"], r["error"]) for r in corpus.judged_prompts(rows, model).collect()}
    assert got == {("a", True, None), ("down", None, "RuntimeError"), ("a know", False, None)}  # `no` inside a word denies, as the protocol has it
    verdict, confidence = native.scored_judgment(F.col("t"))
    texts = spark.createDataFrame([("Yes, this is true. (confidence: 0.912)",), ("no (confidence: .5)",), ("maybe",)], "t string")
    assert [tuple(r) for r in texts.select(verdict, confidence).collect()] == [(True, 0.912), (False, 0.5), (None, None)]
    graphs = spark.createDataFrame([(1, [("a", "r", "b")])], "graph_id int, triples array<struct<s:string,p:string,o:string>>")
    assert corpus.described(graphs, lambda p: " ".join(json.loads(p)["triples"][0].values())).first()["description"] == "a r b"


def test_progress_holds_no_texts(caplog):
    with caplog.at_level("INFO", logger="textloom.progress"):
        progress("chunk", number=3, status="accepted", seconds=0.5)
    assert json.loads(caplog.records[0].message)["number"] == 3
    for bad in ("two words", "x" * 65, ["list"]):
        with pytest.raises(ValueError, match="short name"):
            progress("chunk", text=bad)


def test_a_long_text_is_not_copied_to_its_triples(spark):
    """8,000 triples of 1 MB of text, half of them asked about: 4 GB of prompts, if each were written out."""
    text = "Bob Ann " * 4000 + "word " * 200_000
    docs = spark.createDataFrame([("d", text), ("e", text)], "index string, input_text string")
    schema = spark.createDataFrame([("followed_by", "one name followed by another"), ("lives_in", "a place")], SCHEMA)
    began = time.perf_counter()
    stages, _ = edc.refined(docs, schema, edc.offline)
    got = stages.select("index", F.explode("canonical").alias("t")).groupBy("index").agg(F.count("t.p").alias("known"), F.count("*").alias("n")).collect()
    assert sorted(map(tuple, got)) == [("d", 3999, 7999), ("e", 3999, 7999)] and time.perf_counter() - began < 60


def test_equal_texts_are_asked_once_and_all_get_results(spark):
    texts = [*TEXTS, ("d5", TEXTS[0][1]), ("d0", TEXTS[0][1]), ("d6", None), ("d7", None)]
    docs = spark.createDataFrame(texts, "index string, input_text string")
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        calls.add(1)
        return edc.offline(prompt)

    schema = spark.createDataFrame([("followed_by", "one name followed by another")], SCHEMA)
    plain, grown = edc.refined(docs, schema, model, enrich=True)
    assert calls.value == 5 + 2 + 2  # triples of five texts (a missing one fails), definitions of two, two unknown triples
    with_fields, _ = edc.refined(docs, schema, edc.offline, enrich=True)
    assert canonical(plain) == canonical(with_fields) and len(canonical(plain)) == 8
    assert canonical(plain)["d0"] == canonical(plain)["d1"] == canonical(plain)["d5"] == [("Ann", "followed_by", "Bob"), ("Bob", "followed_by", "Bob"), ("Bob", "comes_after", "Ann")]
    assert {r["relation"] for r in grown.collect()} == {"followed_by", "comes_after"} and canonical(plain)["d6"] == []


def test_embeddings_equal_a_walk_over_their_grams():
    for text in ("", "a", "ab", "Ann met Ann, ßİ 𝔘nd so on " * 5):
        for size in (1, 2, 3, 4):
            want, padded = np.zeros(edc.DIMENSIONS, np.float32), f" {text.lower()} "
            for i in range(max(1, len(padded) - size + 1)):
                h = int.from_bytes(hashlib.blake2b(padded[i : i + size].encode(), digest_size=8).digest(), "little")
                want[h % edc.DIMENSIONS] += 1.0 if h >> 32 & 1 else -1.0
            length = float(np.linalg.norm(want))
            assert edc.hashed_grams(text, size).tolist() == (want / length if length else want).tolist()


def test_plain_triples_are_read_as_literals_are():
    def walked(text):
        opened, found = [], []
        for i, c in enumerate(text):
            if c == "[":
                opened.append(i)
            elif c == "]" and opened:
                value = parsing._literal(text[opened.pop() : i + 1])
                if isinstance(value, list) and len(value) == 3:
                    cells = [", ".join(map(str, v)) if isinstance(v, list) else v for v in value]
                    if all(isinstance(v, str) and v.strip() and v.strip() != "_" for v in cells):
                        found.append(tuple(v.strip() for v in cells))
        return found

    rng, bits = random.Random(5), ['"', '"a', "b", '", "', "[", "]", '["a", "r", "b"]', ", ", "'", "\\n", "\n", "\x00", " ", '"_"', "#", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(12)))
        assert parsing.triples(text) == walked(text), text
    assert parsing.triples('x [" Ann", "met", "Bob "] ["a", "_", "b"]') == [("Ann", "met", "Bob")]
