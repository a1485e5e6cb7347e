import random

from pyspark.sql import functions as F

from textloom.operators import hints, lexnorm


def test_alignment_pads_and_cuts(spark):
    rows = spark.createDataFrame([(1, [["a", "b"], ["c"]], [["x"], ["y", "z"]], [["r", "s", "t"], []])], "id int, source array<array<string>>, target array<array<string>>, rule_01 array<array<string>>")
    got = lexnorm.aligned(rows, rules=("rule_01",)).first()
    assert got["input_pieces"] == ["<s>", "a", "b", "c", "<mask>", "</s>"]
    assert got["output_pieces"] == ["<s>", "x", "<space>", "y", "z", "</s>"]
    assert got["align_index"] == [0, 0, 1, 1] and got["sent_len"] == 6
    assert got["weak_labels"] == [["<s>"], ["r"], ["s"], ["<space>"], ["<space>"], ["</s>"]]
    bare = lexnorm.aligned(rows, target=None).first()
    assert bare["input_pieces"] == ["<s>", "a", "b", "c", "</s>"] and bare["weak_labels"] == [[]] * 5
    assert [tuple(x) for x in spark.range(1).select(lexnorm.without_ends(F.array(F.lit("<s>"), F.lit("k"), F.lit("</s>"))).alias("x")).first()["x"]] == [(1, "k")]


def test_suggestions(spark):
    rows = [(1, 0, "abc", "abd", 0.95), (1, 1, "abc", "abd", 0.99), (1, 2, "ab", "ac", 0.99), (1, 3, "Abc", "abd", 0.99), (1, 4, "abe", "abf", 0.5), (2, 0, "x1y", "xyz", 0.99)]
    rows += [(3, i, "a" * (i + 3), "b" * (i + 3), 0.9) for i in range(15)]
    got = lexnorm.suggestions(spark.createDataFrame(rows, "doc_id int, pos int, source string, replacement string, confidence double")).collect()
    assert [(r["doc_id"], r["confidence"]) for r in got if r["doc_id"] != 3] == [(1, 0.99)]
    assert sorted(r["pos"] for r in got if r["doc_id"] == 3) == list(range(12))


def test_merged_spans(spark):
    spans = spark.createDataFrame([(1, 4, 6, "cd"), (1, 0, 2, "ab"), (1, 2, 4, "xy"), (1, 7, 8, "e"), (2, 0, 1, "f")], "doc int, begin int, end int, text string")
    assert sorted(tuple(r) for r in lexnorm.merged_spans(spans, "doc").collect()) == [(1, 0, 6, "abxycd"), (1, 7, 8, "e"), (2, 0, 1, "f")]


def test_rule_attention_equals_the_dense_form(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    e, b, labels = rng.normal(size=(4, 5)), rng.normal(size=4), 6
    rows = [(i, rng.normal(size=5).tolist(), rng.integers(-1, labels, 4).tolist()) for i in range(60)] + [(60, [0.0] * 5, [-1] * 4)]
    df = spark.createDataFrame(rows, "id int, hidden array<double>, votes array<int>")
    got = {r["id"]: (r["label_pred"], r["probability"]) for r in lexnorm.attended(df, "votes", "hidden", e.tolist(), b.tolist(), labels).collect()}
    for i, h, v in rows:
        att = 1 / (1 + np.exp(-(e @ np.array(h) + b)))
        fired = np.array(v) != -1
        y = sum((a * np.eye(labels)[k] for a, k in zip(att[fired], np.array(v)[fired])), np.zeros(labels))
        y = y + (fired.sum() - att[fired].sum()) / labels + 1e-5
        y /= y.sum()
        assert got[i][0] == (int(y.argmax()) if fired.any() and y.max() >= 0.5 else -1)
        assert not fired.any() or abs(got[i][1] - y.max()) < 1e-9
    silent = spark.createDataFrame([(1, [-1, -1]), (2, [-1, 0]), (3, []), (4, None)], "id int, labels array<int>")
    assert [r["id"] for r in lexnorm.without_silent(silent, "labels").collect()] == [2]


def test_sampling_and_augmentation(spark):
    rows = spark.createDataFrame([(i, "é") for i in range(50)], "id int, text string")
    first, again = (sorted(r["id"] for r in lexnorm.downsampled(rows.repartition(n), "id", 7, 1).collect()) for n in (1, 5))
    assert first == again and len(set(first)) == 7
    both = lexnorm.with_unaccented(rows.limit(1), "text").collect()
    assert {(r["text"], r["augmented"]) for r in both} == {("e", True), ("é", False)}


def test_hints(spark):
    rows = spark.createDataFrame([(1, ["b"], ["a", "b", "zz"]), (2, None, None)], "doc_id int, before array<string>, retrieved array<string>")
    schema = spark.createDataFrame([("a", "is a"), ("b", None)], "relation string, definition string")
    run = spark.createDataFrame([("x", "a", "y")], "s string, p string, o string")
    got = {r["doc_id"]: r["hint"] for r in hints.relation_hints(rows, schema, run).collect()}
    assert got == {1: "1. b: \n2. a: is a Example: [x, a, y]", 2: ""}


def test_first_sentences_equal_the_walk(spark):
    rng = random.Random(5)
    rows = [(i, [f"r{rng.randrange(30)}" for _ in range(rng.randrange(0, 4))]) for i in range(80)]
    for limit in (None, 5):
        seen, want, n = set(), [], 0
        for i, relations in rows:
            if relations and not seen & set(relations) and (limit is None or n < limit):
                want.append(i)
                n += len(set(relations))
                seen |= set(relations)
        df = spark.createDataFrame(rows, "pos int, relations array<string>").repartition(3)
        assert sorted(r["pos"] for r in hints.first_sentences(df, limit).collect()) == want
    assert hints.first_sentences(spark.createDataFrame([], "pos int, relations array<string>")).count() == 0


def test_spans_of_flagged_pieces_merge(spark):
    rows = spark.createDataFrame([(1, ["ko", " ", "b", "t", "!"], [True, False, True, True, False])], "id int, pieces array<string>, flags array<boolean>")
    assert sorted(map(tuple, lexnorm.nonstandard_spans(rows, "id", "pieces", "flags").collect())) == [(1, 0, 2, "ko"), (1, 3, 5, "bt")]


def test_likeliest_best_epoch_and_word_confidence(spark):
    row = spark.createDataFrame([([0.1, 0.5, 0.1, 0.3],)], "p array<double>").select(lexnorm.likeliest(F.col("p"), 3).alias("k"), lexnorm.word_confidence(F.col("p")).alias("c")).first()
    assert [tuple(x) for x in row["k"]] == [(1, 0.5), (3, 0.3), (0, 0.1)] and row["c"] == 0.1
    epochs = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7), (4, 0.1)], "epoch int, performance double")
    assert tuple(lexnorm.best_epoch(epochs).first()) == (3, 0.7)


def test_suggester_parts_and_statuses(spark):
    texts = spark.createDataFrame([("a", "kob vui"), ("b", "all fine"), ("c", "kob " * 400), ("d", "x" * 900)], "id string, text string")
    words = F.filter(F.split("part", " "), lambda w: w == "kob")
    suggest = F.transform(words, lambda w: F.struct(w.alias("source"), F.lit("khong").alias("replacement"), F.lit(0.95).alias("confidence")))
    got = {r["id"]: (r["suggestion_status"], [tuple(x) for x in r["suggestions"]]) for r in lexnorm.suggested(texts, suggest, F.length("part"), F.lit(True)).collect()}
    assert got["a"] == ("suggested", [("kob", "khong", 0.95)]) == got["c"] and got["b"] == ("unchanged", []) and got["d"] == ("skipped", [])
