from collections import defaultdict

from pyspark.sql import functions as F

from textloom.operators import retriever

ROWS = "row_id long, sentence string, triples array<array<string>>, definitions map<string,string>"


def test_numbered_ranks_within_groups(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), F.md5(F.col("id").cast("string").cast("binary")).alias("key"))
    seen = defaultdict(list)
    for r in retriever.numbered(rows, "key", "g").collect():
        seen[r["g"]].append((r["number"], r["key"]))
    for got in seen.values():
        got.sort()
        assert [n for n, _ in got] == list(range(len(got))) and [k for _, k in got] == sorted(k for _, k in got)


def test_samples_pair_positives_with_foreign_relations(spark):
    rows = [(i, f"Ann {i} met Bob", [["Ann", f"r{i % 9}", "bob"], ["Ann", f"r{i % 4}", "Bob"], ["Ann", "r5", "Eve"], ["Ann", "undefined", "Bob"], ["Ann", "r1"]], {f"r{i % 9}": f"d{i}", f"r{i % 4}": f"d{i}", "r5": f"d{i}"}) for i in range(300)]
    got = retriever.retriever_samples(spark.createDataFrame(rows, ROWS).repartition(5)).collect()
    again = retriever.retriever_samples(spark.createDataFrame(rows, ROWS).repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    known, per = defaultdict(set), defaultdict(list)
    for _, _, _, definitions in rows:
        for relation, text in definitions.items():
            known[relation].add(text)
    for r in got:
        per[r["row_id"]].append(r)
        assert r["negative"].split(": ")[1] in known[r["negative_relation"]]
        assert all(t[1] == r["positive_relation"] for t in r["positive_triples"])
    for i in range(300):
        positives = list(dict.fromkeys([f"r{i % 9}", f"r{i % 4}"]))
        mine = sorted(per[i], key=lambda r: r["k"])
        assert [r["positive_relation"] for r in mine] == positives
        negatives = [r["negative_relation"] for r in mine]
        assert len(set(negatives)) == len(negatives) and not set(negatives) & set(positives)
    assert len({r["negative_relation"] for r in got}) == 9
    assert [(r["row_id"], r["k"]) for r in retriever.retriever_samples(spark.createDataFrame(rows, ROWS), size=3).collect()] == [(0, 1), (1, 1), (2, 1)]


def test_samples_without_negatives_nulls_and_empty(spark):
    rows = [(1, "a b", [["a", "r", "b"]], {"r": "d"}), (2, None, [["a", "r", "b"]], {"r": "d"}), (3, "a b", None, {"r": None}), (4, "a b", [["a", "r", None]], None), (5, "", [], {})]
    df = spark.createDataFrame(rows, ROWS)
    assert retriever.retriever_samples(df).count() == 0
    assert retriever.retriever_samples(df.limit(0)).count() == 0


def test_split_shares(spark):
    rows = retriever.split_shares(spark.range(20000), "id", {"train": 0.75, "test": 0.125, "valid": 0.125})
    n = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert abs(n["train"] - 15000) < 300 and abs(n["test"] - 2500) < 200 and sum(n.values()) == 20000
    assert retriever.split_shares(spark.range(3), "id", {"all": 1.0}).where("split = 'all'").count() == 3
