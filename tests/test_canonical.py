from textloom.operators import canonical


def test_known_chosen_and_unmatched(spark):
    rows = spark.createDataFrame([(1, 0, "a", "in", "b"), (1, 1, "a", "near", "b"), (1, 2, "a", "far", "b"), (1, 3, "a", "odd", "b"), (1, 4, "a", None, "b"), (1, 5, "a", "gone", "b"), (1, 6, "a", "low", "b")], "doc_id long, pos int, s string, p string, o string")
    schema = spark.createDataFrame([("in",), ("in",)], "relation string")
    options = ["at", "by"]
    answers = spark.createDataFrame([(1, 0, options, "B"), (1, 1, options, "B. by"), (1, 2, options, "C"), (1, 3, options, ""), (1, 5, None, "A"), (1, 6, options, "a")], "doc_id long, pos int, options array<string>, response string")
    got = {r["pos"]: (r["p"], r["how"]) for r in canonical.canonicalised(rows, schema, answers).collect()}
    assert got == {0: ("in", "known"), 1: ("by", "chosen"), **{k: (None, "unmatched") for k in (2, 3, 4, 5, 6)}}
    assert canonical.canonicalised(rows.limit(0), schema, answers).count() == 0
    assert canonical.canonicalised(rows, schema.limit(0), answers.limit(0)).where("how = 'unmatched'").count() == 7
