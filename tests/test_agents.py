import json

from textloom.functions import parsing, segment
from textloom.plans import agents, model_stage

RECORDS = "record_id string, text string"


def walk(key, source, writer, reviewer, rounds=3, depth=0):
    """One record after the other: (status, action, text, attempts)."""
    if not (source or "").strip():
        return "skipped_empty_after_cleanup", "none", "", 0
    rejected = []
    for attempt in range(1, rounds + 1):
        try:
            answer = writer(json.dumps({"source": source, "rules": [], "rejected": rejected}))
        except model_stage.OutputTruncated:
            cuts = segment.chunks(source, max(100, len(source) // 2)) if depth < 3 else []
            if len(cuts) < 2:
                return "model_failed", "none", "", attempt
            parts = [walk(key, source[a:b], writer, reviewer, rounds, depth + 1) for a, b in cuts]
            n = attempt + sum(p[3] for p in parts)
            kinds = {p[0] for p in parts}
            if "model_failed" in kinds:
                return "model_failed", "none", "", n
            if kinds in ({"review_rejected"}, {"dropped"}):
                return kinds.pop(), "drop" if parts[0][0] == "dropped" else "none", "", n
            return "accepted", "rewrite", segment.assemble(source, [(a, b, p[0], p[2]) for (a, b), p in zip(cuts, parts)]), n
        c, error = parsing.candidate(answer, source)
        if error:
            return "model_failed", "none", "", attempt
        found = [parsing.verdict(reviewer(json.dumps({"check": k, "source": source, "action": c["action"], "text": c["text"] or ""}))) for k in parsing.CHECKS]
        if all(p for p, _, _ in found):
            return ("dropped", "drop", "", attempt) if c["action"] == "drop" else ("accepted", c["action"], c["text"], attempt)
        rejected.append("one more")
    return "review_rejected", "none", "", rounds


def test_rounds_match_the_walk(spark):
    paragraph = "some words of no great weight follow each other here until the line is full enough to count"
    rows = [(f"r{i}", f"text number {i}" + f"\n\n{paragraph} {i}" * (i % 5)) for i in range(60)] + [("blank", "  "), ("null", None)]
    results, history = agents.adaptive_rounds(spark.createDataFrame(rows, RECORDS), agents.offline_writer, agents.offline_reviewer)
    got = {r["record_id"]: (r["status"], r["action"], r["text"], r["attempts"]) for r in results.collect()}
    want = {k: walk(k, s, agents.offline_writer, agents.offline_reviewer) for k, s in rows}
    assert got == want
    assert {"accepted", "dropped", "review_rejected", "skipped_empty_after_cleanup"} <= {v[0] for v in got.values()}
    assert any("::part_" in r["record_id"] for r in history.select("record_id").collect())


def test_feedback_rules_and_formulas(spark):
    def writer(prompt):
        p = json.loads(prompt)
        text = "the sum is $x$ now" if "keep formulas" in p["rules"] else "the sum is gone"
        return json.dumps({"action": "rewrite", "text": text, "answer": None, "explanation": None, "reason": "checked"})

    def passing(prompt):
        return '{"passed": true, "feedback": ""}'

    def derive(prompt):
        p = json.loads(prompt)
        assert p.get("failed", p.get("rejected"))
        return json.dumps({"rules": [{"category": "math", "rule": "keep formulas", "evidence": "lost"}, {"category": "answer", "rule": "not taught", "evidence": "x"}]})

    rows = spark.createDataFrame([("a", "the sum is $x$"), ("b", "the sum is $x$ too"), ("c", "no sum")], RECORDS)
    results, history = agents.review_rounds(rows, writer, passing, derive)
    assert {r["record_id"]: (r["status"], r["attempts"]) for r in results.collect()} == {"a": ("accepted", 2), "b": ("accepted", 2), "c": ("accepted", 1)}
    failed = history.where("attempt = 1 and record_id = 'a'").first()
    assert [f["check"] for f in failed["failed"]] == ["protected_math"] and failed["retry_rules"] == ["keep formulas"]
    known = spark.createDataFrame([(4, "math", "Old rule", "z")], "ord long, category string, rule string, source_record_id string")
    rules = agents.confirmed_rules(rows, results, history, derive, known)
    assert sorted(map(tuple, rules.collect())) == [(4, "math", "Old rule", "z"), (5, "math", "keep formulas", "a")]
    shown = agents.review_rounds(rows, writer, passing, rules=rules)[0]
    assert {r["attempts"] for r in shown.collect()} == {1}
    assert agents.confirmed_rules(rows, results, history, derive, rules).count() == 2


def test_bad_answers_end_a_record_with_the_reason(spark):
    def writer(prompt):
        if "boom" in prompt:
            raise ValueError
        return "no json" if "junk" in prompt else agents.offline_writer(prompt)

    rows = spark.createDataFrame([("a", "boom"), ("b", "junk")], RECORDS)
    got = {r["record_id"]: (r["status"], r["error"]) for r in agents.review_rounds(rows, writer, agents.offline_reviewer)[0].collect()}
    assert got == {"a": ("model_failed", "ValueError"), "b": ("model_failed", "invalid")}
    bad = agents.review_rounds(spark.createDataFrame([("a", "text")], RECORDS), agents.offline_writer, lambda p: '{"passed": "false"}')[0].first()
    assert bad["status"] == "model_failed" and bad["error"].endswith("invalid")
    assert agents.adaptive_rounds(rows.limit(0), writer, agents.offline_reviewer)[0].count() == 0


def test_parsing_of_rules():
    one = {"category": "math", "rule": "Keep it", "evidence": "e"}
    text = lambda *r: json.dumps({"rules": list(r)})
    assert parsing.rules(text(one, {**one, "rule": "keep IT"}), {"math"}) == ([one], None)
    assert parsing.rules(text(one), {"answer"}) == ([], None)
    assert parsing.rules(text({**one, "rule": "remove the formula"}), {"math"}) == ([], None)
    assert parsing.rules(text({**one, "rule": " x"}), {"math"})[1] == "rule"
    assert parsing.rules(text({**one, "more": 1}), {"math"})[1] == "fields"
    assert parsing.rules('{"rules": [', {"math"})[1] == "invalid"
