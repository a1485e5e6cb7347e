import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import native, parsing
from textloom.functions.clean import clean_book, clean_text, is_caption
from textloom.functions.segment import assemble, chunks, pack, split_text
from textloom.operators import graphs


def test_cleaning_keeps_formulas_and_mends_scan_errors():
    assert clean_text("Ta  gọi tất là $a  b$ .<p>x</p> [nguồn](http://a.b/c)") == "Ta gọi tắt là $a  b$. x nguồn"
    assert clean_text("&lt;p&gt;Gọi tất&lt;/p&gt;") == "Gọi tắt"
    assert clean_text(None) is None and clean_text("![x](y)") == ""


def test_book_gaps_and_captions():
    assert clean_book("# Một\n\n![a](b)\n\nHai\n") == "Một\nHai\n"
    assert clean_book("Một\n\n\nHai") == "Một\n\nHai"
    assert clean_book("a <sup>2</sup> <iostream>\n") == "a ^{2} <iostream>\n"
    assert is_caption("Hình 1.2 Mặt cắt") and is_caption("▲ Hình 3") and not is_caption("hình 1 là một")


@pytest.mark.parametrize("seed", range(4))
def test_split_and_chunks_hold_their_invariants(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["word ", "Ende. ", "$a b c$ ", "\n\n", "x" * 30 + " "]) for _ in range(400))
    for piece in split_text(text, 100):
        assert len(piece) <= 100 and piece.count("$") % 2 == 0
    spans = chunks(text, 200)
    gaps = [text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)])]
    assert all(not g.strip() for g in gaps) and all(b - a <= 200 for a, b in spans)
    assert assemble(text, [(a, b, "failed", "") for a, b in spans]) == text


def test_pack_tracks_lines():
    segments = pack("# A\n\nerste\n\n![x](y)\n\nzweite", 100)
    assert [(s["start_line"], s["end_line"]) for s in segments] == [(1, 7)]
    assert segments[0]["text"].endswith("zweite")


def test_assemble_drops_and_closes_gaps():
    assert assemble("a\n\nb\n\nc\n", [(0, 1, "accepted", "A"), (3, 4, "dropped", "")]) == "A\n\nc\n"


def test_parsers():
    assert parsing.triples("x [['a', 'r', 'b'], ['c', 'r']] [['d','_','e']]") == [("a", "r", "b")]
    assert parsing.entities("['a', 'b']")[0] == ["a", "b"] and parsing.entities("none")[0] is None
    assert parsing.graph_line("oops") == [["Null", "Null", "Null"]] and parsing.fenced_list("```\n[1]\n```") == [1]
    assert parsing.verdict('{"passed": "false", "feedback": null}')[2] == "invalid"
    assert parsing.verdict('{"passed": false, "feedback": ""}')[2] == "failed without feedback"
    assert parsing.verdict('{"passed": false, "feedback": "abc')[2] == "truncated" and parsing.verdict('{"passed": true, "feedback": null}')[2] == "invalid"
    assert parsing.verdict('{"passed":, "feedback": "x"}')[2] == "invalid" and parsing.verdict('{"passed": true}')[2] == "invalid" and parsing.verdict(None)[2] == "invalid"
    assert parsing.verdict('{"passed": false, "feedback": "wrong fact", "score": 0.2}') == (False, "wrong fact", None)
    keep = '{"action": "keep", "text": "new", "answer": null, "explanation": null, "reason": "fine"}'
    assert parsing.candidate(keep, "old")[0]["action"] == "rewrite" and parsing.candidate(keep, "new")[0]["action"] == "keep"
    assert not parsing.rule_is_safe("Change the LaTeX") and parsing.rule_is_safe("Never change the LaTeX")
    assert parsing.budgeted([("a", "x" * 50), ("b", "y" * 5000), ("c", "z")], 150) == [("a", "x" * 50), ("c", "z")]
    assert parsing.correction_is_safe("Anna has 3 apples now", "Anna has 3 apples  now") and not parsing.correction_is_safe("a 3", "a 4")


def test_native_expressions(spark):
    df = spark.createDataFrame([("yes.", "a: b\nAnswer: c\na: d"), ("Yes, probably", None), (None, "")], "r string, t string")
    rows = df.select(native.strict_judgment(F.col("r")).alias("j"), native.relation_definitions(F.col("t")).alias("d")).collect()
    assert [r["j"] for r in rows] == ["YES", "UNSURE", "UNSURE"]
    assert [tuple(x) for x in rows[0]["d"]] == [("a", "d")] and rows[2]["d"] == []
    assert df.select(native.normalise_for_scoring(F.lit("birthPlace_of X (city)"))).first()[0] == "birth place of x"


def test_assignment_is_the_best_of_all():
    rng = np.random.default_rng(0)
    for n, m in ((3, 3), (2, 4), (5, 3), (1, 1)):
        s = rng.random((n, m))
        best = max(sum(s[i, j] for i, j in (zip(range(n), p) if n <= m else zip(p, range(m)))) for p in itertools.permutations(range(max(n, m)), min(n, m)))
        assert sum(s[i, j] for i, j in graphs.assignment(s)) == pytest.approx(best)


def test_isomorphism_ignores_names_not_labels():
    assert graphs.isomorphic([("a", "r", "b"), ("b", "q", "c")], [("x", "r", "y"), ("y", "q", "z")])
    assert not graphs.isomorphic([("a", "r", "b"), ("b", "q", "c")], [("x", "r", "y"), ("z", "q", "y")])
    assert graphs.matched([("a", "r", "b")], [("a", "r", "b")], graphs.bleu)[2] > 0.5


def offer(**fields):
    import json

    return json.dumps({"action": "rewrite", "text": "1 + 2? A. 3 B. 4", "answer": None, "explanation": None, "reason": "checked", **fields}, ensure_ascii=False)


QUESTION = "1 + 2? A. 3 B. 4"
SOLVED = QUESTION + "\nĐáp án: A\nGiải thích: 1 + 2 = 3."


@pytest.mark.parametrize(
    ("answer", "outcome"),
    [
        (offer(text="other"), ("rewrite", "other", None)),
        (offer(action="keep", text="other"), ("rewrite", "other", None)),
        (offer(action="keep"), ("keep", QUESTION, None)),
        (offer(), ("keep", QUESTION, None)),
        ("```json\n" + offer(action="drop", text="") + "\n```", ("drop", "", None)),
        (offer(answer="A", explanation="1 + 2 = 3."), ("rewrite", SOLVED, "A")),
        (offer(action="keep", answer="A", explanation="1 + 2 = 3."), ("rewrite", SOLVED, "A")),
        (offer(text=SOLVED, answer="A", explanation="1 + 2 = 3."), ("rewrite", SOLVED, "A")),
        (offer(text=SOLVED + SOLVED[len(QUESTION) :], answer="A", explanation="1 + 2 = 3."), ("rewrite", SOLVED, "A")),
        (offer(text=QUESTION + "\nĐáp án: A.\nGiải thích: Khác.", answer="A", explanation="1 + 2 = 3."), ("rewrite", SOLVED, "A")),
    ],
)
def test_candidates_are_put_right(answer, outcome):
    found, error = parsing.candidate(answer, QUESTION)
    assert error is None and (found["action"], found["text"], found["answer"]) == outcome


def test_blocks_of_earlier_questions_stay_and_a_solved_source_is_kept():
    two = SOLVED + "\n\nCâu 2: 2 + 2? A. 4"
    found, _ = parsing.candidate(offer(text=two, answer="A", explanation="2 + 2 = 4."), QUESTION)
    assert found["text"] == two + "\nĐáp án: A\nGiải thích: 2 + 2 = 4."
    assert parsing.candidate(offer(text=SOLVED, answer="A", explanation="1 + 2 = 3."), SOLVED)[0]["action"] == "keep"


@pytest.mark.parametrize(
    ("answer", "error"),
    [
        (offer(text=5), "fields"), (offer(explanation=5, answer="A"), "fields"), (offer(reason=" "), "fields"), (offer(extra=1), "fields"), ("[]", "fields"), (offer(action="move"), "fields"),
        (offer(action="drop"), "drop with content"), (offer(text="  "), "empty rewrite"), (offer(action="keep", text=""), "empty rewrite"), (offer(answer="A"), "explanation"), (offer(explanation="why"), "explanation"),
        (offer(answer="A", explanation="x" * 301), "explanation"), (offer(answer="A\nB", explanation="x"), "answer"), (offer(answer=" A", explanation="x"), "answer"), (offer(answer="", explanation="x"), "answer"),
        (offer(text=QUESTION + "\nĐáp án: B", answer="A", explanation="x"), "conflicting answer"), (offer(text="Đáp án: A", answer="A", explanation="x"), "answer without question"),
        (offer()[:30], "truncated"), ("no json", "invalid"), (None, "truncated"),
    ],
)
def test_bad_candidates_are_errors_not_exceptions(answer, error):
    assert parsing.candidate(answer, QUESTION) == (None, error)


def slow_split(text, limit):
    """Piece after piece, every window and formula looked at anew."""
    import re

    out = []
    while len(text) > limit:
        formulas = [m.span() for m in re.finditer(r"\$\$.*?\$\$|\$[^$]*\$", text, re.S)]
        free = lambda e: not any(a < e < b for a, b in formulas)
        blanks = [m.end() for m in re.finditer(r"\s+", text[: limit + 1]) if free(m.end())]
        stops = [m.end() for m in re.finditer(r"[.!?]\s+", text[: limit + 1]) if free(m.end()) and m.end() >= limit // 2]
        later = [limit + m.end() for m in re.finditer(r"\s+", text[limit:]) if free(limit + m.end())]
        cut = stops[-1] if stops else blanks[-1] if blanks else later[0] if later else len(text)
        out.append(text[:cut].strip())
        text = text[cut:].strip()
    return out + [text] * bool(text)


@pytest.mark.parametrize("seed", range(40))
def test_split_equals_a_slow_walk(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["word ", "Ende. ", "$a b. c$ ", "\n\n", "x" * 30 + " ", "y" * 130, "$", "  ", "! ", "$$m\nn$$"]) for _ in range(r.randrange(1, 200)))
    assert split_text(text, 100) == slow_split(text, 100)


def test_chunks_keep_the_white_space_at_their_edges_and_refuse_small_limits():
    assert chunks("  lead\n\nsecond \n", 100) == [(0, 16)] and chunks(" \n\n ", 100) == [] and chunks("", 100) == []
    spans = chunks("a" * 90 + " $b c d$ " + "e" * 90 + "\n \n\n" + "f g " * 60, 100)
    assert spans[0] == (0, 98) and all(b - a <= 100 for a, b in spans)
    for f in (chunks, split_text):
        with pytest.raises(ValueError, match="100"):
            f("x", 99)


def test_cutting_grows_with_the_text():
    import time

    def seconds(n):
        text, began = "word and $x y$ more. " * n, time.perf_counter()
        chunks(text, 1800), split_text(text, 1800)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(10_000), 0.02)


@pytest.mark.parametrize(
    ("line", "caption"),
    [("Hình 1.2 Mặt cắt", True), ("▲ Hình 3", True), ("HÌNH 4b: sơ đồ", True), ("Hinh 5 – đồ thị", True), ("Hình 6 ...", True), ("hình 1 là một", False), ("Hình 1B mô tả", False), ("Xem Hình 2", False), ("Hình", False)],
)
def test_captions_by_their_tails(line, caption):
    assert is_caption(line) is caption


def test_formulas_go_with_what_holds_them_and_stay_elsewhere():
    assert clean_text("a <details>$x$ y</details> b $p  <p> q$ c $z$") == "a b $p  <p> q$ c $z$"
    assert clean_book("a\n<details>\n$x$\n</details>\n\nb &amp; $c &amp; d$\n") == "a\nb & $c &amp; d$\n"
    with pytest.raises(ValueError, match="lines"):
        clean_book("a&#10;b")


def test_accents_of_many_alphabets_go(spark):
    rows = spark.createDataFrame([("Đáp án: ạảấếơưẶ Übung ñandú œ e\u0301",)], "t string")
    assert rows.select(native.strip_accents(F.col("t"))).first()[0] == "Dap an: aaaeouA Ubung nandu œ e"


def test_short_judgments_questions_ids_and_edges(spark):
    rows = spark.createDataFrame([("Không đúng", ["a", "r", "b"], 7), ("Đúng, vì sai số nhỏ", ["a", "r"], 12), ("Sai", ["a"], 3), (None, [], 1)], "t string, cells array<string>, n int")
    got = rows.select(native.short_judgment(F.col("t")), native.cells_question(F.col("cells")), native.numbered_id(F.lit("b"), "seg", F.col("n")), native.edge_text(F.lit("a"), F.lit("r"), F.lit("b"), quirk=True)).collect()
    assert [r[0] for r in got] == [False, False, False, False] and [r[1] for r in got] == ["Is this true: a r b?", "Is this true: a r", None, None]
    assert got[1][2] == "b::seg_00012" and got[0][3] == "[;';a;';,; ;';r;';,; ;';b;';]"


def test_safe_corrections_name_what_they_break():
    assert parsing.broken_invariants("Anna has 3 $x$", "anna has 4 $y$") == ["formulas", "numbers", "names"]
    assert parsing.broken_invariants("a" * 10, "a" * 20) == ["length"] and parsing.broken_invariants("abcdefgh", "hgfedcba") == ["likeness"] and parsing.broken_invariants("", "a") == ["empty"]
