"""Parsing and checking of model answers; a bad answer is a row with an error, never an exception."""

from __future__ import annotations

import ast
import difflib
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.clean import MATH

# The rules' categories, the reviewers' checks and the categories that a failed check may teach.
CATEGORIES = ("spelling", "terminology", "math", "answer", "removal", "semantics")
CHECKS = ("semantics", "terminology", "solution", "removal")
TAUGHT_BY = {"protected_math": ("math",), "semantics": ("semantics", "spelling"), "terminology": ("terminology", "spelling"), "solution": ("answer",), "removal": ("removal",)}


def _literal(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None


_BRACKET = re.compile(r"[\[\]]")
#: Three plain strings: what every literal reader takes as they stand.
_PLAIN = re.compile(r"""\[ *"([^"\\\[\]\x00\r\n\ud800-\udfff]*)" *, *"([^"\\\[\]\x00\r\n\ud800-\udfff]*)" *, *"([^"\\\[\]\x00\r\n\ud800-\udfff]*)" *\]""")


def triples(text: str) -> list[tuple[str, str, str]]:
    """Bracketed literals of three non-empty strings, in the order in which their brackets close."""
    cells = _PLAIN.findall(text or "")
    if cells and text.count("[") == text.count("]") == len(cells):  # no bracket is left over
        stripped = ((s.strip(), p.strip(), o.strip()) for s, p, o in cells)
        return [t for t in stripped if all(t) and "_" not in t]
    opened, found = [], []
    for m in _BRACKET.finditer(text or ""):
        i = m.start()
        if m[0] == "[":
            opened.append(i)
        elif opened:
            a = opened.pop()
            plain = _PLAIN.fullmatch(text, a, i + 1)
            value = list(plain.groups()) if plain else _literal(text[a : i + 1])
            if isinstance(value, list) and len(value) == 3:
                cells = [", ".join(map(str, v)) if isinstance(v, list) else v for v in value]
                if all(isinstance(v, str) and v.strip() and v.strip() != "_" for v in cells):
                    found.append(tuple(v.strip() for v in cells))
    return found


def entities(text: str) -> tuple[list[str] | None, str | None]:
    a, b = (text or "").find("["), (text or "").find("]")
    value = _literal(text[a : b + 1]) if 0 <= a < b else None
    return ([str(v) for v in value], None) if isinstance(value, list) else (None, "no list")


def graph_line(text: str) -> list[list[str]]:
    """One graph, or the fallback [Null, Null, Null]."""
    value = _literal(text or "")
    ok = isinstance(value, list) and all(isinstance(t, (list, tuple)) for t in value)
    return [[str(c) for c in t] for t in value] if ok else [["Null", "Null", "Null"]]


def fenced_list(text: str) -> list:
    m = re.search(r"```(?:\w+)?\s*(\[.*?\])\s*```", text or "", re.S) or re.search(r"(\[.*\])", text or "", re.S)
    value = _literal(m[1]) if m else None
    return value if isinstance(value, list) else [["none", "none", "none"]]


def _json(text: str | None) -> tuple[object, str | None]:
    """(value, error): `truncated` where the text ends in the middle of a value, else `invalid`."""
    try:
        return json.loads(text), None
    except TypeError:
        return None, "invalid"
    except (json.JSONDecodeError, RecursionError) as e:
        cut = isinstance(e, json.JSONDecodeError) and (e.msg.startswith("Unterminated string") or e.pos + 1 >= len(text.rstrip()))
        return None, "truncated" if cut else "invalid"


def verdict(text: str | None) -> tuple[bool | None, str | None, str | None]:
    """(passed, feedback, error): a real boolean and a string, further fields are passed over; failure needs feedback."""
    value, error = _json(text)
    if error:
        return None, None, error
    if not isinstance(value, dict) or not isinstance(value.get("passed"), bool) or not isinstance(value.get("feedback"), str):
        return None, None, "invalid"
    if not value["passed"] and not value["feedback"].strip():
        return None, None, "failed without feedback"
    return value["passed"], value["feedback"], None


# The lines with which an answer and its explanation stand in a text, and the longest explanation.
ANSWER, EXPLANATION, LONGEST = "Đáp án:", "Giải thích:", 300
FIELDS = {"action": str, "text": str, "answer": (str, type(None)), "explanation": (str, type(None)), "reason": str}
_FENCE = re.compile(r"\s*```(?:json)?\s*(.*?)\s*```\s*", re.S | re.I)


def _one_line(text: object) -> bool:
    return isinstance(text, str) and text != "" and text == text.strip() and not {"\n", "\r"} & set(text)


def with_answer(text: str, answer: str, explanation: str) -> tuple[str | None, str | None]:
    """(text that ends in the answer's two lines, error). Answer lines that are there already are put in their form;
    blocks of earlier questions stay."""
    lines, block = text.rstrip().splitlines(), [f"{ANSWER} {answer}", f"{EXPLANATION} {explanation}"]
    if lines and lines[-1].startswith(EXPLANATION):
        lines = lines[:-1]
    if lines and lines[-1].startswith(ANSWER):
        if lines[-1][len(ANSWER) :].strip().rstrip(".") != answer:
            return None, "conflicting answer"
        lines = lines[:-1]
    while lines[-2:] == block:
        lines = lines[:-2]
    body = "\n".join(lines).rstrip()
    return ("\n".join([body, *block]), None) if body else (None, "answer without question")


def candidate(text: str | None, source: str) -> tuple[dict | None, str | None]:
    """(candidate edit, error): exactly its five fields, of the right kinds; labels that contradict the text are put right."""
    fenced = _FENCE.fullmatch(text or "")
    value, error = _json(fenced[1] if fenced else (text or "").strip())
    if error:
        return None, error
    if not isinstance(value, dict) or value.keys() != FIELDS.keys():
        return None, "fields"
    if not all(isinstance(value[f], kind) for f, kind in FIELDS.items()) or value["action"] not in ("keep", "rewrite", "drop") or not value["reason"].strip():
        return None, "fields"
    new, answer, why = value["text"], value["answer"], value["explanation"]
    if answer is not None and not _one_line(answer):
        return None, "answer"
    if (answer is None and why is not None) or (answer is not None and (not _one_line(why) or len(why) > LONGEST)):
        return None, "explanation"
    changed = new != source or answer is not None
    action = "rewrite" if value["action"] == "keep" and changed else value["action"]
    if action == "drop":
        return (value, None) if new == "" and answer is None else (None, "drop with content")
    if action == "rewrite" and not new.strip():
        return None, "empty rewrite"
    if answer is not None:
        new, error = with_answer(new, answer, why)
        if error:
            return None, error
    if new == source:  # also after the answer took its form
        action, answer, why = "keep", None, None
    return {**value, "action": action, "text": new, "answer": answer, "explanation": why}, None


def rule_is_safe(rule: str, accepted_has_answer: bool = False) -> bool:
    """No change verb aimed at protected content without a negation close before it."""
    things = "latex|formula|công thức|dialect|phương ngữ|terminology|thuật ngữ" + ("|answer|đáp án" if accepted_has_answer else "")
    for m in re.finditer(rf"\b(?:change|rewrite|replace|remove|delete|sửa|thay|xóa|bỏ)\b[^.;]*?\b(?:{things})\b", rule, re.I):
        if not re.search(r"\b(?:not|never|don't|không|đừng)\b", rule[max(0, m.start() - 14) : m.start()], re.I):
            return False
    return True


def rules(text: str, allowed: set[str], accepted_has_answer: bool = False) -> tuple[list[dict[str, str]], str | None]:
    """(rules, error): a closed object of one list; rules of other categories and unsafe ones are passed over, repeats too."""
    try:
        value = json.loads(text)
    except (json.JSONDecodeError, TypeError):
        return [], "invalid"
    if not isinstance(value, dict) or set(value) != {"rules"} or not isinstance(value["rules"], list):
        return [], "fields"
    out: dict[tuple[str, str], dict[str, str]] = {}
    for item in value["rules"]:
        if not isinstance(item, dict) or set(item) != {"category", "rule", "evidence"} or not all(isinstance(v, str) for v in item.values()):
            return [], "fields"
        rule = item["rule"]
        if item["category"] not in CATEGORIES or not item["evidence"].strip() or not rule or rule != rule.strip() or len(rule.splitlines()) > 1:
            return [], "rule"
        if item["category"] in allowed and rule_is_safe(rule, accepted_has_answer):
            out.setdefault((item["category"], rule.casefold()), item)
    return list(out.values()), None


def budgeted_places(rules: list[tuple[str, str]], budget: int = 4000) -> list[int]:
    """Newest first, those that don't fit are passed over; places in the original order."""
    left, keep = budget, []
    for i in range(len(rules) - 1, -1, -1):
        cost = len(rules[i][0]) + len(rules[i][1]) + 32
        if cost <= left:
            keep.append(i)
            left -= cost
    return keep[::-1]


def budgeted(rules: list[tuple[str, str]], budget: int = 4000) -> list[tuple[str, str]]:
    return [rules[i] for i in budgeted_places(rules, budget)]


# What a correction must leave as it is, in what range its length and from where its likeness may lie.
WORDS, NUMBERS = re.compile(r"\b[^\W\d_]+\b"), re.compile(r"\d+(?:[.,]\d+)*")
INVARIANTS = {
    "formulas": MATH.findall,
    "numbers": NUMBERS.findall,
    "names": lambda text: [w for w in WORDS.findall(text) if w[0].isupper()],
}
LENGTHS, LIKENESS = (0.6, 1.4), 0.8


def broken_invariants(old: str, new: str) -> list[str]:
    """What a correction breaks, by name; one that breaks nothing is safe. Likeness is only measured where all else holds."""
    if not old or not new:
        return ["empty"]
    broken = [name for name, of in INVARIANTS.items() if of(old) != of(new)]
    if not LENGTHS[0] <= len(new) / len(old) <= LENGTHS[1]:
        broken.append("length")
    if not broken and old != new and difflib.SequenceMatcher(None, old, new).ratio() < LIKENESS:
        broken.append("likeness")
    return broken


def correction_is_safe(old: str, new: str) -> bool:
    return not broken_invariants(old, new)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in "spo"])))
def triples_udf(texts: pa.Array) -> pa.Array:
    found = [triples(t) for t in texts.to_pylist()]
    cells = [pa.array([t[k] for ts in found for t in ts], pa.string()) for k in range(3)]
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.StructArray.from_arrays(cells, list("spo")))


@F.pandas_udf(T.StructType([T.StructField("passed", T.BooleanType()), T.StructField("feedback", T.StringType()), T.StructField("error", T.StringType())]))
def verdict_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([verdict(t) for t in texts], columns=["passed", "feedback", "error"])


@F.pandas_udf(T.BooleanType())
def safe_udf(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([correction_is_safe(a or "", b or "") for a, b in zip(old, new)])


_TRIPLES = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in "spo"]))


@F.pandas_udf(T.StructType([T.StructField("entities", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())]))
def entities_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([entities(t) for t in texts], columns=["entities", "error"])


@F.pandas_udf(_TRIPLES)
def graph_line_udf(texts: pd.Series) -> pd.Series:
    """Predicted graphs, a line each: triples of three cells (others left out), the fallback where a line can't be read."""
    return pd.Series([[dict(zip("spo", t)) for t in graph_line(x) if len(t) == 3] for x in texts])


@F.pandas_udf(T.StructType([T.StructField("triples", _TRIPLES), T.StructField("error", T.StringType())]))
def gold_line_udf(texts: pd.Series) -> pd.DataFrame:
    """Gold graphs: a line that is no list of triples of three cells is an error."""
    found = [_literal(x or "") for x in texts]
    good = [isinstance(v, list) and all(isinstance(t, (list, tuple)) and len(t) == 3 for t in v) for v in found]
    return pd.DataFrame({"triples": [[dict(zip("spo", map(str, t))) for t in v] if ok else None for v, ok in zip(found, good)], "error": [None if ok else "no graph" for ok in good]})


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def list_udf(texts: pd.Series) -> pd.Series:
    """Lists of lists in fenced or plain answers, cells as text; the fallback [none, none, none]."""
    return pd.Series([[[str(c) for c in t] if isinstance(t, (list, tuple)) else [str(t)] for t in fenced_list(x)] for x in texts])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def budgeted_udf(categories: pd.Series, rules: pd.Series, budget: pd.Series) -> pd.Series:
    """Places (from 0) of the rules of a list that a prompt has room for."""
    out = []
    for cs, rs, n in zip(categories, rules, budget):
        marked = [(c, r) for c, r in zip(cs, rs)]
        out.append(budgeted_places(marked, int(n)))
    return pd.Series(out)


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("action", "text", "answer", "error")]))
def candidate_udf(texts: pd.Series, sources: pd.Series) -> pd.DataFrame:
    found = [candidate(t, s or "") for t, s in zip(texts, sources)]
    return pd.DataFrame([(c["action"], c["text"], c["answer"], None) if c else (None, None, None, e) for c, e in found], columns=["action", "text", "answer", "error"])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("category", "rule", "evidence")])))
def rules_udf(texts: pd.Series, failed: pd.Series, answers: pd.Series) -> pd.Series:
    """Rules that the failed checks (a list of names) may teach; none from an unusable answer."""
    allowed = [{c for check in checks for c in TAUGHT_BY.get(check, ())} for checks in failed]
    return pd.Series([rules(t, a, bool(b))[0] for t, a, b in zip(texts, allowed, answers)])
