"""Personal data by a skip-chain conditional random field over mentions.

Base matches of four kinds (email, ip, card, phone) come from fixed patterns, leftmost and non-overlapping per kind. A
skip-chain CRF then labels every mention: a token that holds a digit or an at-sign, or a run of short digit groups such
as `(743) 555-3824`. Labels are the four kinds, `secret` (keys, passwords, access tokens) and none. Neighbouring
mentions share chain potentials; mentions of a document that are equal, or alike in part (the last digits of a number,
the local part of an address, the beginning or end of a secret), share skip potentials however far apart. Each mention is
linked to the nearest earlier one under each of its keys, so a document's links grow with its mentions. Mentions that a
base match touches are evidence, their label is fixed; loopy belief propagation carries it to the others, over all
documents of a slice at once.

What the field adds: mentions without a base match whose label is sure to a threshold, such as a number without its
country code, a card number with a slip or an address cut short that stand complete elsewhere in the document (alone
they are none), and secrets, also where no key word stands beside them; and whole addresses of which the pattern, which
knows ASCII only, caught the end.

The field is trained on a bounded sample of documents that hold digits or at-signs. Labels are the base matches, and
secrets by the key word before them. Of each labelled mention the training also has a damaged copy: far from its
original it keeps the label, without an original it has none, which is what teaches the skip potentials. Mentions are
taken from whole texts, on the executors; the driver gets their features, not the texts.

Defined results: null text counts as empty: no spans, the digest of the empty string. Offsets are code points. Null or
repeated ids: each row by its own text. Very long texts are read whole. Equal scores take the first label in the order
none, email, ip, card, phone, secret. Without documents to learn from the field labels nothing. Empty tables give empty
results; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_sample
from textloom.llm.words import slices

# Kinds in their order, and the patterns of the contract. Possessive forms and look-behinds match the
# same text without scanning long runs again and again.
KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
SECRET_WORDS = frozenset(("token", "key", "apikey", "api_key", "access_key", "secret", "secret_key", "client_secret", "password", "passwd", "pwd", "auth", "bearer", "credential"))
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x00-\x20\"'`=<>|,;:{}\[\]]+")
GROUP = re.compile(r"[+(]?[0-9][0-9().-]*")

LABELS = ("none", *KINDS, SECRET)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base matches by kind, then start."""
    out: list[Span] = []
    if not ANY.search(text):
        return out
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", begin, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- mentions

Mention = tuple[int, int, int, int]  # begin, end, number of its first token, one past its last


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the brackets and stops around it."""
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not (text[b - 1].isalnum() or (text[b - 1] == ")" and "(" in text[a:b])):
        b -= 1
    return a, b


def mentions(text: str) -> tuple[list[Mention], list[tuple[int, int]]]:
    """Mentions in order, and the spans of all tokens."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    out: list[Mention] = []
    open_digits = 0  # of the run that the last mention is, while it may go on
    for i, (a, b) in enumerate(spans):
        token = text[a:b]
        if not ANY.search(token):
            open_digits = 0
            continue
        a, b = _trimmed(text, a, b)
        digits = sum("0" <= c <= "9" for c in token)
        group = digits <= 8 and token.count(".") < 3 and GROUP.fullmatch(text[a:b]) is not None
        if a == b:
            open_digits = 0
        elif group and open_digits and out[-1][3] == i and text[out[-1][1] : a] in (" ", " (", "-") and open_digits + digits <= 19:
            out[-1] = (out[-1][0], b, out[-1][2], i + 1)
            open_digits += digits
        else:
            out.append((a, b, i, i + 1))
            open_digits = digits if group and b == spans[i][1] else 0
    return out, spans


WIDTH = 1 << 12
FACTS = 14
CHAIN, SAME, LIKE = range(3)


def _shape(word: str) -> str:
    """Kinds of signs, runs cut to one sign (digits to four)."""
    out, run, last = [], 0, ""
    for c in word[:48]:
        c = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c if c in "@.+()-_%/" else " " if c == " " else "~"
        run = run + 1 if c == last else 1
        last = c
        if run <= (4 if c == "9" else 1):
            out.append(c)
    return "".join(out)


@functools.lru_cache(1 << 16)
def _column(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % WIDTH


def _word(text: str, spans: list[tuple[int, int]], i: int) -> str:
    """A neighbouring token as context: itself in lower case, numbers and ends as signs."""
    if not 0 <= i < len(spans):
        return "^"
    word = text[spans[i][0] : spans[i][1]][:24].lower()
    return "9" if ANY.search(word) else word


def facts(text: str, spans: list[tuple[int, int]], m: Mention) -> list[int]:
    """Columns of a mention: its shape, lengths and checks, and the words beside it."""
    word = text[m[0] : m[1]]
    digits = _digits(word)
    letters = sum(c.isalpha() for c in word)
    hexes = letters and all(c in "0123456789abcdefABCDEF" for c in word)
    names = (
        "1", f"s{_shape(word)}", f"n{min(len(digits), 20)}", f"l{min(letters, 40) // 4}", f"z{min(len(word), 64) // 4}", f"c{13 <= len(digits) <= 19 and luhn(digits)}", f"@{'@' in word}",
        f"+{word[0] == '+'}", f"h{bool(hexes)}|{len(word) >= 16}", f"m{letters > 0}|{len(digits) > 0}|{len(word) >= 16}", f"q{text[m[0] - 1 : m[0]] in (chr(34), chr(39))}",
        f"b{_word(text, spans, m[2] - 1)}", f"bb{_word(text, spans, m[2] - 2)}", f"a{_word(text, spans, m[3])}",
    )
    return [_column(f) for f in names]


def keys(word: str) -> list[tuple[str, int]]:
    """What links a mention to others: (key, kind of the link); short ones have none."""
    plain = "".join(c for c in word.lower() if c.isalnum() or c == "@")
    digits = _digits(word)
    out = [(f"w{plain}", SAME)] if len(plain) >= 5 else []
    if len(digits) >= 7 and "@" not in word and len(plain) == len(digits):
        out.append((f"d{digits[-7:]}", LIKE))
        if len(digits) >= 9:
            out.append((f"p{digits[:8]}", LIKE))
    if len(parts := word.split(".")) >= 3 and len(plain) == len(digits) <= 12:
        out.append((f"i{'.'.join(parts[:3])}", LIKE))
    if "@" in word and len(local := word.lower().split("@")[0]) >= 3:
        out.append((f"e{local}", LIKE))
    if len(plain) >= 12 and len(plain) > len(digits) and "@" not in word:
        out += [(f"h{plain[:12]}", LIKE), (f"t{plain[-12:]}", LIKE)]
    return out


@dataclass
class Graph:
    """Mentions of many documents. columns: (nodes, facts); edges: (n, 2), the earlier one first; kind: CHAIN, SAME or LIKE of each
    edge; places: text, begin, end of each node; seen: the label that is evidence, or -1."""

    columns: np.ndarray
    edges: np.ndarray
    kind: np.ndarray
    places: list[tuple[int, int, int]]
    seen: np.ndarray


def labels_of(text: str, base: list[Span], found: list[Mention]) -> list[int]:
    """The kind of a base match that each mention touches (the first in the order of kinds), or 0."""
    out, order = [0] * len(found), sorted((b, e, LABELS.index(k)) for k, b, e in base)
    at, reach = 0, []
    for i, (a, b, *_) in enumerate(found):
        while at < len(order) and order[at][0] < b:
            reach.append(order[at])
            at += 1
        reach = [r for r in reach if r[1] > a]
        out[i] = min((k for x, y, k in reach if x < b and a < y), default=0)
    return out


def seeded(text: str, spans: list[tuple[int, int]], m: Mention) -> bool:
    """Whether the mention is a secret by the key word and sign before it: 16 signs or more, letters and digits."""
    word = text[m[0] : m[1]]
    if len(word) < 16 or "@" in word or not any(c.isalpha() for c in word) or not m[2]:
        return False
    a, b = spans[m[2] - 1]
    return text[a:b].lower().lstrip("-") in SECRET_WORDS and any(c in "=:" for c in text[b : m[0]])


def graph(texts: list[str], base: list[list[Span]]) -> Graph:
    columns, edges, kinds, places, seen = [], [], [], [], []
    for number, text in enumerate(texts):
        if not ANY.search(text):
            continue
        found, spans = mentions(text)
        first, last_of = len(places), {}
        for i, (m, label) in enumerate(zip(found, labels_of(text, base[number], found))):
            node = first + i
            columns.append(facts(text, spans, m))
            places.append((number, m[0], m[1]))
            seen.append(label or -1)
            if i and m[2] - found[i - 1][3] <= 1:
                edges.append((node - 1, node))
                kinds.append(CHAIN)
            linked = set()
            for key, kind in keys(text[m[0] : m[1]]):
                other = last_of.get(key)
                if other is not None and other not in linked:
                    linked.add(other)
                    edges.append((other, node))
                    kinds.append(kind)
                last_of[key] = node
    return Graph(np.array(columns, np.int64).reshape(-1, FACTS), np.array(edges, np.int64).reshape(-1, 2), np.array(kinds, np.int64), places, np.array(seen, np.int64))


# --- the field


@dataclass
class SkipChainCRF:
    """weights: (facts, labels); pairs: (CHAIN, SAME, LIKE) tables of label pairs."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, g: Graph, rounds: int = 10, damping: float = 0.25, evidence: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Beliefs of nodes and of edges by loopy sum-product, the evidence held fixed."""
        unary = self.weights[g.columns].sum(axis=1)
        if evidence and len(unary):
            fixed = g.seen >= 0
            unary[fixed] = -60.0
            unary[fixed, g.seen[fixed]] = 0.0
        n, m = len(unary), len(g.edges)
        psi = self.pairs[g.kind]
        source, target = np.r_[g.edges[:, 0], g.edges[:, 1]], np.r_[g.edges[:, 1], g.edges[:, 0]]
        both = np.concatenate([psi, psi.transpose(0, 2, 1)])
        back = np.r_[np.arange(m, 2 * m), np.arange(m)]
        messages = np.zeros((2 * m, len(LABELS)))
        belief = unary.copy()
        for _ in range(rounds if m else 0):
            cavity = belief[source] - messages[back]
            new = _logsumexp(cavity[:, :, None] + both, 1)
            new -= _logsumexp(new, 1)[:, None]
            messages = damping * messages + (1 - damping) * new
            belief = unary.copy()
            np.add.at(belief, target, messages)
        nodes = np.exp(belief - _logsumexp(belief, 1)[:, None]) if n else belief
        pair = (belief[source[:m]] - messages[back[:m]])[:, :, None] + (belief[target[:m]] - messages[:m])[:, None, :] + psi
        pair = np.exp(pair - _logsumexp(pair.reshape(m, -1), 1)[:, None, None]) if m else pair
        return nodes, pair


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


# --- training


def damaged(kind: str, word: str, turn: int) -> str:
    """A mention as careless writers repeat it: cut short or with a slip, so that no pattern takes it."""
    if kind == "phone":
        return word[word.index(" ") + 1 :] if " " in word else word[2:]
    if kind == "email":
        return word.split("@")[0] + "@" + word.split("@")[1].split(".")[0]
    if kind == "ip":
        return word.rsplit(".", 1)[0]
    if kind == "card":
        at = [i for i, c in enumerate(word) if "0" <= c <= "9"]
        i = at[len(at) // 2 + turn % 3]
        return word[:i] + str((int(word[i]) + 1 + turn % 8) % 10) + word[i + 1 :]
    return word[: max(14, len(word) // 2)]


def examples(text: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(columns, edges, kinds of edges, labels): the text, the text with damaged copies of its mentions at its end, and
    the damaged copies without their originals."""
    base = base_spans(text)
    found, spans = mentions(text)
    kinds = [LABELS[k] if k else SECRET if seeded(text, spans, m) else "" for k, m in zip(labels_of(text, base, found), found)]
    originals = list(dict.fromkeys((k, text[m[0] : m[1]]) for k, m in zip(kinds, found) if k))[:8]
    copies = [(k, damaged(k, w, i)) for i, (k, w) in enumerate(originals)]
    copies = [(k, w) for k, w in copies if w and not base_spans(w)]
    words = [text[a:b] for a, b in spans[:: max(1, len(spans) // 64)] if not ANY.search(text[a:b])][:64] or ["and"]
    tail = ""
    places: dict[int, int] = {}  # where a copy begins in the tail, and its label
    for i, (k, w) in enumerate(copies):
        tail += " " + " ".join(words[(3 * i + j) % len(words)] for j in range(4)) + " "
        places[len(tail)] = LABELS.index(k)
        tail += w
    out = []
    for body, more, own in ((text, "", False), (text, tail, True), ("", tail, False)):
        whole = body + more
        if not whole or (not body and not more) or (own and not more):
            continue
        g = graph([whole], [base_spans(whole)])
        if not len(g.places):
            continue
        here, where = mentions(whole)
        y = [k if k > 0 else LABELS.index(SECRET) if seeded(whole, where, m) else 0 for k, m in zip(g.seen.tolist(), here)]
        if own:
            y = [k or next((v for p, v in places.items() if a <= len(body) + p < b), 0) if a >= len(body) else k for k, (a, b, *_) in zip(y, here)]
        out.append((g.columns, g.edges, g.kind, np.array(y, np.int64)))
    return out


def train(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], steps: int = 120, rate: float = 0.15, ridge: float = 2e-4) -> SkipChainCRF:
    """Gradient ascent on the likelihood with loopy beliefs in place of exact expectations."""
    size = len(LABELS)
    prior = np.zeros((3, size, size))
    prior[SAME] = prior[LIKE] = np.diag([0.5] + [1.0] * (size - 1))
    model = SkipChainCRF(np.zeros((WIDTH, size)), prior.copy())
    model.weights[_column("1"), 0] = 1.0  # without training nothing is labelled
    if not parts:
        return model
    shift = np.cumsum([0, *(len(p[3]) for p in parts)])
    y = np.concatenate([p[3] for p in parts])
    g = Graph(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + s for p, s in zip(parts, shift)]), np.concatenate([p[2] for p in parts]), [], np.full(len(y), -1))
    wanted = np.eye(size)[y]
    joint = np.zeros((len(g.edges), size, size))
    joint[np.arange(len(g.edges)), y[g.edges[:, 0]], y[g.edges[:, 1]]] = 1
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.pairs)]
    for step in range(1, steps + 1):
        nodes, edges = model.marginals(g, rounds=4, evidence=False)
        grad = np.zeros_like(model.weights)
        np.add.at(grad, g.columns, np.repeat((wanted - nodes)[:, None, :], g.columns.shape[1], axis=1))
        diff = np.zeros_like(model.pairs)
        np.add.at(diff, g.kind, joint - edges)
        grads = [grad / len(y) - ridge * model.weights, diff / len(y) - ridge * (model.pairs - prior)]
        for x, d, (first, second) in zip((model.weights, model.pairs), grads, moments):
            first += 0.1 * (d - first)
            second += 0.01 * (d * d - second)
            x += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model


def whole_address(text: str, begin: int, lowest: int) -> int:
    """Where an address begins of which the pattern caught the end: letters and digits of any alphabet before it."""
    while begin > lowest and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-"):
        begin -= 1
    return begin


def added_spans(model: SkipChainCRF, texts: list[str], base: list[list[Span]], threshold: float = 0.7) -> list[list[Span]]:
    """Mentions sure to the threshold that no base match touches, and addresses wider than their base match."""
    out: list[list[Span]] = [[] for _ in texts]
    g = graph(texts, base)
    if not len(g.places):
        return out
    nodes, _ = model.marginals(g)
    kind = nodes.argmax(axis=1)
    for node in np.flatnonzero((nodes.max(axis=1) >= threshold) & (kind > 0) & (g.seen < 0)).tolist():
        number, a, b = g.places[node]
        out[number].append((LABELS[kind[node]], a, b))
    for node in np.flatnonzero(g.seen == LABELS.index("email")).tolist():
        number, a, b = g.places[node]
        for name, begin, end in base[number]:
            if name == "email" and a <= begin and end <= b and (wide := whole_address(texts[number], begin, a)) < begin:
                out[number].append((name, wide, end))
    return out


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    return sorted([*base, *more], key=lambda s: (LABELS.index(s[0]), s[1], s[2]))


def fit(docs: DataFrame, max_rows: int = 800, max_mentions: int = 1000) -> SkipChainCRF:
    """Train on a bounded sample: about max_rows whole documents that hold a digit or an at-sign, labelled by their own matches.

    Of these, lists of more than max_mentions mentions (tables of numbers) are left out of the training, so that what the
    driver holds is bounded too.
    """
    rows = bounded_sample(docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text"), "doc_id", max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [t for t in part.column("text").to_pylist() if len(mentions(t)[0]) <= max_mentions]
                found = [[x.astype(np.int32).tobytes() for x in e] for t in texts for e in examples(t)]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in range(4)], list("abcd"))

    got = rows.select("text").mapInArrow(run, "a binary, b binary, c binary, d binary").toArrow()
    raw = sorted(zip(*(got[c].to_pylist() for c in "abcd")))
    return train([tuple(np.frombuffer(x, np.int32).astype(np.int64).reshape(shape) for x, shape in zip(r, ((-1, FACTS), (-1, 2), -1, -1))) for r in raw])


def find(docs: DataFrame, model: SkipChainCRF, keep: list[str] | None = None) -> DataFrame:
    """Columns of keep (doc_id), base and spans: arrays of (kind, start, end) for every row."""
    names = keep or ["doc_id"]
    rows = docs.select(*dict.fromkeys([*names, "text"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows_of(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(shared.value, texts, base)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), rows_of(base), rows_of([merged(b, m) for b, m in zip(base, more)])], [*names, "base", "spans"])

    fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    spans = "array<struct<kind:string,start:int,end:int>>"
    return rows.mapInArrow(run, f"{fields}, base {spans}, spans {spans}")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from `find`'s."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found.select("doc_id", *map(count, KINDS), F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"), added)


def op3(docs: DataFrame) -> DataFrame:
    return digest(find(docs.select("doc_id", "text"), fit(docs)))
