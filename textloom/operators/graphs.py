"""Graph scores that need assignment or search, graph by graph, in Arrow batches."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Triple = tuple[str, str, str]


def assignment(score: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows and columns of the largest total score: shortest augmenting paths with potentials."""
    flip = score.shape[0] > score.shape[1]
    cost = -(score.T if flip else score)
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        low, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = owner[j0]
            free = np.flatnonzero(~used[1:]) + 1
            reduced = cost[i0 - 1, free - 1] - u[i0] - v[free]
            better = reduced < low[free]
            low[free[better]], way[free[better]] = reduced[better], j0
            j1 = free[np.argmin(low[free])]
            delta = low[j1]
            u[owner[used]] += delta
            v[used] -= delta
            low[free] -= delta
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0], j0 = owner[way[j0]], way[j0]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return sorted((j, i) for i, j in pairs) if flip else sorted(pairs)


def transported(score: np.ndarray, supply: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """Units [row, column] of the largest total score that bring the smaller side to the other one: shortest augmenting
    paths with potentials as in `assignment`, as many units at once as a path carries."""
    if supply.sum() > demand.sum():
        return transported(score.T, demand, supply).T
    cost, left, room = -score, supply.astype(np.int64), demand.astype(np.int64)
    n, m = cost.shape
    u, v, flow = cost.min(axis=1), np.zeros(m), np.zeros((m, n), np.int64)
    for i in range(n):
        while left[i]:
            low, way, done = cost[i] - u[i] - v, np.full(m, i), np.zeros(m, bool)
            came, far = {i: -1}, {i: 0.0}  # rows of the tree: the column before them, and their distance
            while True:
                j = int(np.argmin(np.where(done, np.inf, low)))
                done[j] = True
                if room[j]:
                    break
                for r in np.flatnonzero(flow[j]).tolist():
                    if r not in came:
                        came[r], far[r] = j, low[j]
                        other = low[j] + cost[r] - u[r] - v
                        better = (other < low) & ~done
                        low[better], way[better] = other[better], r
            for r, d in far.items():
                u[r] += low[j] - d
            v[done] -= low[j] - low[done]
            path, r = [(j, int(way[j]), 1)], int(way[j])
            while r != i:
                path += [(came[r], r, -1), (came[r], int(way[came[r]]), 1)]
                r = int(way[came[r]])
            units = min(left[i], room[j], *(flow[c, r] for c, r, sign in path if sign < 0)) if len(path) > 1 else min(left[i], room[j])
            for c, r, sign in path:
                flow[c, r] += sign * units
            left[i] -= units
            room[j] -= units
    return flow.T


#: Words of each slot of an edge.
Form = tuple[tuple[str, ...], ...]
#: A word that at most this many pairs of unlike edges share is looked up pair by pair.
LINKED = 64


class Pairs(NamedTuple):
    """All pairs of two sides' edges, by classes of edges that are in the same place: see `paired`."""

    supply: np.ndarray
    demand: np.ndarray
    patterns: tuple[list[Form], list[Form]]
    pattern: tuple[np.ndarray, np.ndarray]  # each class's
    linked: list[tuple[Form, Form]]  # a pair of each kind that shares rare words
    links: list[tuple[int, int, int]]  # (gold's class, pred's class, kind)
    whole: list[tuple[int, int]]  # classes all of whose pairs share rare words

    def best(self, plain: np.ndarray, linked: np.ndarray, value=lambda x: x) -> tuple[np.ndarray, np.ndarray]:
        """(outcomes, units) of pairs of classes, units of the largest total value; plain: the patterns' outcomes, linked: those of the kinds."""
        out = plain[np.ix_(*self.pattern)]
        score = value(out).astype(float)
        for c, d in self.whole:
            score[c, d] = -np.inf
        for c, d, k in self.links:
            if (x := float(value(linked[k]))) > score[c, d]:
                score[c, d], out[c, d] = x, linked[k]
        return out, transported(score, self.supply, self.demand)


def paired(gold: list[Form], pred: list[Form]) -> Pairs:
    """Classes of edges such that a best matching of classes, with as many units as edges, is one of the edges.

    A pair without a rare word in common scores as its patterns do, in which rare words only hold a place; the few others
    are linked. Equal edges are one with a weight. Classes start from pattern and weight and are split until the edges of
    a class have equal numbers of links of a kind to every class (an equitable partition): a best matching can then be
    spread evenly over each class, so that of the classes has the same total. Nothing is left out, whatever the words.
    """
    sides = Counter(gold), Counter(pred)
    forms = tuple(list(x) for x in sides)
    rows = tuple({} for _ in forms)  # a word's edges
    for side, words in zip(forms, rows):
        for i, form in enumerate(side):
            for w in set(chain.from_iterable(form)):
                words.setdefault(w, []).append(i)
    rare = {w for words in rows for w in words if len(rows[0].get(w, ())) * len(rows[1].get(w, ())) <= LINKED}
    # marks of the two sides are unlike each other and every word
    masked = tuple([tuple(tuple(mark if w in rare else w for w in slot) for slot in form) for form in side] for mark, side in enumerate(forms))
    patterns = tuple(list(dict.fromkeys(x)) for x in masked)
    place = tuple({f: i for i, f in enumerate(x)} for x in patterns)
    kinds: dict[tuple, int] = {}
    linked: list[tuple[Form, Form]] = []
    near = [[] for _ in forms[0]], [[] for _ in forms[1]]  # an edge's links (other edge, kind)
    for i, j in dict.fromkeys((i, j) for w in rows[0] if w in rare and w in rows[1] for i in rows[0][w] for j in rows[1][w]):
        names: dict[str, int] = {}  # rare words by their places in the pair: no outcome depends on the words themselves
        key = tuple(tuple(tuple(names.setdefault(w, len(names)) if w in rare else w for w in slot) for slot in form) for form in (forms[0][i], forms[1][j]))
        k = kinds.setdefault(key, len(kinds))
        if k == len(linked):
            linked.append((forms[0][i], forms[1][j]))
        near[0][i].append((j, k))
        near[1][j].append((i, k))
    colours = [_numbered((place[s][f], n) for f, n in zip(masked[s], sides[s].values())) for s in (0, 1)]
    while True:
        finer = [_numbered((c, tuple(sorted((colours[1 - s][j], k) for j, k in links))) for c, links in zip(colours[s], near[s])) for s in (0, 1)]
        same = all(max(a, default=0) == max(b, default=0) for a, b in zip(colours, finer))
        colours = finer
        if same:
            break
    members = [Counter(x) for x in colours]
    units, pattern = ([np.zeros(len(x), np.int64) for x in members] for _ in range(2))
    for s in (0, 1):
        for c, f, n in zip(colours[s], masked[s], sides[s].values()):
            units[s][c] += n
            pattern[s][c] = place[s][f]
    links = Counter((colours[0][i], colours[1][j], k) for i, js in enumerate(near[0]) for j, k in js)
    between: Counter = Counter()
    for (c, d, _), n in links.items():
        between[c, d] += n
    whole = [cd for cd, n in between.items() if n == members[0][cd[0]] * members[1][cd[1]]]
    return Pairs(*units, patterns, tuple(pattern), linked, list(links), whole)


def _numbered(keys: Iterable) -> list[int]:
    """Equal keys by equal numbers, from 0 in order of first occurrence."""
    seen: dict = {}
    return [seen.setdefault(k, len(seen)) for k in keys]


def _grams(words: list[str], n: int) -> Counter:
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def bleu(reference: list[str], guess: list[str], order: int = 4) -> float:
    """Sentence BLEU; an order without matches counts a small epsilon."""
    if not guess:
        return 0.0
    logs = 0.0
    for n in range(1, order + 1):
        have = _grams(guess, n)
        hit, total = sum((have & _grams(reference, n)).values()), max(1, sum(have.values()))
        if n == 1 and not hit:
            return 0.0
        logs += math.log((hit or 0.1) / total) / order
    return math.exp(logs + min(0.0, 1 - len(reference) / len(guess)))


def rouge2_precision(reference: list[str], guess: list[str]) -> float:
    have = _grams(guess, 2)
    return sum((have & _grams(reference, 2)).values()) / sum(have.values()) if have else 0.0


def edges_of(rows: list[Triple]) -> list[list[str]]:
    return [" ".join(t).lower().split() for t in rows]


def matched(gold: list[Triple], pred: list[Triple], measure) -> tuple[float, float, float]:
    """Precision, recall and F1 of the best one-to-one matching of edges under a similarity."""
    if not gold or not pred:
        return 0.0, 0.0, 0.0
    return _matched(_paired_edges(gold, pred), measure)


def _paired_edges(gold: list[Triple], pred: list[Triple]) -> Pairs:
    return paired(*([(tuple(words),) for words in edges_of(side)] for side in (gold, pred)))


def _matched(pairs: Pairs, measure) -> tuple[float, float, float]:
    of = lambda g, p: measure(g[0], p[0])
    plain = np.array([[of(a, b) for b in pairs.patterns[1]] for a in pairs.patterns[0]], float)
    score, units = pairs.best(plain, np.array([of(a, b) for a, b in pairs.linked], float))
    used = units > 0  # a score may be -inf where there is no pair
    total = float((score[used] * units[used]).sum())
    precision, recall = total / pairs.demand.sum().item(), total / pairs.supply.sum().item()
    return precision, recall, 2 * precision * recall / (precision + recall) if precision + recall else 0.0


def isomorphic(gold: list[Triple], pred: list[Triple]) -> bool:
    """Directed isomorphism that keeps edge labels and ignores node names; of parallel edges the last label holds.

    Nodes are told apart by the labels around them, round after round; the rest is tried, from mapped nodes to those
    beside them, without recursion."""
    edges = {(s, o): p for s, p, o in gold}, {(s, o): p for s, p, o in pred}
    if len(edges[0]) != len(edges[1]) or Counter(edges[0].values()) != Counter(edges[1].values()):
        return False
    if edges[0] == edges[1]:
        return True
    beside: tuple[dict, dict] = {}, {}  # a node's (outward, label, other node)
    for side, of in zip(edges, beside):
        for (s, o), p in side.items():
            of.setdefault(s, []).append((True, p, o))
            of.setdefault(o, []).append((False, p, s))
    labels: dict = {}
    for side in edges:
        for p in side.values():
            labels.setdefault(p, len(labels))
    colours = [{n: labels.get(side.get((n, n)), -1) for n in of} for side, of in zip(edges, beside)]
    for _ in range(REFINED):  # the search needs no more than it can get: it is held to every edge
        if Counter(colours[0].values()) != Counter(colours[1].values()):
            return False
        seen: dict = {}
        finer = [{n: seen.setdefault((c[n], tuple(sorted((out, labels[p], c[x]) for out, p, x in of[n]))), len(seen)) for n in of} for c, of in zip(colours, beside)]
        if len(seen) == len(set(colours[0].values()) | set(colours[1].values())):
            break
        colours = finer
    if Counter(colours[0].values()) != Counter(colours[1].values()):
        return False
    return _mapped(edges, beside, colours)


#: Rounds in which the nodes' colours are refined before the search.
REFINED = 16


def _mapped(edges: tuple[dict, dict], beside: tuple[dict, dict], colours: list[dict]) -> bool:
    """Whether nodes can be mapped one to one, colours and labelled edges kept; both sides have as many of each."""
    (a, b), sizes = edges, Counter(colours[0].values())
    # nodes of a in the order of the search: beside one that came before, of the rarest colour
    order: list[str] = []
    met: set = set()
    for start in sorted(beside[0], key=lambda n: sizes[colours[0][n]]):
        line = [] if start in met else [(0, 0, start)]
        met.add(start)
        while line:
            n = heapq.heappop(line)[-1]
            order.append(n)
            for _, _, x in beside[0][n]:
                if x not in met:
                    met.add(x)
                    heapq.heappush(line, (sizes[colours[0][x]], len(met), x))
    # b's nodes that are free: by colour, and by colour around each node
    free: dict[tuple, dict[str, None]] = {}
    keys = {n: [(c := colours[1][n],), *((x, not out, p, c) for out, p, x in beside[1][n] if x != n)] for n in beside[1]}
    for n, ks in keys.items():
        for k in ks:
            free.setdefault(k, {})[n] = None
    to: dict[str, str] = {}
    back: dict[str, str] = {}

    def candidates(n: str):
        around = [(to[x], not out, p, colours[0][n]) for out, p, x in beside[0][n] if x in to]
        pool = min((free.get(k, {}) for k in around or [(colours[0][n],)]), key=len)
        first = next(iter(pool), None)
        if first is not None:
            yield first
            yield from [c for c in pool if c != first]  # only where the first one failed

    def fits(n: str, c: str) -> bool:
        near = [(out, p, c if x == n else to[x]) for out, p, x in beside[0][n] if x == n or x in to]
        return len(near) == sum(x == c or x in back for _, _, x in beside[1][c]) and all((b.get((c, y)) if out else b.get((y, c))) == p for out, p, y in near)

    def undo(n: str) -> None:
        c = to.pop(n)
        del back[c]
        for k in keys[c]:
            free[k][c] = None

    tried = []
    while len(to) < len(order):
        n = order[len(to)]
        if len(tried) == len(to):
            tried.append(candidates(n))
        c = next((c for c in tried[-1] if fits(n, c)), None)
        if c is not None:
            to[n], back[c] = c, n
            for k in keys[c]:
                del free[k][c]
            continue
        tried.pop()
        if not tried:
            return False
        undo(order[len(to) - 1])
    return True


Edges = dict[tuple[str, str], str]
#: Graphs of up to this many nodes get their exact edit distance; larger ones the distance under equal names.
EXACT_NODES = 7


def _edges(rows: list[Triple]) -> Edges:
    cell = lambda c: str(c).lower().strip()
    return {(cell(s), cell(o)): cell(p) for s, p, o in rows}


def _edge_cost(a: str | None, b: str | None) -> int:
    return int(a != b)


def named_distance(a: Edges, b: Edges) -> int:
    """Edits that turn a into b where nodes keep their names: unlike nodes are renamed, made or deleted with all their edges."""
    na, nb = {n for e in a for n in e}, {n for e in b for n in e}
    return max(len(na - nb), len(nb - na)) + sum(_edge_cost(a.get(e), b.get(e)) for e in a.keys() | b.keys())


def edit_distance(gold: list[Triple], pred: list[Triple]) -> tuple[int, bool]:
    """(edits of nodes and edges, 1 each, that turn gold into pred; whether that is the least number).

    Every way to map gold's nodes to pred's or to none is tried, cheapest first node by node, as long as it may beat the
    best one found; nodes match by name, edges by label.
    """
    a, b = _edges(gold), _edges(pred)
    na, nb = sorted({n for e in a for n in e}), sorted({n for e in b for n in e})
    best = named_distance(a, b)
    if max(len(na), len(nb)) > EXACT_NODES:
        return best, False

    def extend(k: int, to: list[str | None], cost: int) -> None:
        nonlocal best
        if cost + max(0, (len(nb) - sum(t is not None for t in to)) - (len(na) - k)) >= best:
            return
        if k == len(na):
            used = set(to)
            new = [n for n in nb if n not in used]
            best = min(best, cost + len(new) + sum(s in new or o in new for s, o in b))
            return
        n = na[k]
        for target in sorted((t for t in nb if t not in to), key=lambda t: t != n) + [None]:
            more = 1 if target is None else _edge_cost(n, target)
            for other, place in [*zip(na[:k], to), (n, target)]:
                ways = [(n, other), (other, n)] if other != n else [(n, n)]
                for s, o in ways:
                    s2, o2 = (target if x == n else place for x in (s, o))
                    more += _edge_cost(a.get((s, o)), b.get((s2, o2)) if s2 is not None and o2 is not None else None)
            extend(k + 1, [*to, target], cost + more)

    extend(0, [], 0)
    return best, True


def normalised_edit_distance(gold: list[Triple], pred: list[Triple]) -> tuple[float, bool]:
    """Edits over the gold's nodes and edges and 30 more, the prediction cut to the gold's length; and whether they are the least."""
    edges = _edges(gold)
    size = len(edges) + len({n for e in edges for n in e}) + 30
    edits, exact = edit_distance(gold, pred[: len(gold)])
    return edits / size, exact


def graph_scores(graphs: DataFrame) -> DataFrame:
    """graphs (graph_id, side gold or pred, pos, s, p, o) -> one row of scores per graph."""

    def score(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        gold, pred = ([tuple(t) for t in rows.loc[rows["side"] == x, ["s", "p", "o"]].itertuples(index=False)] for x in ("gold", "pred"))
        pairs = _paired_edges(gold, pred) if gold and pred else None
        b, r = (_matched(pairs, x) if pairs else (0.0, 0.0, 0.0) for x in (bleu, rouge2_precision))
        return pd.DataFrame([(key[0], *b, *r, isomorphic(gold, pred), *normalised_edit_distance(gold, pred))], columns=["graph_id", "bleu_p", "bleu_r", "bleu_f1", "rouge_p", "rouge_r", "rouge_f1", "isomorphic", "edit_distance", "least"])

    return graphs.groupBy("graph_id").applyInPandas(score, "graph_id long, bleu_p double, bleu_r double, bleu_f1 double, rouge_p double, rouge_r double, rouge_f1 double, isomorphic boolean, edit_distance double, least boolean")


SLOTS = {"s": "SUB", "p": "PRED", "o": "OBJ"}
SCHEMES = ("ent_type", "partial", "strict", "exact")
KINDS = ("correct", "incorrect", "partial", "missed", "spurious")
#: What becomes of a slot: nothing on either side, nothing in common, only gold's, only pred's, the same words, some in
#: common, and these two where the words stand in another slot of the prediction.
NOTHING, APART, GOLD, PRED, SAME, SHARED, SAME_ELSEWHERE, SHARED_ELSEWHERE = range(8)
# For each outcome with words in common, what each scheme counts it as.
COUNTED = {
    SAME: ("correct", "correct", "correct", "correct"),
    SHARED: ("correct", "partial", "incorrect", "incorrect"),
    SAME_ELSEWHERE: ("incorrect", "correct", "incorrect", "correct"),
    SHARED_ELSEWHERE: ("incorrect", "partial", "incorrect", "incorrect"),
}


def _counts() -> np.ndarray:
    """[outcome, scheme, kind]: counts of a slot."""
    out = np.zeros((8, len(SCHEMES), len(KINDS)), np.int64)
    for outcome, names in COUNTED.items():
        for scheme, name in enumerate(names):
            out[outcome, scheme, KINDS.index(name)] = 1
    out[[APART, GOLD], :, KINDS.index("missed")] = 1
    out[[APART, PRED], :, KINDS.index("spurious")] = 1
    return out


COUNTS = _counts()
#: In these schemes a partial match counts half.
HALVES = np.array([0.5, 0.5, 0.0, 0.0])


def prf(counts: np.ndarray) -> np.ndarray:
    """[..., scheme, kind] -> [..., scheme, (precision, recall, F1)]; 0 where undefined."""
    cor, inc, par, mis, spu = (counts[..., k].astype(float) for k in range(5))
    right = cor + HALVES * par
    div = lambda x, y: np.divide(x, y, out=np.zeros_like(x), where=y > 0)
    p, r = div(right, cor + inc + par + spu), div(right, cor + inc + par + mis)
    return np.stack([p, r, div(2 * p * r, p + r)], axis=-1)


_TRIPLES = np.stack(np.unravel_index(np.arange(512), (8, 8, 8)), axis=1)
#: Of each three outcomes: scores of the three slots together.
SCORES = prf(COUNTS[_TRIPLES].sum(axis=1))


def slot_words(text: str) -> tuple[str, ...]:
    """Words in lower case, without signs."""
    return tuple(w for w in (re.sub(r"[^\w]+", "", x) for x in text.lower().split()) if w)


def _compared(gold: list[tuple[str, ...]], pred: list[tuple[str, ...]]) -> np.ndarray:
    """Outcome of every pair, each two different texts compared once."""
    g, p = list(dict.fromkeys(gold)), list(dict.fromkeys(pred))
    sets = [frozenset(x) for x in p]
    table = np.array([[SAME if x == y and x else SHARED if s & set(x) else NOTHING if not x and not y else APART if x and y else GOLD if x else PRED for y, s in zip(p, sets)] for x in g], np.int64).reshape(len(g), len(p))
    places = ({x: i for i, x in enumerate(g)}, {x: i for i, x in enumerate(p)})
    return table[np.array([places[0][x] for x in gold])[:, None], np.array([places[1][x] for x in pred])[None]]


def slot_outcomes(gold: list[Triple], pred: list[Triple]) -> np.ndarray:
    """[gold, pred, slot]: outcomes of all pairs. Where two slots have nothing in common each, their words are looked for
    in the other one: subject and object, subject and predicate, predicate and object, the first that has some."""
    return _outcomes(*([slot_form(t) for t in side] for side in (gold, pred)))


def slot_form(triple: Triple) -> Form:
    return tuple(slot_words(x) for x in triple)


def _outcomes(gold: list[Form], pred: list[Form]) -> np.ndarray:
    g, p = ([[t[k] for t in side] for k in range(3)] for side in (gold, pred))
    out = np.stack([_compared(g[k], p[k]) for k in range(3)], axis=-1)
    for i, j in ((0, 2), (0, 1), (1, 2)):
        apart = (out[..., i] == APART) & (out[..., j] == APART)
        if apart.any():
            x, y = _compared(g[i], p[j]), _compared(g[j], p[i])
            swapped = apart & ((x == SAME) | (x == SHARED) | (y == SAME) | (y == SHARED))
            for k, z in ((i, x), (j, y)):
                elsewhere = np.where(z == SAME, SAME_ELSEWHERE, np.where(z == SHARED, SHARED_ELSEWHERE, APART))
                out[..., k] = np.where(swapped, elsewhere, out[..., k])
    return out


def slot_table(gold: list[Triple], pred: list[Triple]) -> list[tuple]:
    """(scheme, tag, counts, means of precision, recall and F1 over aligned pairs) of one graph.

    The shorter side is filled up with empty triples; pairs are aligned one to one by the largest sum of the mean F1 of
    the four schemes.
    """
    size = max(len(gold), len(pred))
    if not size:
        return []
    filled = [[*map(slot_form, side), *[((), (), ())] * (size - len(side))] for side in (gold, pred)]
    pairs, code = paired(*filled), np.array([64, 8, 1])
    plain = _outcomes(*pairs.patterns) @ code
    linked = np.array([int(_outcomes([g], [p])[0, 0] @ code) for g, p in pairs.linked], np.int64)
    chosen, units = pairs.best(plain, linked, lambda x: SCORES[:, :, 2].mean(axis=1)[x])
    found, times = _TRIPLES[chosen[units > 0]], units[units > 0]  # outcomes of the slots, and pairs that have them
    rows = []
    for tag, slots in (("ALL", [0, 1, 2]), *((name, [k]) for k, name in enumerate(SLOTS.values()))):
        counts = COUNTS[found[:, slots]].sum(axis=1)  # pair, scheme, kind
        means = np.average(prf(counts), axis=0, weights=times)
        sums = (counts * times[:, None, None]).sum(axis=0)
        rows += [(scheme, tag, *sums[k].tolist(), *means[k].tolist()) for k, scheme in enumerate(SCHEMES)]
    return rows


SLOT_SCHEMA = "graph_id long, scheme string, tag string, correct long, incorrect long, partial long, missed long, spurious long, precision double, recall double, f1 double"


def slot_scores(graphs: DataFrame) -> DataFrame:
    """graphs (graph_id, side, pos, s, p, o) -> 16 rows a graph: four schemes for all slots, SUB, PRED and OBJ."""

    def score(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").fillna("")
        gold, pred = ([tuple(t) for t in rows.loc[rows["side"] == x, list(SLOTS)].itertuples(index=False)] for x in ("gold", "pred"))
        return pd.DataFrame([(key[0], *r) for r in slot_table(gold, pred)], columns=[c.split()[0] for c in SLOT_SCHEMA.split(", ")])

    return graphs.groupBy("graph_id").applyInPandas(score, SLOT_SCHEMA)


def slot_summary(scores: DataFrame) -> DataFrame:
    """Per scheme and tag: sums of the counts, means of the graphs' scores."""
    return scores.groupBy("scheme", "tag").agg(*(F.sum(k).alias(k) for k in KINDS), *(F.avg(c).alias(c) for c in ("precision", "recall", "f1")))


def comparable(graphs: DataFrame, most: int | None = None) -> DataFrame:
    """Graphs that have both sides; most: no more difference than this between their numbers of triples."""
    n = lambda side: F.count(F.when(F.col("side") == side, 1))
    sizes = graphs.groupBy("graph_id").agg(n("gold").alias("g"), n("pred").alias("p")).where("g > 0 and p > 0")
    return graphs.join(sizes if most is None else sizes.where(F.abs(F.col("g") - F.col("p")) <= most), "graph_id", "left_semi")
