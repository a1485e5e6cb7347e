"""Small tables with every awkward case, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from textloom.llm import brown_lm, components, decontamination, exact_dedup, langid, mixing, pii, simhash, substring_dedup, tokenstore, toxicity
from textloom.llm.words import NON_ALNUM, split

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, held_out string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


TEXTS = [
    (1, "The cat sat on the mat and looked at the dog. Mail joe.x@mail.example.com now", "en"), (2, None, "en"), (3, "", None), (4, "  \n\t ", "de"), (5, LONG, "en"), (6, LONG, "fr"),
    (7, "a " + PASSAGE + " b", "en"), (8, "c\n" + PASSAGE.replace(" ", "\n") + "  d", "en"), (None, "Der Hund und die Katze", "de"), (None, "Der Hund und die Katze", "de"), (1, "The cat sat on the mat and looked at the dog. Mail joe.x@mail.example.com now", "en"),
    (1, "another text, same id", "en"), (9, "É à ü 日本語   odd space \x1c end  ", None), (10, "call +1 (743) 555-3824 or (743) 555-3824, ip 10.0.0.300 10.0.0.3, card 4111 1111 1111 1111", "en"),
    (11, "x " * 80, "en"), (12, "You idiot, you pathetic clown", "en"), (13, "tail space ", "en"), (14, "tail  space\n", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, "s" if i else None, None, 1.0, "r", "h") for i, t, g in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_substring_dedup(docs, empty):
    words = [WORD.findall(t or "") for _, t, _ in TEXTS]
    counts = Counter(tuple(w[j : j + 35]) for w in words for j in range(len(w) - 34))
    want = Counter()
    for (i, _, _), w in zip(TEXTS, words):
        gone = {k for j in range(len(w) - 34) if counts[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
        want[i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] += 1
    for hot in (3.0, 0.0):
        got = substring_dedup.remove(docs, hot=hot)
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got.collect()) == want
    assert substring_dedup.op2(empty).count() == 0


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring_dedup, "span_hashes", lambda v, a, b, s=0: np.zeros(len(a), np.uint64))
    raw = [b"a b c d", b"e a b c", b"x y z w"]
    heads = np.array([(i, 0, 0, len(r)) for i, r in enumerate(raw)], np.int64)
    entry, a, b = substring_dedup.count_windows(heads, b"".join(raw), 3)
    assert sorted(zip(entry.tolist(), a.tolist(), b.tolist())) == [(0, 0, 3), (1, 1, 4)]


def test_hot_windows_are_covered_across_the_slices_of_a_task(spark, monkeypatch):
    """One passage in most documents, met slice after slice in one task: sent once, covered everywhere, also with a short memory."""
    monkeypatch.setattr(substring_dedup, "slices", lambda part, column="text", limit=0: (part.slice(i, 1) for i in range(part.num_rows)))
    rows = [(i, f"own{i} words{i} " + PASSAGE + f" end{i}" if i % 3 else f"nothing {i} shared") for i in range(30)]
    keyed = substring_dedup.text_key(spark.createDataFrame(rows, "doc_id long, text string"))
    batch = pa.RecordBatch.from_pandas(keyed.coalesce(1).toPandas(), preserve_index=False)
    buckets = 64
    w = split(batch.column("text"))
    begin, _, low, _ = substring_dedup.super_kmers(w, 35, 5)
    hot = np.unique(substring_dedup.bucket_of(low, buckets))
    for remembered in (0, 5, 50_000):
        monkeypatch.setattr(substring_dedup, "REMEMBERED", remembered)
        captured = {}
        frame = keyed.coalesce(1)
        monkeypatch.setattr(type(frame), "mapInArrow", lambda self, f, schema: captured.update(f=f) or self)
        substring_dedup._send(frame, 35, 5, buckets, hot)
        monkeypatch.undo()
        monkeypatch.setattr(substring_dedup, "slices", lambda part, column="text", limit=0: (part.slice(i, 1) for i in range(part.num_rows)))
        out = [r for b in captured["f"](iter([batch])) for r in b.to_pylist()]
        sent = sum(len(substring_dedup._unpack(r["payload"])[0]) for r in out if r["payload"] is not None)
        if remembered == 50_000:
            assert sent == len({tuple(x[j : j + 35]) for _, t in rows for x in [t.split()] for j in range(len(x) - 34)})
            covered = {(r["key_id"], k) for r in out if r["payload"] is None for k in range(r["begin"], r["end"])}
            assert covered == {(i, k) for i, t in rows if i % 3 for k in range(2, 62)}


def test_exact_dedup(docs, empty):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in TEXTS]
    groups = {}
    for (i, _, _), n in zip(TEXTS, norm):
        groups.setdefault(n, []).append(i)
    keep = {n: min((i for i in g if i is not None), default=None) for n, g in groups.items()}
    want = Counter((i, keep[n], len(groups[n]), i == keep[n], hashlib.sha256(n.encode()).hexdigest()) for (i, _, _), n in zip(TEXTS, norm))
    assert rows(exact_dedup.op8(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact_dedup.op8(empty).count() == 0


@pytest.mark.parametrize("start", [b"", b"<", b"the same long beginning of every text "])
def test_trie_spills_and_forgets_nothing(start, monkeypatch):
    rng = np.random.default_rng(0)
    keys = [start + bytes(rng.integers(97, 100, rng.integers(0, 12)).astype(np.uint8)) for _ in range(3000)]
    tries = []
    init = exact_dedup.Patricia.__init__
    monkeypatch.setattr(exact_dedup.Patricia, "__init__", lambda self, limit=0: (init(self, limit), tries.append(self))[0])
    trie, want, most = exact_dedup.Patricia(limit=20_000), {}, 0
    for i, k in enumerate(keys):
        trie.insert(k, i, 1)
        most = max(most, trie.held, trie.root.size())
        a, n = want.get(k, (i, 0))
        want[k] = (min(a, i), n + 1)
    assert trie.spills and most < 21_500 and {k: v[:2] for k, v in trie.items()} == want
    assert all(t.held < 21_500 for t in tries)


def test_trie_of_nested_strings():
    keys = [b"ab" * n for n in range(60)] * 2
    trie = exact_dedup.Patricia(limit=500)
    for i, k in enumerate(keys):
        trie.insert(k, i, 1)
    assert {k: v[:2] for k, v in trie.items()} == {b"ab" * n: (n, 2) for n in range(60)}


def test_decontamination(docs, empty, spark):
    items = [(1, PASSAGE), (2, "THE cat-sat"), (3, None), (None, "der hund"), (4, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontamination.op4(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "contaminated")
    assert got[7, 62, 60, 1, True] == 1 and got[8, 62, 60, 1, True] == 1 and got[None, 5, 2, 1, True] == 2 and got[2, 0, 0, 0, False] == 1
    assert got[1, 18, 3, 1, True] == 2
    small = decontamination.with_verdict(decontamination.hits(docs, bench, shard_bytes=500))
    assert rows(small, "doc_id", "n_words", "n_hit", "n_items", "contaminated") == got  # several shards
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in small.where("doc_id = 8").collect()}
    assert TEXTS[7][1][spans[8][0][0] : spans[8][0][1]].split() == PASSAGE.split()
    assert decontamination.op4(empty, bench).count() == 0
    assert decontamination.op4(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def brute_fingerprint(text):
    w = WORD.findall(lower(text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[j : j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, empty):
    prints = [brute_fingerprint(t) for _, t, _ in TEXTS]
    group = list(range(len(prints)))
    for _ in group:
        group = [min(group[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(prints))]
    low = {g: min((TEXTS[i][0] for i in range(len(group)) if group[i] == g and TEXTS[i][0] is not None), default=None) for g in group}
    want = Counter((TEXTS[i][0], f"{prints[i]:016x}", low[group[i]]) for i in range(len(prints)))
    assert rows(simhash.op7(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.op7(empty).count() == 0


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_bit_slices_and_forests(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 62, 5, dtype=np.uint64)
    x = np.unique(np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))) for b in base for _ in range(40)], np.uint64))
    near = np.array([[(int(a) ^ int(b)).bit_count() <= radius for b in x] for a in x])
    found = np.zeros_like(near)
    for i, lanes in simhash.within(simhash.bit_planes(x), len(x), x, radius):
        found[i, lanes] = True
    assert (found == near).all()
    a, b = np.triu_indices(len(x), 1)
    assert (simhash.close_pairs(x[a], x[b], radius) == near[a, b]).all()


@pytest.mark.parametrize(("bands", "chunk"), [(4, 512), (5, 512), (6, 16), (8, 512)])
def test_links_of_dense_prints_for_every_number_of_bands(spark, bands, chunk):
    """Prints in tight clusters: the links connect what brute force connects, whatever the bands."""
    rng = np.random.default_rng(bands)
    base = rng.integers(0, 1 << 62, 12, dtype=np.uint64)
    x = np.unique(np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False))) for b in base for _ in range(25)], np.uint64))
    prints = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fingerprint long")
    got = dict(map(tuple, components.components(simhash.links(prints, 3, chunk, bands)).collect()))
    group = list(range(len(x)))
    for _ in group:
        group = [min(group[j] for j in range(len(x)) if (int(x[i]) ^ int(x[j])).bit_count() <= 3) for i in range(len(x))]
    signed = x.view(np.int64).tolist()
    want = {v: min(signed[j] for j in range(len(x)) if group[j] == group[i]) for i, v in enumerate(signed)}
    assert {v: got.get(v, v) for v in signed} == want


def test_copies_and_load_stay_bounded_as_prints_grow():
    for power in range(3, 13):
        n = 10**power
        m = simhash.bands_for(n)
        keys = simhash.masks(m)
        assert len(set(keys)) == len(keys) <= 56
        assert all(n / 2.0 ** bin(k & (1 << 64) - 1).count("1") <= simhash.LOAD for k in keys)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (5, 5), (None, 3)], "u long, v long")
    got = dict(map(tuple, components.components(edges).collect()))
    assert all(got[i] == 0 for i in range(41)) and got[200] == got[100] == 100
    assert components.components(edges.limit(0)).count() == 0


def test_token_store(docs, empty, spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenstore.default_tokenizer())
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, t, _ in TEXTS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = tokenstore.op6(docs, str(tmp_path / "store"))
    assert rows(got, "doc_id", "n_tokens", "ids_crc32") == want
    at = 0
    for r in got.orderBy("start").collect():
        assert r["start"] == at
        at += r["n_tokens"]
    assert tokenstore.document(spark, str(tmp_path / "store"), 13)[-1] == 2 and tokenstore.document(spark, str(tmp_path / "store"), 99) is None
    assert tokenstore.op6(empty).count() == 0


def test_token_store_puts_null_ids_first_and_ties_by_text(spark, tmp_path):
    rows_ = [(None, "b b"), (3, "x"), (None, "a"), (None, "b b"), (1, None), (1, "y z"), (-5, "low")]
    got = tokenstore.op6(spark.createDataFrame(rows_, "doc_id long, text string").repartition(4), str(tmp_path / "nulls")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, None, -5, 1, 1, 3] and [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    same = Counter((r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] is None)
    assert sorted(same.values()) == [1, 2]


def test_pieces_encode_as_whole_texts():
    e = tokenstore.encoder(tokenstore.default_tokenizer())
    texts = ["a  b\n\n c", " lead", "trail  \n", "it's we'll", "\n", "x\t y", "1 2,3!? é z", "a   b", "tab\x1c x", "日本 語"]
    texts += ["", "don't I'LL o'clock", "Ünïcode ñandú ǅ ª² ٣٤ ½", "\x85 nel", " \u3000 wide ", "e\u0301 combining", "snake_case x1y2 $5", "é. ñ, ×. ÷, à' l'été! z…. z—, a.b;c a''s x.'s (a) \"b\"--"]
    tokens, cuts = e.batch(pa.array(texts), 2)
    assert [tokens[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] == [x + b"\2\0\0\0" for x in e.whole(texts)]


def test_pieces_encode_as_whole_documents():
    """All documents of a table, over and over through a cache that forgets, against the tokenizer on whole texts."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].combine_chunks()
    e = tokenstore.Encoder(tokenstore.default_tokenizer())
    want = [x + b"\2\0\0\0" for x in e.whole([t or "" for t in texts.to_pylist()])]
    for _ in range(2):
        tokens, cuts = e.batch(texts, 2)
        assert [tokens[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] == want
        e.old, e.young = e.young, {}


def test_ids_that_do_not_fit_are_refused(docs, tmp_path):
    with pytest.raises(ValueError, match="1 bytes"):
        tokenstore.write(docs, str(tmp_path / "narrow"), id_bytes=1)


def test_brown_scores(docs, empty):
    words = [[*WORD.findall(lower(t or "")), None] for _, t, _ in TEXTS]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _, _ in TEXTS]
    c = Counter(x for w, h in zip(words, held) if not h for x in w)
    n, v = sum(c.values()), len(c)
    want = Counter((i, h, len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4)) for (i, _, _), w, h in zip(TEXTS, words, held))
    got = brown_lm.op10(docs).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert brown_lm.op10(empty).count() == 0

    # the model's score, from each word's class alone
    dealt = brown_lm.deal(docs)
    table, model = brown_lm.fit(dealt)
    k = {bytes(r["word"]).decode(): r["k"] for r in table.where("lead").collect()}
    classes = [[k[x] if x is not None else model.end for x in w] for w in words]
    moves, inside = Counter(), Counter()
    for w, g, h in zip(words, classes, held):
        if not h:
            moves.update(zip([model.end, *g], g))
    n_classes = len(model.class_tokens)
    for x, n_x in c.items():
        inside[model.end if x is None else k[x], "tokens"] += n_x
        inside[model.end if x is None else k[x], "kinds"] += 1
    from_class = Counter()
    for (before, _), m in moves.items():
        from_class[before] += m

    def score(w, g):
        steps = sum(np.log10((moves[a, b] + 0.5) / (from_class[a] + 0.5 * n_classes)) for a, b in zip([model.end, *g], g))
        return steps + sum(np.log10((c[x] + 0.5) / (inside[y, "tokens"] + 0.5 * (inside[y, "kinds"] + 1))) for x, y in zip(w, g))

    want = Counter((i, round(score(w, g), 4)) for (i, _, _), w, g in zip(TEXTS, words, classes))
    assert Counter((r["doc_id"], round(r["score"], 4)) for r in got) == want


def test_rare_words_take_the_class_of_their_own_contexts(spark, monkeypatch):
    """Words beyond the frequent ones, one tail for all, of which half stand where 'cat' does and half where 'ran' does."""
    texts = [f"the cat{i % 40}x ran the cat ran{i % 40}x" for i in range(400)] + ["the cat ran"] * 100
    dealt = brown_lm.deal(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    words, model = brown_lm.fit(dealt, frequent=3, tails=1, classes=4)
    k = {bytes(r["word"]).decode(): r["k"] for r in words.where("lead and c > 0").collect()}
    assert len(k) == 83 and {k[w] for w in k if w.startswith("cat")} == {k["cat"]} and {k[w] for w in k if w.startswith("ran")} == {k["ran"]}
    assert k["cat"] != k["ran"] and model.class_kinds.tolist().count(41) == 2


def test_exchange_ends_where_no_single_move_helps():
    def information(pairs, group, k):
        one = np.eye(k)[group]
        table = one.T @ pairs @ one
        f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0).sum()
        return f(table) - f(table.sum(0)) - f(table.sum(1))

    rng = np.random.default_rng(0)
    for _ in range(10):
        pairs = rng.integers(0, 9, (8, 8)).astype(float)
        g = brown_lm.exchange(pairs, 3, sweeps=50)
        at = information(pairs, g, 3)
        assert all(information(pairs, np.where(np.arange(8) == i, c, g), 3) <= at + 1e-6 for i in range(8) for c in range(3))


def test_base_spans_match_the_plain_patterns():
    rng = np.random.default_rng(3)
    for _ in range(1500):
        t = "".join(rng.choice(list("a.@1234567890 -+()%é"), rng.integers(0, 60)))
        assert pii.base_spans(t) == plain_spans(t)


def plain_spans(t):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    passes = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": lambda s: 13 <= len(digits(s)) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits(s)[::-1])) % 10 == 0, "phone": lambda s: 9 <= len(digits(s)) <= 15}
    return [(k, *m.span()) for k, p in plain.items() for m in re.finditer(p, t) if passes[k](m[0])]


PII_TEXTS = [
    "call +1 (743) 555-3824 today. " + "walk the dog " * 40 + "or just (743) 555-3824 as said",
    "nobody knows (743) 555-3824 here " + "walk the dog " * 40,
    "card 4111 1111 1111 1111 was charged " + "and so on " * 30 + "card 4111 1111 1811 1111 again",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and later 04dbebab91ab85687d33eeaaf9ac699e1188f962 bare',
    "write to weiß.maß.34@mail7.example.com or joe@mail.example.com, then joe@mail by hand", "version 2.0 of 2004, 10.0.0.3 and 10.0.0 alone", None, "", "no digits at all",
]


def pii_training():
    rng = np.random.default_rng(11)
    out = []
    for i in range(160):
        d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
        fill = " ".join(rng.choice(["river", "stone", "lamp", "under", "green", "early"], 30))
        h = "".join(rng.choice(list("0123456789abcdef"), 40))
        what = [f"+1 ({d(3)}) 555-{d(4)}", f"4111 1111 1111 {d(4)}", f'token = "{h}"', f"ann{d(2)}@mail{d(1)}.example.com", f"{rng.integers(1, 250)}.0.{d(2).lstrip('0') or 1}.7", f"year 19{d(2)}", f"version {d(1)}.0"]
        out.append(f"{fill} {what[i % 7]} {fill} {what[(i // 7) % 7]} {fill}")
    return out


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.createDataFrame(list(enumerate(pii_training())), "doc_id long, text string"))


def exact_spans(model, text, threshold=0.7):
    """Base spans by the plain patterns, and the field's by summing over every labelling of the mentions."""
    import itertools

    base = sorted(plain_spans(text), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    g = pii.graph([text], [base])
    n, k = len(g.places), len(pii.LABELS)
    if not n:
        return base
    unary = model.weights[g.columns].sum(axis=1)
    total, sums = 0.0, np.zeros((n, k))
    free = [[int(x)] if x >= 0 else range(k) for x in g.seen]
    for y in itertools.product(*free):
        p = np.exp(sum(unary[i, v] for i, v in enumerate(y)) + sum(model.pairs[e, y[a], y[b]] for (a, b), e in zip(g.edges.tolist(), g.kind.tolist())))
        total += p
        for i, v in enumerate(y):
            sums[i, v] += p
    sums /= total
    more = [(pii.LABELS[int(s.argmax())], a, b) for s, (_, a, b), seen in zip(sums, g.places, g.seen) if seen < 0 and s.argmax() and s.max() >= threshold]
    for kind, a, b in base:
        if kind == "email":
            wide = a
            while wide and (text[wide - 1].isalnum() or text[wide - 1] in "._%+-"):
                wide -= 1
            if wide < a:
                more.append((kind, wide, b))
    return sorted({*base, *more}, key=lambda s: (pii.LABELS.index(s[0]), s[1], s[2]))


def test_pii_equals_brute_force_over_a_table(spark, docs, empty, field):
    texts = [*PII_TEXTS, *(t for _, t, _ in TEXTS)]
    rows_ = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "1 as base", "'x' as spans", "doc_id as kind")
    found = pii.digest(pii.find(rows_, field))
    for r in found.collect():
        text = texts[r["doc_id"]] or ""
        base = sorted(plain_spans(text), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        if len(pii.mentions(text[:2000])[0]) <= 6:
            assert r["spans"] == pii.joined(exact_spans(field, text)), text[:80]
        else:  # too many labellings to sum over
            assert set(pii.joined(base).split(",")) - {""} <= set(r["spans"].split(","))
    assert pii.op3(docs).count() == len(TEXTS) and pii.op3(empty).count() == 0


def test_skip_potentials_change_the_answer(field):
    def added(model, i):
        text = PII_TEXTS[i]
        return [(k, text[a:b]) for k, a, b in pii.added_spans(model, [text], [pii.base_spans(text)])[0]]

    alone = pii.SkipChainCRF(field.weights, np.concatenate([field.pairs[:1], np.zeros_like(field.pairs[1:])]))
    assert added(field, 0) == [("phone", "(743) 555-3824")] and added(alone, 0) == [] and added(field, 1) == []
    assert added(field, 2) == [("card", "4111 1111 1811 1111")] and added(alone, 2) == []
    assert added(field, 3) == [("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962")] * 2
    assert ("email", "weiß.maß.34@mail7.example.com") in added(field, 4) and ("email", "joe@mail") in added(field, 4)


def test_belief_propagation_is_exact_on_a_chain():
    rng = np.random.default_rng(1)
    k = len(pii.LABELS)
    model = pii.SkipChainCRF(rng.normal(size=(pii.WIDTH, k)), rng.normal(size=(3, k, k)))
    g = pii.Graph(rng.integers(0, pii.WIDTH, (3, pii.FACTS)), np.array([[0, 1], [1, 2]]), np.array([0, 2]), [], np.full(3, -1))
    u = model.weights[g.columns].sum(axis=1)
    joint = np.exp(u[0][:, None, None] + u[1][None, :, None] + u[2][None, None] + model.pairs[0][:, :, None] + model.pairs[2][None])
    joint /= joint.sum()
    nodes, edges = model.marginals(g, rounds=60)
    assert np.allclose(nodes, [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))], atol=1e-4) and np.allclose(edges[0], joint.sum(2), atol=1e-4)
    g.seen[2] = 1
    nodes, _ = model.marginals(g, rounds=60)
    assert np.allclose(nodes[0], joint[:, :, 1].sum(1) / joint[:, :, 1].sum(), atol=1e-4)


def test_language_id(docs, empty, spark):
    got = rows(langid.op1(docs), "doc_id", "lang_pred", "score")
    assert sum(got.values()) == len(TEXTS)
    assert all(k[1] == "und" and k[2] == 0 for k in got if k[0] in (2, 3, 4))
    assert langid.op1(empty).count() == 0
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = langid.op1(real).join(real.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(cast(lang = lang_pred as int)) as a").first()
    assert row["a"] > 0.95


def test_without_labels_every_language_is_undetermined(docs):
    from pyspark.sql import functions as F

    got = langid.op1(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(got) == len(TEXTS) and {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}


def brute_languages(net, texts):
    """The network of whole texts, window after window, filter after filter, in plain loops."""
    out = []
    for text in texts:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        cuts = [raw[i : i + net.window] for i in range(0, max(len(raw), 1), net.window)]
        total = np.zeros(len(net.languages))
        for k, cut in enumerate(cuts):
            window = raw[-net.window :] if k and len(cut) < net.window else cut
            e = np.concatenate([net.embedding[list(window) + [0] * (net.window - len(window))], np.zeros((net.width, net.embedding.shape[1]))])
            tops = [max(float(e[i : i + net.width].ravel() @ net.filters[:, f]) for i in range(net.window)) + net.bias[f] for f in range(net.filters.shape[1])]
            z = np.maximum(tops, 0) @ net.out + net.out_bias
            total += (z - np.log(np.exp(z - z.max()).sum()) - z.max()) * len(cut)
        mean = total / max(len(raw), 1)
        p = np.exp(mean - mean.max())
        out.append((net.languages[int(p.argmax())], float((p / p.sum()).max())))
    return out


def test_language_id_equals_plain_loops_over_the_network(docs):
    net = langid.fit(docs.withColumnRenamed("doc_id", "old").selectExpr("coalesce(old, 0) as doc_id", "text", "lang"), epochs=2)
    texts = [t for _, t, _ in TEXTS if t and any(c.isalpha() for c in t)]
    best, score = langid.predict(net, pa.array(texts), block=7)
    want = brute_languages(net, [t if len(t) < 3000 else t[:3000] for t in texts])
    short = [i for i, t in enumerate(texts) if len(t) < 3000]
    assert [(net.languages[best[i]], pytest.approx(score[i], abs=1e-3)) for i in short] == [want[i] for i in short]
    long = [t[:5000] for t in texts if len(t) >= 3000]
    best, score = langid.predict(net, pa.array(long))
    assert [(net.languages[b], pytest.approx(s, abs=1e-3)) for b, s in zip(best, score)] == brute_languages(net, long)


def test_rare_languages_are_learnt_and_crops_come_from_whole_texts(spark):
    rows = [(i, "the old house on the hill " * 5, "en") for i in range(400)] + [(1000 + i, "żółta łódź płynie " * 6, "pl") for i in range(4)]
    assert langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=50, epochs=1).languages == ["en", "pl"]
    late = langid.crops_of(b"a" * 5000 + b"z" * 15000, 128, 6)
    assert (late == ord("z")).any() and len(late) == 6


def test_toxicity(docs, empty, spark):
    labels = spark.createDataFrame([(12, 1, 1), (1, 1, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.op5(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert toxicity.op5(empty, labels).count() == 0 and toxicity.op5(docs, labels.limit(0)).where("score > 0").count() == 0
    folder = "/root/testdata/sf0.01"
    real, marks = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    row = toxicity.op5(real, marks).join(marks, "doc_id").where("held_out").selectExpr("avg(cast(toxic = predicted as int)) as a").first()
    assert row["a"] > 0.93


def counted_toxicity(rows, order=5, discount=0.75):
    """Scores of each text by the two models, from plain counts in dictionaries; rows: (text, class or None)."""
    words_of = lambda t: re.findall(r"[^\x00-\x60\x7B-\x7F]+", lower(t))
    pad = lambda w: [257] * (order - 1) + list(w.encode()) + [257]
    a = [Counter(), Counter()]
    for t, y in rows:
        for w in words_of(t) if y is not None else ():
            s = pad(w)
            a[y].update(tuple(s[i - order + 1 : i + 1]) for i in range(order - 1, len(s)))
    levels = {order - 1: Counter(g[1:] for g in set(a[0]) | set(a[1]))}
    for k in range(order - 2, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def sums(table):
        total, kinds = Counter(), Counter()
        for g, n in table.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        return total, kinds

    known = {k: sums(v) for k, v in levels.items()}
    own = [sums(x) for x in a]

    def shared(g):
        if not g:
            return 1 / 257
        total, kinds = known[len(g)]
        p = shared(g[1:])
        return p if not total[g[:-1]] else (max(levels[len(g)][g] - discount, 0) + discount * kinds[g[:-1]] * p) / total[g[:-1]]

    def log(y, w):
        s, out = pad(w), 0.0
        for i in range(order - 1, len(s)):
            g = tuple(s[i - order + 1 : i + 1])
            total, kinds = own[y]
            p = shared(g[1:])
            out += np.log(p if not total[g[:-1]] else (max(a[y][g] - discount, 0) + discount * kinds[g[:-1]] * p) / total[g[:-1]])
        return out

    found = []
    for t, _ in rows:
        w = words_of(t)
        r = [log(1, x) - log(0, x) for x in w]
        size = sum(len(x.encode()) + 1 for x in w)
        found.append((sum(r) / max(size, 1), sum(max(x - 4, 0) for x in r) / max(len(w), 1)))
    return found


def test_toxicity_equals_plain_counting(spark):
    rng = np.random.default_rng(5)
    mild, rude = ["garden", "boat", "überall", "tea", "walk"], ["zorgle", "blat", "garden", "kräx"]
    rows = [(i, " ".join(rng.choice(rude if i % 3 == 0 else mild, rng.integers(1, 9))) + (" x9y!" if i % 4 else ""), i % 3 == 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(60, None), (61, "")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.where("doc_id < 40"))
    got = {r["doc_id"]: r for r in toxicity.rate(docs, model).collect()}
    found = counted_toxicity([(t, int(y) if i < 40 else None) for i, t, y in rows])
    for (i, _, _), (mean, high) in zip(rows, found):
        z = model.curve @ [1, np.clip(20 * mean, -6, 6), np.log1p(40 * high)]
        assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9) and got[i]["predicted"] == int(got[i]["score"] >= 0.5)
    assert got[60]["score"] == got[61]["score"] == pytest.approx(1 / (1 + np.exp(-model.curve[0])))


def test_toxicity_learns_from_whole_texts(spark):
    start = "plain words of an ordinary day " * 1000
    texts = spark.createDataFrame([(i, f"{start} {i} " + ("zorgle" if i % 2 else "garden")) for i in range(24)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    model = toxicity.fit(texts, marks)
    plain, toxic = model.log_likelihoods(b"zorgle")
    assert toxic - plain > 1
    assert toxicity.rate(texts, model).where("predicted != doc_id % 2").count() == 0


def test_kneser_ney_sums_to_one_and_ratios_agree():
    model = toxicity.estimate([b"bad", b"bat", b"good"], np.array([[1, 5], [3, 0], [9, 1]]), order=3)
    for word in (b"bad", b"goat", b"zz"):
        plain, toxic = model.log_likelihoods(word)
        symbols, begins = toxicity.pad([word], 3)
        assert model.ratios(symbols, begins).sum() == pytest.approx(toxic - plain)


def test_mixing(docs, empty):
    got = mixing.op9(docs).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["probability"] <= 1 for r in got)
    assert mixing.op9(empty).count() == 0 and mixing.sample(docs).columns == docs.columns and mixing.sample(empty).count() == 0
    only_null = docs.where("text is null")
    assert [r["probability"] for r in mixing.op9(only_null).collect()] == [1.0] and mixing.sample(only_null).count() == 1


def test_a_column_called_topic_is_ignored_unless_named(docs):
    from pyspark.sql import functions as F

    more = docs.withColumn("topic", F.lit("mine")).withColumn("tokens", F.lit(1)).withColumn("share", F.lit(2.0))
    plain = Counter(map(tuple, mixing.op9(docs).collect()))
    assert Counter(map(tuple, mixing.op9(more).collect())) == plain and mixing.sample(more).columns == more.columns
    assert {r["topic"] for r in mixing.op9(more, topic=F.col("topic")).collect()} == {"mine"}


def bounded_by_hand(base, bounds, places, targets):
    """The mix nearest to base (in relative entropy) under equality of margins and upper bounds, by Newton steps on the
    factors' logarithms, each axis' factor found exactly by bisection in turn."""
    log = [np.zeros(len(t)) for t in targets]
    masses = lambda: np.minimum(bounds, base * np.exp(sum(x[p] for x, p in zip(log, places))))
    for _ in range(300):
        for axis, (place, target) in enumerate(zip(places, targets)):
            for c in range(len(target)):
                low, high = -30.0, 30.0
                for _ in range(45):
                    log[axis][c] = (low + high) / 2
                    low, high = (log[axis][c], high) if masses()[place == c].sum() < target[c] else (low, log[axis][c])
        if all(np.abs(np.bincount(p, masses(), len(t)) - t).max() < 1e-11 for p, t in zip(places, targets)):
            break
    return masses()


MIX_CELLS = [(s, g, t, 10 + 7 * i + (600 if s == "a" else 0)) for i, (s, g, t) in enumerate((s, g, t) for s in "abc" for g in "xy" for t in "pq")]
MIX_SCHEMA = "source string, lang string, topic string, tokens long"


def test_raking_meets_targets_under_bounds_on_both_paths_and_by_hand(spark):
    cells = spark.createDataFrame(MIX_CELLS, MIX_SCHEMA)
    fraction = 0.45
    near, far = (mixing.calibrate(cells, fraction, mixing.POWERS, local_cells=n).orderBy("source", "lang", "topic").toPandas() for n in (100, 2))
    assert np.allclose(near["share"], far["share"], atol=1e-7) and np.allclose(near["probability"], far["probability"], atol=1e-7) and set(near["strength"]) == set(far["strength"]) == {1.0}
    frame = cells.orderBy("source", "lang", "topic").toPandas()
    base = frame["tokens"].to_numpy(float) / frame["tokens"].sum()
    places, targets = [], []
    for axis in mixing.AXES:
        names, place = np.unique(frame[axis].to_numpy(str), return_inverse=True)
        mass = np.bincount(place, base)
        want = mass ** mixing.POWERS[axis] / (mass ** mixing.POWERS[axis]).sum()
        full = np.zeros(len(mass), bool)
        while True:  # categories that can't supply their share give all they have
            t = np.where(full, mass / fraction, 0.0)
            t = np.where(full, t, want / want[~full].sum() * (1 - t.sum()))
            if not (t > mass / fraction + 1e-15).any():
                break
            full |= t > mass / fraction
        places.append(place)
        targets.append(t)
    assert any(np.isclose(t, np.bincount(p, base) / fraction).any() for p, t in zip(places, targets)), "the fixture has a category that gives all it has"
    expected = near["probability"].to_numpy() * base / fraction
    for place, target in zip(places, targets):
        assert np.abs(np.bincount(place, expected) - target).max() < 1e-6
    assert (near["probability"] > 1 - 1e-9).any() and (near["probability"] <= 1).all()
    assert np.allclose(expected, bounded_by_hand(base, base / fraction, places, targets), atol=1e-5)


def test_targets_that_contradict_each_other_are_approached_and_told(spark, monkeypatch):
    """Source b is all Spanish and wanted whole, Spanish is unwanted: no mix has both margins."""
    monkeypatch.setattr(mixing, "ROUNDS", 6)
    monkeypatch.setattr(mixing, "STEPS", 2)
    cells = spark.createDataFrame([("a", "en", "p", 900), ("b", "es", "p", 100)], MIX_SCHEMA)
    given = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.95, "es": 0.05}}
    found = []
    for n in (100, 1):
        with pytest.warns(RuntimeWarning, match="contradict"):
            found.append(mixing.calibrate(cells, 0.2, mixing.POWERS, given, local_cells=n).orderBy("source").toPandas())
    assert np.allclose(found[0]["probability"], found[1]["probability"], atol=1e-7) and (found[0]["strength"] < 1).all()
    assert (found[0]["probability"] * [900, 100]).sum() == pytest.approx(200)


def test_sampled_shares_come_near_the_targets_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.op9(docs).toPandas()
    assert (got["strength"] == 1).all()
    tokens = got["n_tokens"] * got["probability"]
    assert tokens.sum() == pytest.approx(mixing.FRACTION * got["n_tokens"].sum(), rel=1e-6)
    whole, expected = got.groupby("lang")["n_tokens"].sum() / got["n_tokens"].sum(), tokens.groupby(got["lang"]).sum() / tokens.sum()
    want = mixing.reachable((whole**0.5 / (whole**0.5).sum()).to_numpy(), whole.to_numpy(), mixing.FRACTION)
    assert np.abs(expected.to_numpy() - want).max() < 1e-6


def test_pipeline_matches_a_chain_by_hand(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.columns == docs.columns, name
        kept = {r[0] for r in out.select("doc_id").collect()}
        assert out.count() == len(kept)
        if name == "toxicity":
            assert kept == toxic_stage_by_hand(now, spark.read.parquet(f"{folder}/labels.parquet"))
        if name == "near_dedup":
            rows_ = [tuple(r) for r in now.select("doc_id", "text").collect()]
            assert kept == {i for i, _ in near_dedup_by_hand(rows_)}
        if name == "decontamination":
            found = decontamination.op4(now, spark.read.parquet(f"{folder}/benchmark.parquet"))
            assert kept == {r[0] for r in found.where("not contaminated").collect()}
        if name == "mixing":
            assert kept == {r[0] for r in mixing.op9(now).where("sampled").collect()}
        now = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.run(spark, folder).count() == now.count()


def toxic_stage_by_hand(docs, labels):
    """Ids whose plain counted models, under the fitted curve, score them below one half."""
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    rows_ = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    curve = toxicity.fit(docs, labels.where(f"doc_id in ({','.join(map(str, marks))})")).curve
    found = counted_toxicity([(t or "", marks.get(i)) for i, t in rows_])
    return {i for (i, _), (mean, high) in zip(rows_, found) if curve @ [1, np.clip(20 * mean, -6, 6), np.log1p(40 * high)] < 0}


def test_pipeline_stages_take_odd_rows(docs, empty, spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for df in (docs, empty):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df, "/root/testdata/sf0.001").count()
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == Counter(near_dedup_by_hand(TEXTS))


def near_dedup_by_hand(rows):
    """One (id, text) of each group of texts whose fingerprints are linked."""
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    left, out = set(range(len(rows))), []
    while left:
        group, grow = set(), {left.pop()}
        while grow:
            group |= grow
            grow = {j for j in left if any((prints[i] ^ prints[j]).bit_count() <= 3 for i in grow)}
            left -= grow
        key = lambda j: (rows[j][0] is None, rows[j][0] or -1, spark_key(rows[j][1]))
        out.append(rows[min(group, key=key)][:2])
    return out


def spark_key(text):
    """The order that the stage uses among texts of one id: xxhash64 of the text with seed 42, signed."""
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_unlike_texts_under_one_id_all_stay(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, "a quite short text about cats", "en", "s", 1), (1, "something else entirely, of dogs and boats", "en", "s", 1), (2, "third words that nobody else has here", "en", "s", 1), (None, "fourth of all the unlike texts", "en", "s", 1), (None, "no one has written this sentence before", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())) == Counter(rows)


def test_word_spans_at_slice_edges():
    w = split(pa.array(["", None, "a", " b ", "c d"]), NON_ALNUM, lower=True)
    assert w.first.tolist() == [0, 0, 0, 1, 2, 4] and w.joined()[0] == b"a b c d "
