"""Conversation trie, odd sketches and lexical search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from delaylake.llm import conversation_trie as trie
from delaylake.llm import lexical_search as lex
from delaylake.llm import odd_sketch
from tests.llm.test_llm import DOC_SCHEMA, WORD, corpus, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CONV_SCHEMA = "conv_id long, turn long, role string, text string, depth string, owner long"


@pytest.fixture(scope="module")
def docs(spark):
    texts = corpus()
    rows = [(7 * i % 1000, t, "en", "s", 0, "e", "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], DOC_SCHEMA).repartition(5).cache()


def conversations(seed=5, n=230):
    rng = random.Random(seed)
    rows = []
    first = ("user", "hello")
    for c in rng.sample(range(450), n):
        turns = [first] if rng.random() < 0.6 else []
        while rng.random() < 0.75 and len(turns) < 12:
            turns.append((rng.choice(["user", "bot", None, ""]), rng.choice(["a", "bb", "é", None, "", "long " * 9])))
        for i, (r, t) in enumerate(turns):
            rows.append((c, rng.choice([None, i, i, i, i // 2]), r, t, "x", 1))
    rows += [(900, i, "user", f"t{i}", "x", 1) for i in range(700)]      # one long conversation
    rows += [(901, i, "user", f"t{i}", "x", 1) for i in range(350)]
    rows += [(902, 1, "u", "same", "x", 1)] * 3 + [(None, 1, "u", "lost", "x", 1)]
    rng.shuffle(rows)
    return rows


def brute_trie(rows, openings=True):
    own = defaultdict(list)
    for c, turn, r, t, *_ in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), r or "", t or ""))
    own = {c: [x[1:] for x in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if openings else 0
        built[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        value = (len(m) - 1) * (len(k[-1][1]) if k else 0)
        for d in range(len(k) + 1):
            saved[k[:d]] += value
            leaves[k[:d]] += not kids[k]
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items())


@pytest.mark.parametrize("openings,local_nodes", [(True, 20_000), (True, 60), (False, 150)])
def test_trie_equals_brute_force(spark, openings, local_nodes):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV_SCHEMA).repartition(4)
    got = trie.conversation_trie(df, openings, local_nodes).na.fill(-1, ["parent_conv_id"]).collect()
    assert sorted(map(tuple, got)) == brute_trie(rows, openings)


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(spark.createDataFrame([], CONV_SCHEMA)).collect() == []
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "u", "x", "", 1)], CONV_SCHEMA)).collect() == []
    # turnless after rebuilding: only the root is left
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    got = trie.conversation_trie(spark.createDataFrame([(lone, 1, "u", "x", "", 1)], CONV_SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest"])
def test_local_rollup(shape):
    rng = np.random.default_rng(2)
    n = 400
    parent = {"random": np.array([-1, *(rng.integers(0, i) for i in range(1, n))]),
              "chain": np.arange(n) - 1, "star": np.array([-1] + [0] * (n - 1)),
              "forest": np.array([-1 if i % 50 == 0 else rng.integers(i - i % 50, i) for i in range(n)])}[shape]
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    value = rng.integers(0, 100, n)
    want = value.copy()
    for i in reversed(range(n)):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    mix = rng.permutation(n)
    back = np.argsort(mix)
    moved = np.array([-1 if parent[i] < 0 else back[parent[i]] for i in mix])
    got = trie.local_rollup(depth[mix], moved, [value[mix], np.ones(n, np.int64)])
    assert (got[0][back] == want).all()


def brute_components(rows, percent):
    sets = []
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[p:p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    ids = sorted({i for i, _ in rows})
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                up[y] = x
    return sorted((i, len(s), find(i) if s else i, (find(i) if s else i) == i) for (i, _), s in zip(rows, sets))


def near_copies(seed=9):
    """Groups of copies with a few words changed: some pairs link, many just miss."""
    rng = random.Random(seed)
    out = []
    for _ in range(4):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([40, 120, 300]))]
        for _ in range(14):
            ws = list(base)
            for _ in range(rng.randint(0, max(2, len(ws) // 40))):
                ws[rng.randrange(len(ws))] = f"n{rng.randrange(10 ** 6)}"
            out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("block", [1500, 3])
def test_odd_sketch_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(odd_sketch, "BLOCK", block)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows += [(2000 + i, t) for i, t in enumerate(near_copies())]
    more = spark.createDataFrame([(i, t, "", "", 0, "", "") for i, t in rows], DOC_SCHEMA).repartition(3)
    got = sorted(map(tuple, odd_sketch.near_dedup(more).collect()))
    assert got == brute_components(rows, 85)
    assert sum(not r[3] for r in got) > 20


def test_odd_sketch_edges(spark):
    x, q = "a b c d e f g", "one two three four five six"
    rows = [(1, x), (5, x), (5, q), (9, q), (None, x), (7, None), (8, " "), (3, "One two"), (4, "one TWO")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in odd_sketch.near_dedup(df).collect()}
    assert got == {(1, 3, 1, True), (5, 3, 1, False), (5, 2, 1, False), (9, 2, 1, False), (None, 3, None, True),
                   (7, 0, 7, True), (8, 0, 8, True), (3, 1, 3, True), (4, 1, 3, False)}
    assert odd_sketch.near_dedup(df.limit(0)).collect() == []


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    k, bits = odd_sketch.BANDS * odd_sketch.ROWS, odd_sketch.BITS
    errors = []
    for _ in range(60):
        both, own = rng.integers(0, 2 ** 63, 900, dtype=np.uint64), rng.integers(0, 2 ** 63, 100, dtype=np.uint64)
        a, b = np.sort(both), np.sort(np.concatenate([both[:850], own]))
        value, starts = np.concatenate([a, b]), np.array([0, len(a)])
        s = odd_sketch.odd_sketches(odd_sketch.min_samples(value, starts, k), bits).view(np.uint64)
        z = odd_sketch._counts(s[:1], s[1:])
        errors.append(odd_sketch.similarity(z, k, bits)[0] - 850 / 1000)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03
    assert min(errors) + 0.85 > odd_sketch.floor_of(85, k, bits)


def brute_search(rows, items, k):
    docs = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    terms = defaultdict(set)
    for item, t in items:
        if item is not None:
            terms[item] |= set(TERM.findall(lower(t or "")))
    out = []
    for item, ts in terms.items():
        scored = []
        for i, c, n in docs:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("k,group_bytes,postings", [(50, 16 << 20, 1 << 21), (3, 700, 200), (1, 16 << 20, 50)])
def test_search_equals_brute_force(spark, docs, monkeypatch, k, group_bytes, postings):
    monkeypatch.setattr(lex, "BLOCK_POSTINGS", postings)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + [(None, "the w1 é")]
    rng = random.Random(4)
    words = [w for _, t in rows if t for w in t.split()]
    items = [(i, " ".join(rng.sample(words, 12))) for i in range(15)]
    items += [(3, "W1 w2,the"), (20, None), (21, ""), (None, "the"), (22, "unknownword"), (23, "the"), (24, "É é")]
    table = spark.createDataFrame([(i, t, "", "", 0, "", "") for i, t in rows], DOC_SCHEMA).repartition(3)
    queries = spark.createDataFrame([(i, t, "r") for i, t in items], "item_id long, text string, rank string")
    got = lex.search(table, queries, k, group_bytes=group_bytes).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1])) == brute_search(rows, items, k)


def test_search_ties_and_nothing(spark):
    rows = [(i, "same text here") for i in range(40, 0, -1)] + [(99, "other words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    queries = spark.createDataFrame([("q", "same other")], "item_id string, text string")
    got = [tuple(r) for r in lex.search(table, queries, 5).orderBy("rank").collect()]
    assert [(g[1], g[2]) for g in got] == [(1, 99), (2, 1), (3, 2), (4, 3), (5, 4)]
    assert lex.search(table.limit(0), queries).collect() == []
    assert lex.search(table, queries.limit(0)).collect() == []
    assert len(lex.search(table.where("doc_id > 5"), queries, 100).collect()) == 36


def test_accumulators_stop_being_created():
    """A document with the common term only gets no accumulator once it cannot reach the top."""
    block = lex.Postings(np.array([0, 1, 0, 1, 2, 3]), np.array([900, 800, 10, 20, 30, 40]), np.array([0, 2, 6]))
    live = lex.Accumulators(4)
    rows = live.run([0, 1], np.array([100, 1]), np.array([90000, 40]), block, 2, 0)
    assert rows.tolist() == [0, 1] and live.score.tolist() == [90010, 80020, 0, 0]
    live.clear(rows)
    assert live.run([0, 1], np.array([100, 1]), np.array([90000, 40]), block, 3, 0).tolist() == [0, 1, 2, 3]
