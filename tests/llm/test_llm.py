"""Operators of the training-data pipeline against brute force on small tables, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from delaylake.llm import bpe, crf, decontaminate, jaccard_join, kd_sharding, langid, quality
from delaylake.llm import substring_dedup, toxicity, url_filter, warc
from delaylake.llm import words as W
from delaylake.llm.base import labelled_sample, packed
from delaylake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, edge string, n_words string"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def corpus(seed=3):
    """Texts with copies, near copies, shared passages, nulls, blanks and one long text."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["é", "ü|", "##", "Zwölf", "x,", "the", "The"]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, base = make(45), make(90)
    texts = [None, "", " \n\t ", "one", "One", "one two three", "a b c d e", "x" * 70_000 + " y z"]
    for _ in range(25):
        ws = make(rng.randint(5, 120))
        if rng.random() < 0.5:
            at = rng.randint(0, len(ws))
            ws[at:at] = passage[:rng.randint(10, 45)]
        if rng.random() < 0.2:
            ws = ws + ws[-30:]
        texts.append(rng.choice([" ", "\n", "  "]).join(ws))
    for _ in range(12):
        ws = list(base)
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(len(ws))] = rng.choice(vocab)
        texts.append(" ".join(ws))
    long = make(70)
    texts += [" ".join(make(30) + long + make(10)), " ".join(make(3) + long)]
    texts += [texts[10], texts[10], texts[12], " ".join(make(4000)), " ".join(base * 3)]
    rng.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    """The corpus with clashing extra columns; the last row is repeated."""
    texts = corpus()
    rows = [(7 * i % 1000, t, ["en", "de", None][i % 3], f"src{i % 4}", 0 if t is None else len(t), "e", "n")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], DOC_SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def texts_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# --- words -------------------------------------------------------------------------------

def test_words_and_hashes_follow_the_bytes():
    texts = ["", None, "a b  c\n", "x" * 70_000 + " y", "é à\x0bü", "a b c a b c", "x" * 70_000]
    data, off = W.text_bytes(pa.array(texts).slice(1))
    w = W.split_words(data, off)
    h, known = W.word_hashes(w), {}
    for i, t in enumerate(texts[1:]):
        ws = [x.encode() for x in WORD.findall(t or "")]
        a, b = w.first[i], w.first[i + 1]
        assert [w.text(j, j + 1) for j in range(a, b)] == ws
        for x, v in zip(ws, h[a:b]):
            assert known.setdefault(x, v) == v
    assert len(set(known.values())) == len(known)
    win, seen = W.window_hashes(h, 2), {}
    for p in np.flatnonzero(W.window_mask(w.first, 2, len(win))):
        assert seen.setdefault(w.text(p, p + 2), win[p]) == win[p]
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_every_row_once():
    batch = pa.record_batch([pa.array(["ab" * k for k in range(50)]), pa.array(range(50))], ["text", "i"])
    parts = list(W.slices(iter([batch]), "text", 100))
    assert sum((p.column("i").to_pylist() for p in parts), []) == list(range(50)) and len(parts) > 10


# --- 1 substring dedup -------------------------------------------------------------------

def removed_by_brute_force(texts, k=20):
    """doc_id -> (words, removed positions)."""
    first = {}
    split = {i: WORD.findall(t or "") for i, t in texts.items()}
    for i in sorted(split):
        for p in range(len(split[i]) - k + 1):
            first.setdefault(tuple(split[i][p:p + k]), (i, p))
    return {i: (ws, {q for p in range(len(ws) - k + 1) if first[tuple(ws[p:p + k])] != (i, p)
                     for q in range(p, p + k)}) for i, ws in split.items()}


def test_substring_dedup_equals_brute_force(docs):
    texts = texts_of(docs)
    want = removed_by_brute_force(texts)
    got = substring_dedup.substring_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        ws, gone = want[r["doc_id"]]
        kept = [w for i, w in enumerate(ws) if i not in gone]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(ws), len(gone), sha(" ".join(kept)))
        t = texts[r["doc_id"]]
        assert r["kept_text"] == (" ".join(kept) if gone else t)
    assert sum(r["n_removed"] for r in got) > 300


def test_substring_dedup_paths_are_compact_and_verified(docs):
    whole = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    spans = substring_dedup.repeated_spans(packed(whole), substring_dedup.copies(whole)).collect()
    texts = texts_of(docs)
    assert any(s["n"] > 20 for s in spans)
    for s in spans:
        a = WORD.findall(texts[s["doc_id"]])[s["pos"]:s["pos"] + s["n"] + 19]
        b = WORD.findall(texts[s["source_id"]])[s["source_pos"]:s["source_pos"] + s["n"] + 19]
        assert a == b and s["source_id"] < s["doc_id"]


def test_substring_dedup_of_rows_without_id_and_empty_table(spark, empty):
    t = " ".join(f"a{i}" for i in range(25))
    df = spark.createDataFrame([(None, t), (1, t), (2, t), (None, None), (3, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"])
                 for r in substring_dedup.substring_dedup(df).collect())
    assert got == [("1", 25, 0), ("2", 25, 25), ("3", 0, 0), ("None", 0, 0), ("None", 25, 0)]
    assert substring_dedup.substring_dedup(empty).count() == 0


# --- 2 WARC ------------------------------------------------------------------------------

def pages_table(spark):
    body = "<p>" + "é" * 700
    rows = [(1, "http://a/1", body, "x"), (5, "http://a/2", body, "x"), (3, "http://a/ü\r\n", body, "x"),
            (2, None, "short", "x"), (4, "u", "short", "x"), (6, "http://e", None, "x"), (7, "http://e", "", "x"),
            (9, "http://long", "z" * 300_000, "x"), (9, "http://long", "z" * 300_000, "x"),
            (8, "http://b", "\r\n\r\nWARC/1.1\r\n" * 200, "x"), (None, "http://n", body, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string")


def test_warc_round_trip(spark):
    pages = pages_table(spark)
    got = sorted((r["page_id"] is None, r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                  r["refers_to"]) for r in warc.round_trip(pages).collect())
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = []
    for page, raw in rows:
        top = max((p for p, x in rows if x == raw and p is not None), default=None)
        again = len(raw) >= 1000 and page is not None and page < top
        want.append((page is None, page, len(raw), hashlib.sha1(raw).hexdigest(),
                     "revisit" if again else "response", top if again else None))
    assert got == sorted(want)


def test_warc_reader_frames_members_and_rejects_damage(spark, tmp_dir):
    raw = [warc.record(i, f"http://x/{i}", bytes(random.Random(i).choices(b"ab\r\n", k=n)))
           for i, n in enumerate([0, 10, 70_000, 200_000])]
    data = b"".join(map(warc.member, raw))
    got = list(warc.read_records(io.BytesIO(data), True))
    assert [len(r.payload) for r in got] == [0, 10, 70_000, 200_000]
    assert len(re.findall(rb"\x1f\x8b\x08\x00\x00\x00\x00\x00", data)) == 4
    assert zlib.decompress(data, 31).startswith(b"WARC/1.1")
    bad = [data[:-20], warc.member(raw[1].replace(b"Content-Length: ", b"Content-Length: 1")),
           warc.member(raw[1][:-12] + b"zzzzzzzz\r\n\r\n"), warc.member(b"junk\r\n\r\n")]
    for x in bad:
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(x)))
    urls = warc.read_warc(warc.write_warc(pages_table(spark), tmp_dir + "/w"), True)
    got = {r["page_id"]: r for r in urls.collect()}
    assert got[3]["url"] == "http://a/%C3%BC%0D%0A" and got[2]["url"] is None and got[5]["payload"][:3] == b"<p>"


def test_warc_of_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).count() == 0


# --- 3 n-gram Jaccard join ---------------------------------------------------------------

def shingles(t):
    ws = WORD.findall(lower(t or ""))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} - {()}


def components_by_brute_force(texts, percent=75):
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_join_equals_brute_force(docs):
    want = components_by_brute_force(texts_of(docs))
    got = jaccard_join.jaccard_join(docs).collect()
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert max(Counter(c for _, c in want.values()).values()) >= 6


def test_jaccard_join_chains_and_thresholds(spark, empty):
    """Chains of near copies and pairs at the threshold, many words shared by all."""
    rng = random.Random(9)
    boiler = [f"b{i}" for i in range(12)]
    texts, ws = {}, [f"c{i}" for i in range(60)]
    for i in range(40):
        ws = list(ws)
        if i % 2:
            ws[rng.randrange(60)] = f"n{i}"
        texts[1000 - 3 * i] = " ".join(ws)
    for i in range(60):
        own = [f"o{i}_{j}" for j in range(rng.randint(2, 14))]
        texts[2000 + i] = " ".join(boiler + own)
    for i in range(30):
        n, m = 20 + i, (20 + i) // 7
        texts[3000 + 2 * i] = " ".join(f"t{i}_{j}" for j in range(n))
        texts[3001 + 2 * i] = " ".join(f"t{i}_{j}" for j in range(m, n + rng.randint(0, 2)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(df).collect()}
    assert got == components_by_brute_force(texts)
    assert jaccard_join.jaccard_join(empty).count() == 0
    none = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r[0], r[1], r[2]) for r in jaccard_join.jaccard_join(none).select(
        "n_shingles", "doc_id", "component_id").collect()) == [(0, None, None), (1, None, None)]


def test_components_of_stars_and_chains(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (9, 8), (8, 9)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(200, 260))
    assert got[9] == 8 and 5 not in got


# --- 4 byte-level BPE --------------------------------------------------------------------

def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def test_bpe_equals_tiktoken(docs, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = tokenizer()
    ranks = bpe.load_ranks(path)
    ref = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    enc, rng = bpe.Encoder(ranks, pattern), random.Random(5)
    for _ in range(300):
        s = "".join(rng.choices("abcdeé .\n'stll12 中😀\x1c\x85\u180e\u200b\u2028\xa0<|endoftext|>", k=rng.randint(0, 80)))
        assert enc.encode(s)[0] == ref.encode_ordinary(s)
        assert enc.decode(enc.encode(s)[0]) == s.encode()
    for piece in ("ab" * 5000, "x" * 300, "aaaaaaaaaaaaaaaab", "\u4e2d" * 33):
        assert bpe.merge_bytes(piece.encode(), ranks) == ref.encode_ordinary(piece)
    texts = texts_of(docs)
    for r in bpe.encode(docs, path, pattern).collect():
        ids = ref.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, ids))) and r["decoded_sha256"] == sha(texts[r["doc_id"]] or "")
    back = bpe.decode(bpe.encode(docs, path, pattern), path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in texts.items()}
    assert bpe.encode(empty, path, pattern).count() == 0


def test_bpe_table_overflow_changes_nothing(monkeypatch):
    path, pattern = tokenizer()
    ranks = bpe.load_ranks(path)
    texts = [" ".join(f"zq{i}x{j}" for j in range(40)) for i in range(20)]
    whole = [ids for t in texts for ids, _ in bpe.Encoder(ranks, pattern).encode_all([t])]
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 50)
    small = bpe.Encoder(ranks, pattern)
    assert [ids for t in texts for ids, _ in small.encode_all([t])] == whole


# --- 5 quality ---------------------------------------------------------------------------

def base_counts(t):
    t = t or ""
    ws = WORD.findall(t)
    lines, seen, dup = t.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    again = {q for i in range(len(ws) - 7) if wins[tuple(ws[i:i + 8])] > 1 for q in range(i, i + 8)}
    failed = len(ws) < 20 or 100 * len(again) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again), failed


def test_quality_base_counts_equal_brute_force(docs, empty):
    texts = texts_of(docs)
    got = quality.quality(docs, None).collect()
    assert len(got) == docs.count()
    for r in got:
        want = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == want
        assert r["kept"] == (not want[5])
    assert quality.quality(empty, None).count() == 0


def test_quality_model_tells_content_from_boilerplate(spark):
    rng = random.Random(4)
    prose = lambda: "\n".join(" ".join("".join(rng.choices("abdeinrst", k=rng.randint(2, 8)))
                                       for _ in range(15)) + "." for _ in range(6))
    junk = lambda: "\n".join(" | ".join("".join(rng.choices("abdeinrst", k=3)) + "###" for _ in range(12))
                             for _ in range(6))
    rows = [(i, junk() if i % 4 == 0 else prose()) for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(80)], "doc_id long, quality int")
    model = quality.fit_quality(df, labels)
    got = by_id(quality.quality(df, model))
    assert all(got[i]["kept"] == (i % 4 != 0) for i, _ in rows)
    assert got[0]["boilerplate_lines"] == list(range(6))
    assert quality.fit_quality(df, labels.where("quality = 1")) is None


def test_labelled_sample_passes_over_long_texts(spark):
    rows = [(i, "x" * 5000 if i % 2 else "y" * 100 + str(i)) for i in range(40)] + [(50, None), (51, "z" * 900)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(50, 1), (99, 1)], "doc_id long, q int")
    got = labelled_sample(df, labels, "q", 100, 4000)
    for v in (0, 1):
        texts = [r["text"] for r in got if r["label"] == v]
        assert len([t for t in texts if t[0] == "y"]) == 10  # all the short ones, whole
        assert all(len(t) <= 250 for t in texts) and sum(map(len, texts)) <= 4000
    only = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, q int")
    assert sorted(r["label"] for r in labelled_sample(df, only, "q", 100, 400)) == [0, 1]
    with pytest.warns(UserWarning, match="q = 1"):
        assert labelled_sample(df, spark.createDataFrame([(50, 1), (0, 0)], "doc_id long, q int"), "q", 9, 4000)


def test_crf_messages_and_viterbi_equal_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 0, 1, 4, 9, 9, 14])
    u, pairs = rng.normal(size=14), rng.normal(size=(2, 2))
    p, best = crf.marginals(u, first, pairs), crf.viterbi(u, first, pairs)
    for a, b in zip(first[:-1], first[1:]):
        n = b - a
        if not n:
            continue
        paths = [[(x >> i) & 1 for i in range(n)] for x in range(1 << n)]
        score = [sum(u[a + i] * y[i] for i in range(n)) + sum(pairs[y[i - 1], y[i]] for i in range(1, n))
                 for y in paths]
        w = np.exp(score) / np.exp(score).sum()
        assert np.allclose(p[a:b], w @ np.array(paths))
        assert best[a:b].tolist() == [bool(v) for v in paths[int(np.argmax(score))]]


def test_crf_fit_learns_features_and_transitions():
    rng = np.random.default_rng(2)
    y = np.repeat(rng.random(60) < 0.5, 20)
    slots = np.stack([np.where(rng.random(1200) < 0.8, y, ~y).astype(int), np.full(1200, 2)], axis=1)
    first = np.arange(0, 1201, 40)
    chain = crf.fit(slots, y, first, 3)
    assert (crf.viterbi(chain.emissions(slots), first, chain.pairs) == y).mean() > 0.9
    assert chain.pairs[0, 0] + chain.pairs[1, 1] > chain.pairs[0, 1] + chain.pairs[1, 0]


# --- 6 sharding --------------------------------------------------------------------------

def test_kd_sharding_places_every_row_near_equal(spark, empty):
    rng = random.Random(6)
    rows = [(i, None if i == 5 else "é" * rng.randint(0, 300), rng.choice(["en", "de", None]),
             "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}") for i in range(3000)]
    rows += [(10_000 + i, "copy " * 40, "en", "hot") for i in range(1500)] + [(None, "x", "en", "s1")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_sharding.kd_sharding(df, 8).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.03 * min(sizes.values())
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    raw = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(raw[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(raw[r["doc_id"]])
               and r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    assert kd_sharding.kd_sharding(empty, 8).count() == 0


def test_kd_sharding_of_few_and_equal_rows(spark):
    df = spark.createDataFrame([(1, "a", "en", "s")] * 5, "doc_id long, text string, lang string, source string")
    got = kd_sharding.kd_sharding(df, 4).collect()
    assert len({r["shard"] for r in got}) == 1 and sorted(r["slot"] for r in got) == [0, 1, 2, 3, 4]


# --- 7 language --------------------------------------------------------------------------

def phrases_by_brute_force(sample, text):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_cross_parsing_equals_brute_force():
    rng = random.Random(8)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(1, 6)))
    texts = {"x": [" ".join(word("abcé") for _ in range(200))], "y": [" ".join(word("abd") for _ in range(200))]}
    parser = langid.Parser(texts)
    rows = ["", "abc abd", "zzz!", " ".join(word("abcdéß") for _ in range(60))]
    data, off = W.text_bytes(pa.array(rows))
    s, bounds = parser.symbols(data, off)
    got = parser.phrases(s, bounds)
    for k, lang in enumerate(parser.langs):
        raw = np.frombuffer(texts[lang][0].encode(), np.uint8)
        sample = bytes(parser.symbols(raw, np.array([0, len(raw)]))[0].tolist())
        for i in range(len(rows)):
            assert got[k, i] == phrases_by_brute_force(sample, bytes(s[bounds[i]:bounds[i + 1]].tolist()))


def test_language_of_held_out_texts(spark, empty):
    rng = random.Random(7)
    syllables = {"aa": ["ka", "lo", "mi", "zu"], "bb": ["str", "eng", "ich", "ö"], "cc": ["tion", "que", "é", "r"]}
    text = lambda lang: " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(40))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(900, None, "aa"), (901, "12 !?", "bb"), (902, text("aa"), None), (903, "ж", None), (None, "ka", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = langid.training_texts(df, F.col("doc_id") < 60)
    got = [r.asDict() for r in langid.identify(df, texts).collect()]
    named = {r["doc_id"]: r for r in got}
    assert all(named[i]["lang_pred"] == lang and 0 <= named[i]["score"] <= 1 for i, _, lang in rows[60:120])
    assert named[900]["lang_pred"] == named[901]["lang_pred"] == "und" and named[902]["lang_pred"] == "aa"
    assert named[903]["lang_pred"] != "und" and len(got) == len(rows)
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}
    assert langid.training_texts(empty, F.lit(True)) == {} and langid.identify(empty, texts).count() == 0


def test_language_of_long_texts_only_is_learnt(spark):
    rows = [(i, "kalo mizu " * 20, "aa") for i in range(5)] + [(10 + i, "streng ichö " * 900, "bb") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = langid.training_texts(df, F.lit(True), max_bytes=4000)
    assert sorted(texts) == ["aa", "bb"] and all(sum(len(t.encode()) for t in v) <= 4000 for v in texts.values())
    assert {(r["doc_id"] < 10, r["lang_pred"]) for r in langid.identify(df, texts).collect()} == {
        (True, "aa"), (False, "bb")}


def test_all_languages_are_learnt_in_groups(spark):
    rng = random.Random(5)
    syllables = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(210)]
    rows = [(10 * k + i, "".join(rng.choices(syllables[3 * k:3 * k + 3], k=40)), f"l{k:02d}")
            for k in range(70) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = langid.training_texts(df, F.col("doc_id") % 10 < 3)
    assert len(texts) == 70
    got = {g: [tuple(r) for r in langid.identify(df, texts, g).orderBy("doc_id").collect()] for g in (16, 100)}
    assert got[16] == got[100]
    assert [r[1] for r in got[16]] == [lang for _, _, lang in rows]


# --- 8 decontamination -------------------------------------------------------------------

def contaminated_by_brute_force(docs, items, n=13):
    wins = {}
    for item, t in items:
        ws = ALNUM.findall(lower(t or ""))
        if item is not None and ws:
            m = min(n, len(ws))
            for p in range(len(ws) - m + 1):
                wins.setdefault(tuple(ws[p:p + m]), set()).add(str(item))
    out = {}
    for i, t in docs.items():
        ws = ALNUM.findall(lower(t or ""))
        hit, found = set(), set()
        for m in {len(k) for k in wins}:
            for p in range(len(ws) - m + 1):
                if (k := tuple(ws[p:p + m])) in wins:
                    hit |= set(range(p, p + m))
                    found |= wins[k]
        out[i] = (len(ws), len(hit), len(found), sha(",".join(sorted(found))),
                  len(hit) > 0 and 20 * len(hit) >= len(ws))
    return out


def test_decontaminate_equals_brute_force_both_ways(spark, docs, empty):
    texts = texts_of(docs)
    long = max((t for t in texts.values() if t), key=lambda t: len(WORD.findall(t)))
    some = [WORD.findall(t) for t in texts.values() if t and len(WORD.findall(t)) > 40]
    items = [(i, "!".join(ws[5:25])) for i, ws in enumerate(some[:6])]
    items += [(10, "One, TWO three"), (11, ""), (12, None), (None, "one"), (13, "absent words here"),
              (14, " ".join(WORD.findall(long)[100:140])), (15, "".join(["x"] * 70_000) + " y")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contaminated_by_brute_force(texts, items)
    for bound in (1_000_000, 3):
        got = decontaminate.decontaminate(docs, bench, max_broadcast_windows=bound).collect()
        assert len(got) == docs.count()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                for r in got} == want
    assert sum(w[4] for w in want.values()) >= 5
    none = bench.where("item_id = 11")
    assert decontaminate.decontaminate(docs, none).where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_remove_spans_cuts_only_hit_words(spark):
    df = spark.createDataFrame([(1, "ä start. One, two THREE end ü"), (2, "clean"), (3, None)],
                               "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(df, bench).collect()}
    assert got == {1: "ä start.  end ü", 2: "clean", 3: None}


# --- 9 URL filter ------------------------------------------------------------------------

def test_url_rules_and_parts(spark):
    urls = [(1, "http://A.Example.NET/en/x?q#f"), (2, "https://foo.net/"), (3, "https://foo.net"),
            (4, "http://example.com/de/1"), (5, "http://notexample.com/de/1"), (6, "x://b.org/fr/?z"),
            (7, None), (8, "no scheme"), (9, "http://net/en/"), (10, "http://é.net/a://b"), (11, "http://x.org/FR/#")]
    got = {r["page_id"]: r for r in url_filter.with_rules(
        spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("a.example.net", "/en/x", "example.net/en/")
    assert got[2]["rule"] == "net/" and got[3]["rule"] is None and got[3]["path"] == ""
    assert got[4]["rule"] == "example.com/de/" and got[5]["rule"] is None and got[6]["rule"] == "org/fr/"
    assert (got[7]["host"], got[7]["path"]) == (got[8]["host"], got[8]["path"]) == ("", "")
    assert got[9]["rule"] == "net/" and (got[10]["host"], got[10]["path"]) == ("é.net", "/a://b")
    assert got[11]["rule"] is None and got[11]["path"] == "/FR/"


def test_url_regression_generalises_and_rules_win(spark):
    rng = random.Random(3)
    name = lambda: "".join(rng.choices("aeiou", k=6))
    rows = [(i, f"http://{name()}.{['net', 'org'][i % 2]}/{['xx', 'fr'][i % 2]}/{i}", "h") for i in range(120)]
    rows += [(500 + i, f"http://{name()}.{'net.au' if i % 2 else 'org.au'}/{'xx' if i % 2 else 'fr'}/{i}", "h")
             for i in range(40)] + [(900, None, "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = by_page(url_filter.url_filter(df))
    assert all(got[i]["verdict"] == ("block" if i % 2 == 0 else "allow") for i in range(120))
    right = [got[500 + i]["verdict"] == ("block" if i % 2 else "allow") for i in range(40)]
    assert sum(right) >= 36 and got[500]["rule"] is None and got[900]["verdict"] in ("allow", "block")
    only = by_page(url_filter.url_filter(df.where("page_id % 2 = 0 and page_id < 120 or page_id = 900")))
    assert only[900]["verdict"] == "block"
    assert by_page(url_filter.url_filter(df.where("page_id = 900")))[900]["verdict"] == "allow"
    assert url_filter.url_filter(df.limit(0)).count() == 0


def by_page(df):
    return {r["page_id"]: r.asDict() for r in df.collect()}


# --- 10 toxicity -------------------------------------------------------------------------

def test_toxicity_scores_and_offsets_on_held_out_texts(spark, empty):
    rng = random.Random(2)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(300)]
    bad = ["slurone", "slurtwo", "vilexy", "vileabc"]

    def text(toxic):
        ws = rng.choices(vocab, k=60)
        for _ in range(4 * toxic):
            ws[rng.randrange(60)] = rng.choice(bad)
        return "\n".join(" ".join(ws[i:i + 12]) for i in range(0, 60, 12))

    rows = [(i, text(i % 3 == 0), "s") for i in range(400)] + [(900, None, "s"), (901, "", "s"), (902, "Ü " * 3000 + "SLURONE!", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(900, 1), (None, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, labels, F.col("doc_id") < 240)
    got = by_id(toxicity.toxicity(df, model))
    held = [i for i in range(240, 400)]
    assert sum((got[i]["score"] >= 0.3) == (i % 3 == 0) for i in held) >= 0.95 * len(held)
    texts = texts_of(df)
    found = [texts[i].encode()[s["begin"]:s["end"]].decode() for i in held for s in got[i]["spans"]]
    assert len(found) > 50 and all(any(b in f for b in bad) for f in found)
    assert got[902]["spans"] and got[902]["spans"][-1]["begin"] == 9000
    assert got[900]["score"] == got[901]["score"] < 0.3 and got[900]["spans"] == []
    assert toxicity.fit_toxicity(df, labels.where("toxic = 0")) is None
    assert {r["score"] for r in toxicity.toxicity(df, None).collect()} == {0.0}
    assert toxicity.toxicity(empty, model).count() == 0


def test_toxicity_learns_the_wording_of_a_small_language(spark):
    """Few places, some of them in clean texts, beside a large language with plain markers."""
    rng = random.Random(12)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(3, 9)))
    large, small = [word("abcdefgh") for _ in range(300)], [word("mnopqrst") for _ in range(300)]

    def text(vocab, marks):
        ws = rng.choices(vocab, k=60)
        for at, m in zip(rng.sample(range(60), len(marks)), marks):
            ws[at] = m
        return "\n".join(" ".join(ws[i:i + 12]) for i in range(0, 60, 12))

    stem = lambda n: ["vorsch" + word("mnopqrst") for _ in range(n)]
    rows = [(i, text(large, ["slurone", "vilexy"] * (i % 5 == 0)), int(i % 5 == 0)) for i in range(300)]
    rows += [(400 + i, text(small, stem(4)), 1) for i in range(4)]
    rows += [(500 + i, text(small, stem(int(i < 4))), 0) for i in range(20)]
    rows += [(600 + i, text(small, stem(4)), 1) for i in range(10)]
    rows += [(700 + i, text(small, []), 0) for i in range(10)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, labels, F.col("doc_id") < 600)
    got = by_id(toxicity.toxicity(df, model))
    assert sum(got[600 + i]["score"] >= 0.3 for i in range(10)) >= 9
    assert sum(got[700 + i]["score"] >= 0.3 for i in range(10)) <= 1
    assert {s["begin"] for s in got[600]["spans"]}


def test_toxicity_marks_count_equal_texts_once(spark):
    """Copies of one toxic text are no evidence of their own."""
    texts = [(i, f"copied insult{i % 3} words stand here", 1) for i in range(60)]
    rows = [(i, "copied mystery words stand here again", 1) for i in range(100)]
    rows += [(200 + i, f"plain text number w{i} of many others here", 0) for i in range(60)]
    rows = rows + [(400 + i, t, y) for i, t, y in texts]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    known = toxicity._known_texts(df, labels, None)
    assert known.count() == 64
    t = toxicity.Tokens(pa.array(["mystery"], pa.large_string()))
    marks = toxicity.find_marks(known)
    assert not np.isin(t.hashes, marks[0]).any()


def test_digest_base32_is_the_archives_convention():
    raw = warc.record(1, "http://a", b"abc")
    want = base64.b32encode(hashlib.sha1(b"abc").digest())
    assert b"WARC-Payload-Digest: sha1:" + want in raw
