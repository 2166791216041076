"""Cases that earlier tests left out: one doc_id with several texts, spans beyond the broadcast
bound, metadata that differ late, repeats inside a document."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from delaylake.llm import decontaminate, kd_sharding, substring_dedup
from delaylake.llm import words as W

SCHEMA = "doc_id long, text string"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))


def removed(spark, rows):
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(out) == len(rows)
    return sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in out)


def test_one_doc_id_with_two_texts(spark):
    x, q, z, tail = words(50, 1), words(60, 2), words(40, 3), words(25, 4)
    part = " ".join(q.split()[:30])
    assert removed(spark, [(1, x), (5, x), (5, q), (9, f"{part} {tail}")]) == [
        (1, 50, 0), (5, 50, 50), (5, 60, 0), (9, 55, 30)]
    assert removed(spark, [(5, z), (5, q), (8, f"a {z}"), (9, f"{q} {tail}")]) == [
        (5, 40, 0), (5, 60, 0), (8, 41, 40), (9, 85, 60)]


def test_texts_of_one_doc_id_are_ordered_by_their_hash(spark):
    q = words(60, 2)
    df = spark.createDataFrame([(5, q), (5, q), (5, f"{q} b")], SCHEMA)
    order = [r["text"] for r in df.distinct().orderBy(F.xxhash64("text")).collect()]
    got = {(r["kept_text"] or "", r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect()}
    first = order[0]
    assert (first, 0) in got
    assert {n for t, n in got if t != first} == {60}


def test_repeats_inside_are_compared_word_by_word(monkeypatch):
    a = words(24, 5).split()
    text = " ".join(a + ["x"] + a[2:] + ["y"] + words(30, 6).split())
    w = W.split_words(*W.text_bytes(pa.array([text])))
    h = W.word_hashes(w)
    win = W.window_hashes(h, 20)
    at = np.flatnonzero(W.window_mask(w.first, 20, len(win)))
    row = np.zeros(len(h), np.int64)
    assert substring_dedup._repeats_inside(w, at, row, win, 20).tolist() == [25, 26, 27]
    win[50] = win[3]                        # a hash that collides is no repeat
    win[28] = win[5]
    assert substring_dedup._repeats_inside(w, at, row, win, 20).tolist() == [25, 26, 27]


@pytest.mark.parametrize("bound", [0, 2_000_000])
def test_spans_are_removed_on_both_sides_of_the_bound(spark, bound):
    item, short = words(30, 7), "only three words"
    docs = spark.createDataFrame(
        [(1, f"before, {item.upper()}! after"), (2, f"x {short}. y {short}"), (3, " ".join(item.split()[:12])), (4, None),
         (5, ""), (6, f"é {' '.join(item.split()[4:20])} ü"), (6, f"é {' '.join(item.split()[4:20])} ü")], SCHEMA)
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (None, words(20, 8))], "item_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in decontaminate.remove_spans(docs, bench, 13, bound).collect()), key=str)
    assert got == sorted([(1, "before, ! after"), (2, "x . y "), (3, " ".join(item.split()[:12])), (4, None), (5, ""),
                          (6, "é  ü"), (6, "é  ü")], key=str)
    both = [sorted((tuple(r) for r in decontaminate.decontaminate(docs, bench, 13, max_broadcast_windows=b).collect()), key=str)
            for b in (bound, 2_000_000)]
    assert both[0] == both[1]


def test_sources_with_a_long_common_prefix_are_split(spark):
    rows = [(i, words(20, i), "en", f"common_crawl_{'ab'[i % 2]}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    points, tree = kd_sharding.place(kd_sharding._points(docs, ("source",)), 2, ("source",))
    sides = {r["doc_id"]: r["node"] for r in points.collect()}
    assert len({sides[i] for i in range(0, 100, 2)}) == 1 and len({sides[i] for i in range(1, 100, 2)}) == 1
    assert sides[0] != sides[1]
    ranks = {r["value"]: r["rank"] for r in kd_sharding._ranks(docs.withColumn("v", F.concat("source", F.col("doc_id").cast("string"))), "v").collect()}
    assert [ranks[k] for k in sorted(ranks, key=lambda v: v.encode())] == list(range(100))


def test_text_doc_ids_and_null_metadata(spark):
    rows = [(f"prefix-{i:04d}" if i % 9 else None, words(15, i), None, "s") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    got = kd_sharding.kd_sharding(docs, 4).collect()
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert len(got) == 90 and max(sizes) - min(sizes) < 0.1 * sum(sizes)


def grams_by_hand(host, path):
    out = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in (3, 4, 5):
            out |= {mark + text[i:i + n] for i in range(max(1, len(text) - n + 1))}
    return out


def test_url_features_and_scores_by_hand(spark):
    import math

    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    from delaylake.llm import url_filter
    rng = random.Random(1)
    urls = [f"http://{rng.choice(['a', 'shop', 'ä'])}{i}.{rng.choice(['net', 'example.net', 'org', 'io'])}/"
            f"{rng.choice(['en/', 'fr/', '', 'de/x?q'])}{'z' * (i % 4)}" for i in range(120)] + ["", None, "http://", "no scheme"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = url_filter.with_rules(pages)
    model = url_filter.fit_urls(judged)
    rows = model.transform(url_filter.features(judged)).select(
        "host", "path", "grams", vector_to_array("probability")[1].alias("p")).collect()
    tf = HashingTF(numFeatures=url_filter.N_FEATURES, binary=True, inputCol="grams", outputCol="features")
    weights, offset = model.coefficients.toArray(), model.intercept
    where = {}
    for r in rows:
        want = grams_by_hand(r["host"], r["path"])
        assert set(r["grams"]) == want and len(r["grams"]) == len(want)
        at = {where.setdefault(g, tf.indexOf(g)) for g in want}
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-(offset + sum(weights[i] for i in at)))), abs=1e-12)
    got = {r["page_id"]: r for r in url_filter.url_filter(pages).collect()}
    assert all(got[i]["verdict"] == ("block" if r["p"] >= 0.5 else "allow")
               for i, r in enumerate(rows) if got[i]["rule"] is None)


def test_a_long_url_takes_time_in_proportion(spark):
    import time

    from delaylake.llm import url_filter
    took = []
    for n in (20_000, 200_000):
        df = spark.createDataFrame([("h", "/" + "".join(random.Random(n).choices("abcdef", k=n)))], "host string, path string")
        t = time.perf_counter()
        assert url_filter.features(df).select(F.size("grams").alias("n")).first()["n"] > 8000
        took.append(time.perf_counter() - t)
    assert took[1] < 10 * max(took[0], 2)
