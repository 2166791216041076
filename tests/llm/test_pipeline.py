"""The corpus pipeline against the brute-force forms of its stages, and the registration."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F
from tests.llm.test_llm import (WORD, base_counts, components_by_brute_force,
                                contaminated_by_brute_force, removed_by_brute_force)

SF = "/root/testdata/sf0.001"


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture()
def folder(spark, tmp_dir):
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(500)]
    make = lambda n: rng.choices(vocab, k=n)
    base, passage, item = make(120), make(60), make(30)
    texts = [make(80) for _ in range(40)]
    for i in range(5):
        near = list(base)
        near[10 * i] = "edit"
        texts.append(near)
    texts += [make(50) + passage + make(30) for _ in range(4)] + [list(passage)]
    texts += [make(20) + item + make(20), make(500) + item[:14], make(6), make(25) * 4]
    texts += [texts[0], [w + "###" for w in make(60)]]
    rows = [(3 * i, " ".join(ws), "en", "s", -1, i) for i, ws in enumerate(texts)]
    rows += [(900, None, None, None, None, 0), (901, "", "en", "s", 0, 1), rows[1]]
    write(spark, tmp_dir, "documents", rows,
          "doc_id long, text string, lang string, source string, n_chars long, n_words int")
    write(spark, tmp_dir, "labels", [(r[0], int("###" not in (r[1] or "")), 0) for r in rows],
          "doc_id long, quality int, toxic int")
    write(spark, tmp_dir, "benchmark", [(1, " ".join(item))], "item_id long, text string")
    return tmp_dir


def test_pipeline_equals_brute_force(spark, folder):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    junk = {i for i, t in texts.items() if "###" in (t or "")}
    names = [n for n, _ in p.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_spans", "benchmark", "tokens"]

    one = p.STAGES[0][1](spark, docs, folder)
    texts = {i: t for i, t in texts.items() if not base_counts(t)[5] and i not in junk}
    check(one, texts, columns)

    two = p.STAGES[1][1](spark, one, folder)
    texts = {i: t for i, t in texts.items() if components_by_brute_force(texts)[i][1] == i}
    check(two, texts, columns)

    three = p.STAGES[2][1](spark, two, folder)
    gone = removed_by_brute_force(texts)
    texts = {i: " ".join(w for k, w in enumerate(gone[i][0]) if k not in gone[i][1]) if gone[i][1] else t
             for i, t in texts.items() if len(gone[i][1]) < len(gone[i][0]) or not gone[i][0]}
    check(three, texts, columns)
    assert any(g for _, g in gone.values())
    for r in three.collect():
        assert r["n_chars"] in (-1, len(r["text"]))

    four = p.STAGES[3][1](spark, three, folder)
    hits = contaminated_by_brute_force(texts, [(1, spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"])])
    texts = {i: t for i, t in texts.items() if not hits[i][4]}
    check(four, texts, columns)
    assert any(h[4] for h in hits.values()) and any(h[1] and not h[4] for h in hits.values())

    last = p.run(spark, folder).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def check(df, texts, columns):
    assert df.columns == columns
    assert {r["doc_id"]: r["text"] for r in df.collect()} == texts


def test_pipeline_of_empty_tables(spark, tmp_dir):
    import corpus_pipeline as p

    write(spark, tmp_dir, "documents", [], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, tmp_dir, "labels", [], "doc_id long, quality int, toxic int")
    write(spark, tmp_dir, "benchmark", [], "item_id long, text string")
    assert p.run(spark, tmp_dir).count() == 0


def test_stages_carry_columns_of_any_name(spark, folder):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(30)
    odd = docs.select("*", F.lit(1).alias("_"), F.lit("x").alias("pipeline_row"), F.lit(2.5).alias("body"),
                      F.array(F.lit(3)).alias("a.b"), F.lit(None).cast("string").alias("__"))
    for _, stage in p.STAGES[:-1]:
        got = stage(spark, odd, folder)
        assert got.columns == odd.columns
        assert {tuple(r)[-5:] for r in got.select(
            *[F.col(f"`{c}`") for c in got.columns[:-2]], F.col("`a.b`")[0], F.col("__")).collect()} == {(1, "x", 2.5, 3, None)}


def test_queries_are_registered_with_their_columns(spark):
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13
    assert "pipeline" in e.queries()
    assert WORD.findall(" a b ") == ["a", "b"]


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_warc", "op3_jaccard_join", "op8_decontaminate",
                                  "op11_conversation_trie", "op12_odd_sketch", "op13_lexical_search"])
@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got = e.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(f"select {', '.join(cols)} from ({e.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key)
