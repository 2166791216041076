"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread.

1. quality: documents that the quality rules reject go.
2. near_duplicates: of each component of the n-gram Jaccard join the document of least
   doc_id stays (repeated rows of one doc_id stay together).
3. repeated_spans: words in spans that start earlier elsewhere go; a text that loses any
   becomes its kept words joined by one space, with n_chars to match; a document that loses
   all its words goes.
4. benchmark: contaminated documents go; texts with a few hits stay as they are.
5. tokens: byte-level BPE ids of every text left, checked by decoding.

All but the last stage return the columns of documents, in order; extra columns, whatever
their names, are passed on. Null texts, null ids and empty tables are handled as each
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.llm.base import bounded_batches, staged, table
from delaylake.llm.bpe import encode
from delaylake.llm.decontaminate import decontaminate
from delaylake.llm.jaccard_join import jaccard_join
from delaylake.llm.quality import fit_quality, quality
from delaylake.llm.queries import tokenizer_path, tokenizer_pattern
from delaylake.llm.substring_dedup import substring_dedup

_OTHERS = "pipeline_row"
#: Rows in an Arrow batch: rows carry their other columns along, and executors that run one
#: stage after the other keep the buffers of the largest batch.
BATCH_ROWS = 250


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns as one struct that operators carry along."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # a struct needs a field, also without other columns; its name is none of theirs
    some = max((c for c in others if not c.strip("_")), key=len, default="") + "_"
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias(some), *[F.col(f"`{c}`") for c in others])
                       .alias(_OTHERS))


def _unpacked(docs: DataFrame, columns: list[str], **changed: F.Column) -> DataFrame:
    """The columns of the input again, in order."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **changed}
    return docs.select(*[own.get(c, F.col(_OTHERS)[c]).alias(c) for c in columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark, BATCH_ROWS)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return _unpacked(quality(_packed(docs), model, carry=(_OTHERS,)).where("kept"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = jaccard_join(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup(_packed(docs), carry=(_OTHERS,)).where("n_removed < n_words or n_words = 0")
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(
            F.col(_OTHERS)["n_chars"])
    return _unpacked(cut, docs.columns, **changed)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate(_packed(docs), table(spark, sf_dir, "benchmark"), carry=(_OTHERS,))
    return _unpacked(judged.where(~F.col("contaminated")), docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, tokenizer_path(), tokenizer_pattern())


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_spans", cut_repeated_spans),
    ("benchmark", drop_contaminated),
    ("tokens", encode_texts),
]

#: No SQL: the line labeller of the first stage and the encoder of the last have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
