"""Shared Spark plumbing of the operators."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaylake.llm import words as W
from delaylake.session import delete_path, ensure_checkpoint_dir, scratch_path

BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows, so that a batch of long texts fits; a session that
    has set fewer keeps them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    spark.conf.set(key, str(rows if now <= 0 else min(rows, now)))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of a query when it ends, not when the driver's heap happens
    to be collected. For queries that are run once, as the writes below are."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once under the shared checkpoint folder and reads it back: cuts the
    lineage, survives lost executors."""
    return _written(df, scratch_path(df.sparkSession, name))


class Scratch:
    """Tables that an operator writes under the shared checkpoint folder, each deleted when its
    last reader is done. A written table cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, list[str]] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.setdefault(name, []).append(path)
        return _written(df, path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                delete_path(self.spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the non-null ``text`` as ``body``, compressed (zstd), so that an exchange
    of whole texts moves and stores about two thirds of what it would otherwise. Joins exchange
    it in any case (a broadcast of the other side would chain two Python workers in a task)."""
    rest = [c for c in docs.columns if c != "text"]
    plain = docs.select(*rest, "text")

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            body = [press.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(body, pa.binary())], [*rest, "body"])

    return plain.mapInArrow(run, schema_ddl(plain.drop("text"), "body binary")).hint("merge")


def unpacked(batches: Iterator[pa.RecordBatch], max_bytes: int = W.SLICE_BYTES,
             columns: tuple[str, ...] = ("body",)) -> Iterator[pa.RecordBatch]:
    """Batches with ``packed`` columns cut to at most ``max_bytes`` of text (one row at
    least), the texts in place of the columns: ``body`` becomes ``text``, ``body_x`` ``text_x``."""
    press = zstandard.ZstdDecompressor()

    def cut(batch, a, texts):
        names = [c for c in batch.schema.names if c not in columns]
        part = batch.slice(a, len(texts))
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names),
             *(pa.array(t, pa.binary()).cast(pa.string()) for t in zip(*texts))],
            [*names, *(c.replace("body", "text", 1) for c in columns)])

    for batch in batches:
        a, size, texts = 0, 0, []
        for i, bodies in enumerate(zip(*(batch.column(c) for c in columns))):
            row = [press.decompress(b.as_py()) for b in bodies]
            if texts and size + sum(map(len, row)) > max_bytes:
                yield cut(batch, a, texts)
                a, size, texts = i, 0, []
            texts.append(row)
            size += sum(map(len, row))
        if texts:
            yield cut(batch, a, texts)
    W.release()


def restored(docs: DataFrame) -> DataFrame:
    """``packed`` rows with their text again, as the last column."""
    return docs.mapInArrow(unpacked, schema_ddl(docs.drop("body"), "text string"))


def schema_ddl(df: DataFrame, more: str) -> StructType:
    """The columns of ``df``, then those of the DDL string ``more``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def crc_bucket(col: str, n: int) -> F.Column:
    """crc32 of an id's decimal text, modulo n (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string")), F.lit(n))


def text_slices(texts: list[str], max_bytes: int = W.SLICE_BYTES) -> Iterator[slice]:
    """Ranges of a list of texts of about ``max_bytes`` each (one text at least), so that a
    fitting sample is taken apart piece by piece."""
    a = size = 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > max_bytes:
            yield slice(a, i)
            a, size = i, 0
        size += len(t)
    if len(texts) > a:
        yield slice(a, len(texts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    max_bytes: int, where: F.Column | None = None) -> list:
    """Bounded training sample: for each value of ``label`` (0, 1) the first ``per_class``
    labelled documents with a text in the order of a hash of doc_id, as far as they fit in
    ``max_bytes``: one that does not fit is passed over, and of a text of over a sixteenth of
    the bytes only the beginning is taken, so that no text takes the place of all others and a
    label with texts has a sample. Rows (text, label); ids and sizes, then the texts, are
    fetched. Warns where a label that occurs has no text."""
    lab = labels.select("doc_id", F.col(label).alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    lab = (lab if where is None else lab.where(where)).groupBy("doc_id").agg(
        F.min("label").alias("label"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).where(F.col("text").isNotNull())
    sized = (texts.select("doc_id", "h", F.octet_length("text").alias("size")).join(lab, "doc_id")
             .groupBy("doc_id", "h", "label").agg(F.min("size").alias("size")))
    order = F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")
    longest = max(4, max_bytes // 16)
    ids = []
    for v in (0, 1):
        room = max_bytes
        rows = sized.where(F.col("label") == v).orderBy(*order).limit(per_class).collect()
        for r in rows:
            if min(r["size"], longest) <= room:
                room -= min(r["size"], longest)
                ids.append((r["doc_id"], r["h"], v))
        if not rows and not lab.where(F.col("label") == v).isEmpty():
            warnings.warn(f"no document labelled {label} = {v} has a text to learn from", stacklevel=2)
    if not ids:
        return []
    wanted = docs.sparkSession.createDataFrame(ids, sized.select("doc_id", "h", "label").schema)
    piece = F.when(F.octet_length("text") <= longest, F.col("text")).otherwise(
        F.substring("text", 1, longest // 4))
    found = (texts.select("doc_id", "h", piece.alias("text")).join(F.broadcast(wanted), ["doc_id", "h"])
             .groupBy("doc_id", "h", "label").agg(F.first("text").alias("text")).collect())
    place = {x[:2]: i for i, x in enumerate(ids)}
    return sorted(found, key=lambda r: place[r["doc_id"], r["h"]])


__all__ = ["BATCH_ROWS", "Scratch", "bounded_batches", "crc_bucket", "ensure_checkpoint_dir", "labelled_sample",
           "packed", "restored", "schema_ddl", "scratch_path", "staged", "table", "text_slices", "unpacked"]
