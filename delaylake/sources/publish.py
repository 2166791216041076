"""Versioned folders published by one pointer file.

A table or model is written to a fresh folder below its base (``_v-<id>``); only when the
write has ended does the small file ``_current`` name it. The pointer is replaced by a rename,
so a reader sees the old version or the new one, never a mixture, and a failed write leaves
what was there. Old versions stay until :func:`prune`, for readers that still hold them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaylake.session import delete_path

POINTER = "_current"
_VERSION = "_v-"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders of a folder; none if it is missing."""
    _, p, fs = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_pointer(spark: SparkSession, path: str, value: str) -> None:
    """Replaces the text of a small file in one step."""
    jvm, p, fs = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, True)
    try:
        out.write(value.encode())
    finally:
        out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    over = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = over
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), conf)
    files.rename(fs.makeQualified(draft), fs.makeQualified(p), how)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """Its text; None if there is no such file. Any other failure is raised."""
    jvm, p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """Calls ``write`` with a fresh folder below ``base``, then points to it; its path."""
    base = base.rstrip("/")
    name = f"{_VERSION}{uuid.uuid4().hex[:16]}"
    write(f"{base}/{name}")
    write_pointer(spark, f"{base}/{POINTER}", name)
    return f"{base}/{name}"


def current(spark: SparkSession, base: str) -> str | None:
    """Folder of the published version; None before the first one."""
    name = read_pointer(spark, f"{base.rstrip('/')}/{POINTER}")
    return None if name is None else f"{base.rstrip('/')}/{name}"


def prune(spark: SparkSession, base: str) -> int:
    """Deletes every version but the current one, left by earlier or failed writes (call it when
    no reader or writer is at work); how many."""
    base = base.rstrip("/")
    now = current(spark, base)
    old = [c for c in children(spark, base) if c.startswith(_VERSION) and f"{base}/{c}" != now]
    for c in old:
        delete_path(spark, f"{base}/{c}")
    return len(old)


def publish_table(df: DataFrame, base: str, fmt: str = "parquet", **options: str) -> str:
    return publish(df.sparkSession, base, lambda path: df.write.format(fmt).options(**options).save(path))


def read_published(spark: SparkSession, base: str, fmt: str = "parquet", **options: str) -> DataFrame:
    path = current(spark, base)
    if path is None:
        raise FileNotFoundError(f"nothing is published at {base}")
    return spark.read.format(fmt).options(**options).load(path)
