"""Stored tables laid out for their joins: bucketed and sorted on the join keys.

A bucketed table is already dealt by the hash of its keys, so a join (or a grouping) on them
reads it without an exchange; only the other side moves. The layout is kept beside the files
(``_layout``), because a session's catalog may not outlive it: :func:`open_stored` registers
the folder in any session.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaylake.sources.publish import read_pointer, write_pointer

SPREAD = 4       # tasks, and so files, that write one bucket


def store(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
          spread: int = SPREAD) -> DataFrame:
    """Writes ``df`` under ``path`` in ``buckets`` buckets by ``keys``, sorted within each file,
    and returns the stored table.

    A bucket is written by up to ``spread`` tasks, so that a hot key (rows without a tail
    number) does not meet in one, and no task opens more than its share of the buckets. The
    default is as many buckets as the session shuffles into: with fewer, the planner deals both
    sides of a join anew rather than lose that parallelism.
    """
    spark, keys, path = df.sparkSession, list(keys), path.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _name()
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread))
    part = F.pmod(F.hash(*keys), F.lit(buckets))            # the same hash that numbers the buckets
    (df.repartition(buckets * spread, part, salt).write.format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    layout = {"schema": df.schema.json(), "keys": keys, "buckets": buckets}
    write_pointer(spark, f"{path}/_layout", json.dumps(layout))
    return spark.table(name)


def _name() -> str:
    return f"stored_{uuid.uuid4().hex[:16]}"


def open_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table stored under ``path``, with its buckets, in this session."""
    text = read_pointer(spark, f"{path.rstrip('/')}/_layout")
    if text is None:
        raise FileNotFoundError(f"no stored table at {path}")
    layout = json.loads(text)
    schema = StructType.fromJson(json.loads(layout["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in layout["keys"])
    name = _name()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_clean_table(flights: DataFrame, base: str, layouts: dict[str, Sequence[str]],
                      buckets: int | None = None) -> dict[str, DataFrame]:
    """``flights`` stored once for each layout (name -> join keys) under ``base/<name>``: by
    (date, airline, tail) for the cancelled keys, by (airport, day) for the weather."""
    return {name: store(flights, f"{base.rstrip('/')}/{name}", keys, buckets) for name, keys in layouts.items()}
