"""Layers in buckets of the columns that they are fused on, so that fusing them moves no row.

All layers of one fusion share their key columns and number of buckets, and a bucket is one sorted file: a join reads the same
bucket of each layer in one task, without exchange. Buckets are of the whole key, time included, so one long series lies
in all of them. The data are plain Parquet files; their layout is a table of the session's catalog, which `open_layer` makes
anew in a later session.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Buckets of a layer: about one for 128 MB of its largest table; a power of two, as such numbers go together.
BUCKETS = 32


def _quoted(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}`" for c in columns)


def write_layer(df: DataFrame, path: str, on: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Writes df to a new folder in buckets of `on`, sorted by it, and gives it back from there. One exchange, by the buckets; a
    key's rows keep together, rows with NULLs in the key too."""
    name = f"layer_{uuid.uuid4().hex}"
    df.repartition(buckets, *on).write.format("parquet").bucketBy(buckets, *on).sortBy(*on).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_layer(spark: SparkSession, path: str, schema: T.StructType, on: list[str], buckets: int = BUCKETS) -> DataFrame:
    """A layer that another session has written with this layout."""
    name = f"layer_{uuid.uuid4().hex}"
    columns = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(on)}) SORTED BY ({_quoted(on)}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def fuse_layers(spine: DataFrame, sources: list[DataFrame], on: list[str]) -> DataFrame:
    """Left joins of layers on their buckets' columns. Sort-merge joins are asked for: a small layer would be broadcast instead,
    for which there is no need, and one that grows would change the plan."""
    return reduce(lambda a, b: a.join(b.hint("merge"), on, "left"), sources, spine)
