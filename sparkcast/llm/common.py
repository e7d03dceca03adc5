"""Shared plumbing of the corpus operators: written tables in the shared folder, and id bitmaps of fixed size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.sources.scratch import scratch_path

#: Bits of an id bitmap for every id, at least so many, and the most bits of one (32 MB). More ids than that take a join.
BITS_PER_ID, LEAST_BITS_PER_ID, MAX_BITMAP_BITS = 64, 8, 1 << 28
_BLOCK = 1 << 15


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: the lineage is cut and the rows outlive executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, whatever its case."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name = "_" + name
    return name


def sha256_hex(text: Column) -> Column:
    """Lowercase hex of the UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def id_bitmap(ids: DataFrame, column: str) -> np.ndarray | None:
    """A packed bitmap over hashed ids: rows whose bit is 0 are surely not among the ids. None if it would be too large.

    It goes through the driver as MAX_BITMAP_BITS / 8 bytes at most, however many ids there are.
    """
    n = ids.count()
    if LEAST_BITS_PER_ID * n > MAX_BITMAP_BITS:
        return None
    bits = min(MAX_BITMAP_BITS, max(1 << 20, 1 << (BITS_PER_ID * n).bit_length()))

    def mark(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = bitmap_slots(batch.column(0).to_numpy(zero_copy_only=False), bits)
            for k in np.unique(at // _BLOCK):
                found.setdefault(int(k), np.zeros(_BLOCK, bool))[at[at // _BLOCK == k] % _BLOCK] = True
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([np.packbits(v).tobytes() for v in found.values()], pa.binary())], ["block", "bits"])

    def merge(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = np.frombuffer(own, np.uint8)
                found[k] = found[k] | new if k in found else new
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["block", "bits"])

    schema = "block int, bits binary"
    rows = ids.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(mark, schema).repartition(16, "block").mapInArrow(merge, schema).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r.block * _BLOCK // 8 : (r.block + 1) * _BLOCK // 8] = np.frombuffer(r.bits, np.uint8)[: len(out)]  # a small bitmap is less than a block
    return out


def bitmap_slots(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def in_bitmap(packed: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = bitmap_slots(ids, len(packed) * 8)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def map_ids(df: DataFrame, column: str, ids: DataFrame, fn, schema: str, out: str | None = None) -> DataFrame:
    """df.mapInArrow(fn, schema) over the rows of df (whose `column`, a long, comes first) with one of the ids, and perhaps a
    few others. A bitmap in the same Python worker saves shuffling df. If there are too many ids, they are joined: with df or,
    if `out` names the id's column in what fn gives, with that."""
    name = ids.columns[0]
    bitmap = id_bitmap(ids, name)
    if bitmap is None and out:
        return df.mapInArrow(fn, schema).join(ids.select(F.col(name).alias(out)).distinct(), out, "left_semi")
    if bitmap is None:
        return df.join(ids.select(F.col(name).alias(column)).distinct(), column, "left_semi").mapInArrow(fn, schema)
    given = df.sparkSession.sparkContext.broadcast(bitmap)

    def chosen(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(given.value, batch.column(0).to_numpy(zero_copy_only=False))))
            if batch.num_rows:
                yield batch

    return df.mapInArrow(lambda batches: fn(chosen(batches)), schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v) as rows (node, comp), comp being the smallest node of its component.

    Every node takes the smallest label among its neighbours and then its label's label, until nothing changes. Each round
    is one job over the edges and is written to the shared folder; only the number of changed labels reaches the driver.
    """
    both = stored(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "edges")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "comp"), "v").groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        moved = stored(step.join(jump, "comp", "left").select("node", "was", F.least("comp", "further").alias("comp")), "labels")
        labels = moved.select("node", "comp")
        if moved.where("comp <> was").isEmpty():
            return labels
