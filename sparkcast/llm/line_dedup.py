"""Incremental, reversible line dedup: sharded cuckoo filters over exact reference-count tables.

The reference-count table has for every line key the number of documents holding it and the smallest of their ids, its owner.
Each shard's cuckoo filter holds the keys that two documents or more hold: a line that misses its filter surely stays, so
only hits go on to the exact table, which decides. Inserting documents adds to the counts and to the filters; deleting them
subtracts, finds new owners and takes fingerprints out again, which is what cuckoo filters can and Bloom filters cannot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.bytetext import line_spans, text_slices
from sparkcast.llm.common import free_name, mix64, stored

MIN_CHARS = 10
#: Keys a shard is made for; slots of a bucket; rounds of evictions before a filter grows.
SHARD_KEYS, SLOTS, MAX_ROUNDS = 1 << 16, 4, 500
#: Filters go to every task only if they are at most this large together; beyond it lines are dealt to their shards' filters,
#: a shard's lines over so many parts.
BROADCAST_BYTES, PARTS = 64 << 20, 64


class CuckooFilter:
    """A cuckoo filter of 16-bit fingerprints over 64-bit hashes, working on arrays of hashes."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets

    @classmethod
    def of(cls, hashes: np.ndarray, room: int = 0) -> CuckooFilter:
        """room: keys to leave place for; the filter doubles until all fit."""
        size = 1 << max(4, int(np.ceil(np.log2(max(len(hashes), room, 1) / (SLOTS * 0.8)))))
        while True:
            made = cls(np.zeros((size, SLOTS), np.uint16))
            if made.insert(hashes):
                return made
            size *= 2

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes & np.uint64(len(self.buckets) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (mix64(prints) & np.uint64(len(self.buckets) - 1)).astype(np.int64)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if there was no room; the filter must then be made anew from the exact table."""
        prints, at = self._places(hashes)
        rng = np.random.default_rng(len(hashes))
        for turn in range(MAX_ROUNDS):
            if not len(prints):
                return True
            _, one = np.unique(at, return_index=True)  # one fingerprint a bucket and round
            free = self.buckets[at[one]] == 0
            slot = np.where(free.any(axis=1), free.argmax(axis=1), rng.integers(0, SLOTS, len(one)))
            if turn % 2 == 0:  # every other round only takes free slots
                one, slot = one[free.any(axis=1)], slot[free.any(axis=1)]
            out = self.buckets[at[one], slot].copy()
            self.buckets[at[one], slot] = prints[one]
            rest = np.ones(len(prints), bool)
            rest[one] = False
            moved_at = self._other(out, at[one])[out != 0]
            waiting = self._other(prints[rest], at[rest]) if turn % 2 == 0 else at[rest]
            prints, at = np.concatenate([prints[rest], out[out != 0]]), np.concatenate([waiting, moved_at])
        return False

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, at = self._places(hashes)
        return (self.buckets[at] == prints[:, None]).any(axis=1) | (self.buckets[self._other(prints, at)] == prints[:, None]).any(axis=1)

    def delete(self, hashes: np.ndarray) -> None:
        """Takes out one fingerprint for each hash; the hashes must have been inserted."""
        prints, at = self._places(hashes)
        for p, i, j in zip(prints, at, self._other(prints, at), strict=True):
            for bucket in (self.buckets[i], self.buckets[j]):
                if (found := np.flatnonzero(bucket == p)).size:
                    bucket[found[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.buckets.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())


def _lines_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, ...], np.ndarray]]:
    """Per slice: first row, bytes, line spans, and which lines have a key that is long enough."""
    for lo, data, offsets in text_slices(texts):
        spans = line_spans(data, offsets)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        yield lo, data, spans, points[spans[4]] - points[spans[3]] >= MIN_CHARS


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit digests of the lower-cased keys data[start:end], as two columns of integers."""
    raw = data.tobytes().lower()  # of bytes only A-Z change
    digests = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.frombuffer(digests, np.int64).reshape(-1, 2)


def _postings(filters=None, n_shards: int = 0):
    """Rows (k1, k2, doc_id), once for each key and document; with filters only those that may be shared."""

    def run(batches):
        probes = None if filters is None else {k: CuckooFilter.from_bytes(v) for k, v in filters.value.items()}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, data, (_, _, doc, key_starts, key_ends), full in _lines_of(batch.column(1)):
                keys, doc = _keys(data, key_starts[full], key_ends[full]), doc[full]
                k1, k2 = keys[:, 0], keys[:, 1]
                if probes is not None:
                    shard, hit = k1.view(np.uint64) >> np.uint64(40) & np.uint64(n_shards - 1), np.zeros(len(k1), bool)
                    for s, probe in probes.items():
                        own = np.flatnonzero(shard == s)
                        hit[own] = probe.contains(k2[own].view(np.uint64))
                    doc, k1, k2 = doc[hit], k1[hit], k2[hit]
                order = np.lexsort((k2, k1, doc))
                doc, k1, k2 = doc[order], k1[order], k2[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(k1[new]), pa.array(k2[new]), pa.array(ids[lo + doc[new]])], ["k1", "k2", "doc_id"])

    return run


def _probed(batches):
    """Of rows (k1, k2, doc_id, shard, bits), sorted so that a shard's filter comes before its lines, the lines that may be
    shared."""
    shard, probe = None, None
    for batch in batches:
        shards = batch.column(3).to_numpy()
        edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1), len(shards)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a and shards[a] != shard:
                shard, probe = shards[a], None
            filters = batch.column(4).slice(a, b - a)
            for k in np.flatnonzero(filters.is_valid().to_numpy(zero_copy_only=False)):
                probe = CuckooFilter.from_bytes(filters[int(k)].as_py())
            lines = batch.slice(a, b - a).select([0, 1, 2]).filter(filters.is_null())
            if probe is not None and lines.num_rows:
                yield lines.filter(pa.array(probe.contains(lines.column(1).to_numpy().view(np.uint64))))


def _shard(n_shards: int):
    return F.shiftrightunsigned("k1", 40).bitwiseAND(F.lit(n_shards - 1)).cast("int")


def _build(pdf):
    made = CuckooFilter.of(np.sort(pdf["k2"].to_numpy().view(np.uint64)), SHARD_KEYS // 8)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "bits": [made.to_bytes()]})


def _update(had, change):
    """A shard's filter after keys came (d = 1) or went (d = -1)."""
    shard = (change if len(change) else had)["shard"].iloc[0]
    hashes = change["k2"].to_numpy().view(np.uint64)
    new, gone = np.sort(hashes[change["d"].to_numpy() > 0]), hashes[change["d"].to_numpy() < 0]
    if not len(had):
        return pd.DataFrame({"shard": [shard], "bits": [CuckooFilter.of(new).to_bytes()], "full": [False]})
    kept = CuckooFilter.from_bytes(had["bits"].iloc[0])
    kept.delete(gone)
    room = kept.insert(new)
    return pd.DataFrame({"shard": [shard], "bits": [kept.to_bytes()], "full": [not room]})


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]))
def _rewritten(texts: pa.Array, drop1: pa.Array, drop2: pa.Array) -> pa.Array:
    n_lines, n_dropped, kept = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), []
    drops1, drops2 = drop1.to_pylist(), drop2.to_pylist()
    for lo, data, (starts, ends, doc, key_starts, key_ends), full in _lines_of(texts):
        rows = int(doc[-1]) + 1
        bounds = np.searchsorted(doc, np.arange(rows + 1))
        n_lines[lo : lo + rows] = np.diff(bounds)
        for d in range(rows):
            a, b = bounds[d], bounds[d + 1]
            first, last = starts[a], ends[b - 1]
            if drops1[lo + d]:
                gone, own = set(zip(drops1[lo + d], drops2[lo + d], strict=True)), a + np.flatnonzero(full[a:b])
                keys = _keys(data[first:last], key_starts[own] - first, key_ends[own] - first).tolist()
                away = {k for k, key in zip(own.tolist(), keys, strict=True) if tuple(key) in gone}
                n_dropped[lo + d] = len(away)
                kept.append(b"\n".join(data[starts[k] : ends[k]].tobytes() for k in range(a, b) if k not in away).decode())
            else:
                kept.append(data[first:last].tobytes().decode())
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(n_lines), pa.array(n_dropped)], ["text", "n_lines", "n_dropped"])


def _doc_key():
    """A null doc_id counts as one document before all others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id")


@dataclass
class LineIndex:
    """counts (k1, k2, refs, owner), filters (shard, bits) over keys with two refs or more, and postings if reversible."""

    counts: DataFrame
    filters: DataFrame
    n_shards: int
    postings: DataFrame | None = None

    @classmethod
    def build(cls, docs: DataFrame, reversible: bool = True) -> LineIndex:
        """reversible: keeps the postings too, which deletions need."""
        postings = docs.select(_doc_key(), "text").mapInArrow(_postings(), "k1 long, k2 long, doc_id long")
        return cls._of(stored(postings.distinct(), "postings") if reversible else postings, reversible)

    @classmethod
    def _of(cls, postings: DataFrame, reversible: bool) -> LineIndex:
        # rows that repeat a doc_id may repeat its keys: refs then counts holders too many, but owner < last holder decides
        counts = postings.groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        counts = stored(counts.select("k1", "k2", F.when(F.col("owner") < F.col("last"), F.greatest("refs", F.lit(2))).otherwise(1).alias("refs"), "owner"), "counts")
        n_shards = cls._shards_for(counts)
        return cls(counts, cls._filters(counts, n_shards), n_shards, postings if reversible else None)

    @staticmethod
    def _shards_for(counts: DataFrame) -> int:
        return 1 << max(0, (counts.where("refs > 1").count() // SHARD_KEYS).bit_length())

    @staticmethod
    def _filters(counts: DataFrame, n_shards: int) -> DataFrame:
        shared = counts.where("refs > 1").select(_shard(n_shards).alias("shard"), "k2")
        return stored(shared.groupBy("shard").applyInPandas(_build, "shard int, bits binary"), "filters")

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index after documents came. A reversible index knows what it has: a document that comes again adds only the
        lines that are new to its id. Without postings the ids must be new."""
        new = docs.select(_doc_key(), "text").mapInArrow(_postings(), "k1 long, k2 long, doc_id long").distinct()
        new = stored(new.join(self.postings, ["k1", "k2", "doc_id"], "left_anti") if self.postings is not None else new, "postings")
        more = new.groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner"))
        both = self.counts.select("k1", "k2", "refs", F.lit(0).cast("long").alias("added"), "owner").union(more.select("k1", "k2", F.col("refs"), F.col("refs"), "owner"))
        merged = both.groupBy("k1", "k2").agg(F.sum("refs").alias("refs"), (F.sum("refs") - F.sum("added")).alias("was"), F.min("owner").alias("owner"))
        return self._changed(merged, self.postings.union(new) if self.postings is not None else None)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index after the documents with these doc_ids went; it is then as if they had never come."""
        if self.postings is None:
            raise ValueError("an index that was built with reversible=False has no postings to delete by")
        gone = doc_ids.select(_doc_key()).distinct()
        left = stored(self.postings.join(gone, "doc_id", "left_anti").select("k1", "k2", "doc_id"), "postings")
        hit = self.postings.join(gone, "doc_id", "left_semi").select("k1", "k2").distinct()
        now = left.join(hit, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner"))
        touched = self.counts.join(hit, ["k1", "k2"], "left_semi").select("k1", "k2", F.col("refs").alias("was"))
        after = touched.join(now, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("refs", F.lit(0)).cast("long").alias("refs"), "was", "owner")
        same = self.counts.join(hit, ["k1", "k2"], "left_anti").select("k1", "k2", "refs", F.col("refs").alias("was"), "owner")
        return self._changed(after.union(same), left)

    def _changed(self, merged: DataFrame, postings: DataFrame | None) -> LineIndex:
        merged = stored(merged, "counts")
        counts = merged.where("refs > 0").select("k1", "k2", "refs", "owner")
        n_shards = self._shards_for(counts)
        if n_shards > 2 * self.n_shards:  # shards must not grow with the index
            return LineIndex(counts, self._filters(counts, n_shards), n_shards, postings)
        moved = merged.where("(refs > 1) <> (was > 1)").select(_shard(self.n_shards).alias("shard"), "k2", F.when(F.col("refs") > 1, 1).otherwise(-1).alias("d"))
        filters = self.filters.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(_update, "shard int, bits binary, full boolean")
        filters = stored(filters, "filters")
        rebuilt = filters.drop("full") if filters.where("full").isEmpty() else self._filters(counts, self.n_shards)
        return LineIndex(counts, rebuilt, self.n_shards, postings)

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs, whose rows the index has, with the lines gone that a smaller doc_id owns; adds n_lines and n_dropped."""
        total = self.filters.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
        texts, schema = docs.select(_doc_key(), "text"), "k1 long, k2 long, doc_id long"
        if total <= BROADCAST_BYTES:
            given = docs.sparkSession.sparkContext.broadcast({r.shard: bytes(r.bits) for r in self.filters.collect()})
            hits = texts.mapInArrow(_postings(given, self.n_shards), schema)
        else:
            every = texts.mapInArrow(_postings(), schema).withColumn("shard", _shard(self.n_shards)).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
            parts = self.filters.select("shard", "bits", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
            dealt = every.unionByName(parts, allowMissingColumns=True).repartition("shard", "part").sortWithinPartitions("part", "shard", F.col("bits").isNull())
            hits = dealt.select("k1", "k2", "doc_id", (F.col("part") * self.n_shards + F.col("shard")).alias("shard"), "bits").mapInArrow(_probed, schema)
        gone = hits.join(self.counts.where("refs > 1").select("k1", "k2", "owner"), ["k1", "k2"]).where("owner < doc_id")
        key, d1, d2, new = (free_name(docs, s) for s in ("_key", "_drop1", "_drop2", "_new"))
        drops = gone.groupBy(F.col("doc_id").alias(key)).agg(F.collect_list("k1").alias(d1), F.collect_list("k2").alias(d2))
        met = docs.withColumn(key, _doc_key()).join(drops, key, "left").withColumn(new, _rewritten("text", d1, d2))
        columns = [F.col(f"{new}.text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
        return met.select(*columns, f"{new}.n_lines", f"{new}.n_dropped")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines removed, plus n_lines (before) and n_dropped; columns of these names are replaced.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. A key of MIN_CHARS code points or more that
    two documents or more hold loses all its lines except in the smallest doc_id holding it. A null or empty text is one
    empty line and comes back empty. Rows that repeat a doc_id count as one document, a null doc_id as one document before
    all others. Other columns stay. Keys count as equal when their 128-bit digests are. A text is held as a whole, however long.
    """
    return LineIndex.build(docs, reversible=False).apply(docs)
