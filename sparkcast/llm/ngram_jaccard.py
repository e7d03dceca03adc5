"""Near-duplicate classes by exact Jaccard similarity of word-shingle sets, as a blocked sparse matrix product.

Rows of the matrix are documents (one for each distinct shingle set), columns are shingles. Only the columns that can decide
are kept: in one global order of shingles (rare ones first) a document's first `n - ceil(t n) + 1` shingles. Columns with
the same documents are merged into one that counts as many. Multiplying the matrix by its transpose, a block of columns at a
time, accumulates each pair's overlap; pairs whose overlap cannot reach `t / (1 + t) * (|a| + |b|)` are discarded and the
rest is counted exactly.

Large groups of near copies would fill the product with pairs of one group. So columns with more than a few rows are first
multiplied with a few pivot rows only; what that links is contracted, and the full product then emits pairs of different
classes only, by bands of set sizes. No link between different texts is lost: pairs are left out only if both ends are
already known to be in one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.bytetext import shingle_hashes, text_slices
from sparkcast.llm.common import components, map_ids, mix64, stored

#: Shared passages must not fill the product: a fixed-size counting sketch tells frequent shingles, which come last.
SKETCH_BITS, SKETCH_BLOCK = 22, 1 << 16
#: Shingles of this level or more (see _levels) are counted by partial sums and a join instead of a list of a column's rows.
HOT_LEVEL = 10
#: Other rows go to their columns packed, in buckets of about so many; packed at once.
BUCKET_ROWS, PACKED_ROWS = 1 << 18, 1 << 20
#: Columns with more rows than this are contracted around pivots first; pivots of a column, and for a row at most; rounds.
HOT_ROWS, PIVOTS, ROUNDS = 8, 4, 3
#: Rounds after the first are for columns with more rows than this.
LARGE_ROWS = 128
#: Low bits of a merged column's number that tell how many columns it stands for; such columns that a document is known by.
WEIGHT_BITS, KNOWN_BY = 12, 64


def _sets(batch: pa.RecordBatch, size: int):
    """Yields (row, sorted distinct shingle hashes) of a batch with columns doc_id, text."""
    for lo, data, offsets in text_slices(batch.column(1)):
        hashes, bounds = shingle_hashes(data, offsets, size)
        for d in range(len(offsets) - 1):
            yield lo + d, np.unique(hashes[bounds[d] : bounds[d + 1]])


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length by their bytes' places, compressed: places of small numbers are mostly zeros."""
    return pa.compress(b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns), "zstd", asbytes=True)


def _unpack(packed: bytes, n: int, *types) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    raw = np.frombuffer(pa.decompress(packed, n * sum(widths), "zstd", asbytes=True), np.uint8)
    parts = np.split(raw, n * np.cumsum(widths)[:-1])
    return [np.ascontiguousarray(part.reshape(w, n).T).view(t).ravel() for part, w, t in zip(parts, widths, types, strict=True)]


def _keys_and_sketch(size: int):
    """Rows (doc_id, n, k1, k2) for documents, then rows (block, counts) for the partition's sketch of shingle counts."""

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n", "k1", "k2", "block", "counts"]
        for batch in batches:
            n, k1, k2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, s in _sets(batch, size):
                n[row] = len(s)
                k1[row] = mix64(s).sum(dtype=np.uint64).view(np.int64)
                k2[row] = mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)
                np.add.at(sketch, (s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
            none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(k1), pa.array(k2), *none], names)
        blocks = sketch.reshape(-1, SKETCH_BLOCK)
        for k in np.flatnonzero(blocks.any(axis=1)):
            none = [pa.nulls(1, pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*none, pa.array([k], pa.int32()), pa.array([_pack(blocks[k])], pa.binary())], names)

    return run


def _add_sketches(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[k] = total.get(k, 0) + _unpack(packed, SKETCH_BLOCK, np.uint32)[0].astype(np.int64)
    for k, v in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_pack(v)], pa.binary())], ["block", "counts"])


def _levels(rows) -> np.ndarray:
    """For each slot of the sketch how frequent its shingles are, as a power of two over what chance puts there."""
    count = np.zeros(1 << SKETCH_BITS)
    for r in rows:
        count[r.block * SKETCH_BLOCK : (r.block + 1) * SKETCH_BLOCK] = _unpack(r.counts, SKETCH_BLOCK, np.int64)[0]
    mean = count.mean()
    return np.log2(np.maximum(1, count - mean - 4 * np.sqrt(mean))).astype(np.uint8)


def _prefixes(size: int, percent: int, levels):
    """Rows (x, n, h, prefix): a document's first shingles in the global order (level, hash), the hot ones from number h on."""

    def run(batches):
        level = levels.value
        for batch in batches:
            ids, ns, hs, flat, bounds = batch.column(0).to_numpy(zero_copy_only=False), [], [], [], [0]
            for _, s in _sets(batch, size):
                keep = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                own = level[(s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                first = np.argsort(own, kind="stable")[:keep]
                ns.append(len(s))
                hs.append(int(np.searchsorted(own[first], HOT_LEVEL)))
                flat.append(s[first].view(np.int64))
                bounds.append(bounds[-1] + len(first))
            if ns:
                prefix = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ns, pa.int32()), pa.array(hs, pa.int32()), prefix], ["x", "n", "h", "prefix"])

    return run


def _packed_rows(buckets: int, at_once: int):
    """Of documents (x, n, h, prefix) the rows (s, x, n, i) of shingles that aren't hot, packed by buckets of s."""

    def run(batches):
        for batch in batches:
            x, n, h = (batch.column(k).to_numpy() for k in range(3))
            first, values = batch.column(3).offsets.to_numpy()[:-1], batch.column(3).values.to_numpy()
            ends, lo = np.cumsum(h, dtype=np.int64), 0
            while lo < len(x):
                before = ends[lo] - h[lo]
                hi = max(lo + 1, int(np.searchsorted(ends, before + at_once, "right")))
                doc = np.repeat(np.arange(lo, hi), h[lo:hi])
                i = np.arange(len(doc)) - (ends - h - before)[doc]
                s = values[first[doc] + i]
                b = s >> 24 & buckets - 1  # a prefix has the least hashes, and low bits choose the sketch's slot
                order = np.argsort(b, kind="stable")
                s, doc, i = s[order], doc[order], i[order].astype(np.int32)
                some, at = np.unique(b[order], return_index=True)
                parts = [slice(*ab) for ab in zip(at, [*at[1:], len(s)], strict=True)]
                packed = [_pack(s[p], np.diff(x[doc[p]], prepend=0), n[doc[p]], i[p]) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([p.stop - p.start for p in parts], pa.int32()), pa.array(packed, pa.binary())], ["b", "m", "packed"])
                lo = hi

    return run


def _shared_rows(bucket: pa.Table) -> pa.Table:
    """Of a bucket's packed rows the shingles with two rows or more, as (s, rows)."""
    parts = [_unpack(p, m, np.int64, np.int64, np.int32, np.int32) for m, p in zip(bucket["m"].to_pylist(), bucket["packed"].to_pylist(), strict=True)]
    s, x, n, i = (np.concatenate(c) for c in zip(*((s, np.cumsum(x), n, i) for s, x, n, i in parts), strict=True))
    order = np.argsort(s, kind="stable")
    some, df = np.unique(s, return_counts=True)
    order = order[np.repeat(df > 1, df)]
    rows = pa.StructArray.from_arrays([pa.array(c[order]) for c in (x, n, i)], ["x", "n", "i"])
    bounds = pa.array(np.concatenate([[0], np.cumsum(df[df > 1])]), pa.int32())
    return pa.table({"s": pa.array(some[df > 1]), "rows": pa.ListArray.from_arrays(bounds, rows)})


def _packed_sets(size: int):
    def run(batches):
        for batch in batches:
            packed = [s.tobytes() for _, s in _sets(batch, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["x", "packed"])

    return run


def _linked(percent: int):
    """Of rows (x, y, a, b) with packed sets those pairs that link."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                both = len(a) + len(b) - len(np.union1d(a, b)) if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Product:
    """The documents' sets and the links found so far."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent, self.spark = docs, size, percent, docs.sparkSession

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """(x, packed) for the given documents."""
        return map_ids(self.docs, "doc_id", ids.select("x"), _packed_sets(self.size), "x long, packed binary")

    def links(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Those of the pairs that link, by the given sets or those of the documents. Only sets that a side needs are shuffled."""
        of = self.sets_of if sets is None else lambda ids: map_ids(sets, "x", ids, lambda batches: batches, "x long, packed binary")
        a = of(pairs.select("x").distinct()).withColumnRenamed("packed", "a")
        b = of(pairs.select(F.col("y").alias("x")).distinct()).toDF("y", "b")
        both = pairs.join(a, "x").join(b, "y").select("x", "y", "a", "b")
        return both.mapInArrow(_linked(self.percent), "x long, y long")


def _halves(x: Column, n: Column) -> list[Column]:
    """Halves of two hashes of a row's document, so that no sum overflows."""
    hashes = [F.xxhash64(x, n, F.lit(k)) for k in (1, 2)]
    return [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]


def _column_marks() -> dict[str, Column]:
    """Sums over a column's rows that tell its set of documents."""
    return {"df": F.count("*")} | {f"mark{k}": F.sum(half) for k, half in enumerate(_halves(F.col("x"), F.col("n")))}


def _list_marks() -> dict[str, Column]:
    """The same of a column whose rows are in a list."""
    total = lambda k: F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + _halves(r["x"], r["n"])[k])
    return {"df": F.size("rows").cast("long")} | {f"mark{k}": total(k) for k in range(4)}


def _shared_columns(prefixes: DataFrame) -> DataFrame:
    """Rows (x, n, i, r, m, g, df, w) for each document and merged column with two rows or more, written.

    Columns with equal marks are merged. i is the place of the first of the merged columns in the prefix, r its place among
    the document's m shared columns, df the column's number of rows and w how many columns were merged. What was merged is
    then compared between the documents: where they don't have the same shingles in it, marks have collided, and each of its
    columns stands for itself. So g, a number that has w in its low bits, is one of the column alone, whatever the hashes.
    """
    marks = _column_marks()
    number_of = F.shiftright(F.xxhash64(*marks), WEIGHT_BITS).alias("k")
    # most shingles are in one document only: packed rows take a few bytes more than their hashes, however many buckets
    buckets = 1 << max(6, (prefixes.agg(F.sum("h")).first()[0] or 0) // BUCKET_ROWS).bit_length()
    packed = prefixes.select("x", "n", "h", "prefix").mapInArrow(_packed_rows(buckets, PACKED_ROWS), "b int, m int, packed binary")
    lists = packed.groupBy("b").applyInArrow(_shared_rows, "s long, rows array<struct<x:long,n:int,i:int>>")
    cold = lists.select("s", "rows", *(v.alias(k) for k, v in _list_marks().items())).select("s", "df", number_of, F.inline("rows"))
    hot = prefixes.select("x", "n", "h", F.posexplode("prefix").alias("i", "s")).where("i >= h").drop("h")
    hot = hot.join(hot.groupBy("s").agg(*(v.alias(k) for k, v in marks.items())), "s").where("df > 1").select("s", "df", number_of, "x", "n", "i")
    shared = cold.union(hot)
    # of a document's shared columns this is number r of m: two documents share at most min(r, r2) + 1 + min(m - r, m2 - r2) - 1
    own = Window.partitionBy("x", "n")
    in_order = own.orderBy("i", "s")
    once = shared.withColumn("again", F.coalesce(F.lag("s").over(in_order) == F.col("s"), F.lit(False))).where("not again")  # rows that repeat a doc_id
    placed = once.withColumn("r", F.row_number().over(in_order) - 1).withColumn("m", F.count("*").over(own))
    folded = F.sum(F.col("s").bitwiseAND(F.lit(0xFFFFFFFF)) + F.shiftrightunsigned("s", 32))
    merged = placed.groupBy("x", "n", "k", "df").agg(F.min(F.struct("i", "r")).alias("at"), F.first("m").alias("m"), F.count("*").alias("w"), F.min("s").alias("least"), F.max("s").alias("most"), folded.alias("folded"))
    merged = stored(merged.select("x", "n", "at.i", "at.r", "m", "k", "df", "w", "least", "most", "folded"), "merged")
    what = F.struct("df", "w", "least", "most", "folded")
    odd = stored(merged.groupBy("k").agg(F.min(what).alias("lo"), F.max(what).alias("hi")).where("lo <> hi").select("k"), "odd")
    number = lambda k, w: F.shiftleft(k, WEIGHT_BITS).bitwiseOR(F.least(w, F.lit((1 << WEIGHT_BITS) - 1)))
    out = merged.select("x", "n", "i", "r", "m", number(F.col("k"), F.col("w")).alias("g"), "df", "w", "k")
    if odd.isEmpty():
        return out.drop("k")
    apart = placed.join(odd, "k").select("x", "n", "i", "r", "m", F.col("s").alias("g"), "df", F.lit(1).cast("long").alias("w"))
    return stored(out.join(odd, "k", "left_anti").drop("k").union(apart), "product")


def _can_link(percent: int):
    """Whether the rows (n, i, r, m) and (n2, i2, r2, m2) of a column may be of documents that link, by sizes and places; and
    the least overlap of the prefixes."""
    need = F.ceil((F.col("n") + F.col("n2")) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9))
    rest = F.greatest(*(F.ceil(F.lit(percent) * F.col(k) / 100 - F.lit(1e-9)) - 1 for k in ("n", "n2")))  # shingles after a prefix
    after = F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2"))
    can = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (F.least("i", "i2") + after >= need)
    return can & (F.least("r", "r2") + F.least(F.col("m") - F.col("r"), F.col("m2") - F.col("r2")) >= need - rest), need - rest


_PLACE = ("x", "n", "i", "r", "m", "c", "w")


def _pivot_pairs(at: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (x, y): each row with that pivot of its columns that it shares most columns with, in later turns with more.

    A column's pivots are a row with most shared columns for its size, as it lies in the middle of its group, and others by
    hash. They are chosen by aggregates, so a column's size does not matter.
    """
    place = F.struct(*_PLACE)
    picks = [F.max_by(place, F.struct(F.col("m") / F.col("n"), "x")) if turn == 0 else F.min_by(place, F.struct(F.xxhash64("x", F.lit(-turn)), "x"))]
    picks += [F.min_by(place, F.struct(F.xxhash64("x", F.lit(turn * PIVOTS + k)), "x")) for k in range(1, PIVOTS)]
    pivots = at.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.array_distinct(F.array(*picks)).alias("p")).where("lo < hi")
    near = at.join(pivots.select("g", "p"), "g").select("g", *_PLACE, F.explode("p").alias("p"))
    near = near.select(*_PLACE, *(F.col(f"p.{k}").alias(f"{k}2") for k in _PLACE))
    found = near.where((F.col("c") != F.col("c2")) & _can_link(percent)[0]).groupBy("x", F.col("x2").alias("y")).agg(F.sum(F.least("w", "w2")).alias("k"))
    best = found.groupBy("x").agg(F.slice(F.sort_array(F.collect_list(F.struct("k", "y")), asc=False), 1, min(1 + turn, PIVOTS)).alias("best"))
    pairs = best.select("x", F.explode("best.y").alias("y"))
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _product(at: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of different classes whose overlap in the columns suffices.

    Columns with many rows are mostly those of passages that the documents share, so two rows that meet in one meet in
    others too. Such a pair is emitted once, in the first of the columns that both are known by, with its overlap in all.
    """
    can, least = _can_link(percent)
    can = can & (F.col("c") != F.col("c2"))
    other = [F.col(k).alias(f"{k}2") for k in _PLACE]
    lo, hi = F.least("x", "x2").alias("x"), F.greatest("x", "x2").alias("y")
    cold, hot = at.where(F.col("df") <= HOT_ROWS), at.where(F.col("df") > HOT_ROWS)
    met = cold.join(cold.select("g", *other), "g").where(can & (F.col("x") < F.col("x2"))).select(lo, hi, F.least("w", "w2").alias("overlap"), least.alias("least"))
    # in a column with many rows those of its largest class meet the others only, and sizes in bands within reach
    top = hot.groupBy("g", "c").count().groupBy("g").agg(F.max_by("c", F.struct("count", "c")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
    step = F.log(F.lit(100 / percent)) if percent < 100 else F.lit(1.0)
    hot = hot.join(top.select("g", "top"), "g").withColumn("band", F.floor(F.log("n") / step))
    hot = hot.join(hot.groupBy("x").agg(F.slice(F.sort_array(F.collect_set("g")), 1, KNOWN_BY).alias("own"), (F.count("*") <= KNOWN_BY).alias("all")), "x")
    near = hot.select("g", *other, F.col("top").alias("top2"), F.col("own").alias("own2"), F.col("all").alias("all2"), F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("band"))
    both = F.array_intersect("own", "own2")
    once = F.coalesce(F.get(both, F.lit(0)), F.col("g")) == F.col("g")
    met_hot = hot.where("c <> top").join(near, ["g", "band"]).where(can & ((F.col("c2") == F.col("top2")) | (F.col("x") < F.col("x2"))) & once)
    weights = F.aggregate(both, F.lit(0).cast("long"), lambda a, g: a + g.bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1)))
    # a document with more columns than it is known by may share any number of them
    overlap = F.when(F.size(both) == 0, F.least("w", "w2")).when(F.col("all") & F.col("all2"), weights).otherwise(F.least("m", "m2"))
    met_hot = met_hot.select(lo, hi, overlap.alias("overlap"), least.alias("least"))
    found = met.union(met_hot).groupBy("x", "y").agg(F.sum("overlap").alias("overlap"), F.min("least").alias("least"))
    return found.where("overlap >= least").select("x", "y")


def _classes_of(post: DataFrame, labels: DataFrame | None) -> DataFrame:
    """post with each row's class `c`."""
    if labels is None:
        return post.withColumn("c", F.col("x"))
    return post.join(labels.select(F.col("node").alias("x"), "comp"), "x", "left").withColumn("c", F.coalesce("comp", "x")).drop("comp")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("x").union(pairs.select("y")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different classes."""
    of = labels.select("node", "comp")
    both = pairs.join(of.toDF("x", "cx"), "x", "left").join(of.toDF("y", "cy"), "y", "left")
    return both.where("coalesce(cx, x) <> coalesce(cy, y)").select("x", "y")


def ngram_jaccard(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (doc_id, n_shingles, component_id), one row for each row of docs.

    Two documents link when their sets of `size`-word shingles (A-Z lower-cased; fewer words are one shingle) have a Jaccard
    similarity of `percent` / 100 or more, decided in integers. component_id is the smallest doc_id reachable by links.
    Null or empty texts and texts without words have 0 shingles and link with nothing. Rows that repeat a doc_id are one
    document, linked through any of its texts. A null doc_id takes no part: its component_id is null. Extra columns are
    ignored. Texts may be of any length; a document's set is held as a whole. An empty table gives an empty result. Shingles
    count as equal when their 64-bit hashes are.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scanned = stored(docs.mapInArrow(_keys_and_sketch(size), "doc_id long, n long, k1 long, k2 long, block int, counts binary"), "keys")
    keys = scanned.where("block is null").select("doc_id", "n", "k1", "k2")
    known = keys.where("n > 0 and doc_id is not null")
    reps = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("x"))
    sketch = scanned.where("block is not null").select("block", "counts").repartition(16, "block").mapInArrow(_add_sketches, "block int, counts binary")
    levels = spark.sparkContext.broadcast(_levels(sketch.collect()))

    product = _Product(docs.where("doc_id is not null"), size, percent)
    # of equal sets one has rows (a few others that the bitmap lets through link with theirs)
    prefixes = map_ids(product.docs, "doc_id", reps.select("x"), _prefixes(size, percent, levels), "x long, n int, h int, prefix array<long>", "x")
    prefixes = stored(prefixes.where("n > 0"), "prefixes")
    post = _shared_columns(prefixes)  # the only rows that the rest works on

    labels, links = None, None

    def add(found: DataFrame) -> int:
        """Takes the links found and tells their number."""
        nonlocal labels, links
        found = stored(found, "links")
        if n := found.count():
            links = found if links is None else links.union(found)
            labels = components(links.toDF("u", "v"))
        return n

    hot = post.where(F.col("df") > HOT_ROWS)
    for turn in range(ROUNDS):
        large = hot if turn == 0 else hot.where(F.col("df") > LARGE_ROWS)
        pairs = stored(_pivot_pairs(_classes_of(large, labels), percent, turn), "near")
        n = pairs.count()
        if n == 0 or 4 * add(product.links(pairs)) < n:
            break  # what is left in these columns are mostly pairs that don't link
    pairs = stored(_product(_classes_of(post, labels), percent), "pairs")
    if not pairs.isEmpty():
        sets = stored(product.sets_of(_ends(pairs)), "sets")
        # first each document with its smallest partner, which joins most groups; then what still lies in different classes
        first = stored(pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y"), "first")
        add(product.links(first, sets))
        rest = pairs.join(first, ["x", "y"], "left_anti")
        rest = stored(rest if labels is None else _apart(rest, labels), "rest")
        add(product.links(rest, sets))

    # every distinct set's representative, then every document
    if labels is not None:
        reps = reps.join(labels.select(F.col("node").alias("x"), "comp"), "x", "left").select("k1", "k2", F.coalesce("comp", "x").alias("x"))
    own = known.join(reps, ["k1", "k2"]).groupBy("doc_id").agg(F.min("x").alias("x"))
    out = keys.join(own, "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("x", "doc_id").alias("component_id"))
