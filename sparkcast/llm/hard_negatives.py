"""Hard-negative mining with exact integer scores, computed by the method of four Russians.

Components are integers. A candidate's components are packed as bit planes: for each bit, one byte for every group of eight
dimensions. For an anchor and such a group a table holds the sums of all 256 subsets of its eight components. A plane's share
of a score is then one look-up for each group, indexed by the candidate's byte; planes are added from the sign bit down, each
time shifting what is there by one bit.

Anchors and candidates are dealt into blocks of bounded size, and every block of anchors meets every block of candidates, in a
task of its own: the table of scores is large, but no task holds more than two blocks. First the candidates with the anchor's
label are scored and give the positives; then those with other labels are, against the bands that the positives' scores set.
Every pair of an anchor and a row is scored once. Each task gives a few rows for each anchor, of which a window with a limit
on its groups keeps the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.common import stored

#: Rows of a block of candidates and of anchors, on average; anchors scored at once, whose tables fit a core's cache.
CANDIDATES, ANCHORS, AT_ONCE = 4096, 1024, 64
#: Dimensions of a group.
GROUP = 8


def _pack(dims: int, bits: int, scale: float):
    """Rows (id, label, anchor, planes): bits x groups bytes, the lowest plane first. Missing dimensions are 0."""
    groups = -(-dims // GROUP)

    def run(batches):
        for batch in batches:
            vectors = batch.column(3)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale).astype(np.int64)
            parts = np.zeros((len(sizes), groups * GROUP), np.int64)
            parts[np.arange(parts.shape[1]) < sizes[:, None]] = flat
            planes = (parts[:, None, :] >> np.arange(bits)[:, None]) & 1
            packed = np.packbits(planes.astype(np.uint8), axis=2, bitorder="little").reshape(len(sizes), -1)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array([p.tobytes() for p in packed], pa.binary())], ["id", "label", "anchor", "planes"])

    return run


def _planes(column: pa.ChunkedArray, bits: int) -> np.ndarray:
    """rows x bits x groups."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return raw.reshape(len(column), bits, -1)


def _components(planes: np.ndarray) -> np.ndarray:
    """The integers, in two's complement, that the planes hold: rows x dimensions."""
    bits = planes.shape[1]
    weights = np.left_shift(1, np.arange(bits), dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("rbd,b->rd", np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64), weights)


def subset_sums(parts: np.ndarray) -> np.ndarray:
    """For each group of eight dimensions the sums of all subsets of them: groups x 256 x anchors."""
    n, dims = parts.shape
    table = np.zeros((dims // GROUP, 1 << GROUP, n), np.int64)
    for d in range(dims):
        half = 1 << (d % GROUP)
        table[d // GROUP, half : 2 * half] = table[d // GROUP, :half] + parts[:, d]
    return table


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Candidates x anchors: inner products, by look-ups of bytes and shifts."""
    total = np.zeros((len(planes), tables.shape[2]), np.int64)
    for b in reversed(range(planes.shape[1])):
        share = tables[0][planes[:, b, 0]]
        for g in range(1, len(tables)):
            share += tables[g][planes[:, b, g]]
        total = -share if b == planes.shape[1] - 1 else (total << 1) + share
    return total


def _by_label(anchors: pa.Table, rows: pa.Table, bits: int, same: bool):
    """Yields (places of anchors, places of rows by id, scores) for anchors of one label and the rows with it, or with others."""
    if not anchors.num_rows or not rows.num_rows:
        return
    of = anchors["label"].to_numpy()
    rows_of, ids = rows["label"].to_numpy(), rows["id"].to_numpy()
    in_order = np.argsort(ids, kind="stable")
    parts, planes = _components(_planes(anchors["planes"], bits)), _planes(rows["planes"], bits)
    for label in np.unique(of):
        chosen = in_order[(rows_of[in_order] == label) == same]
        at = np.flatnonzero(of == label)
        for lo in range(0, len(at) if len(chosen) else 0, AT_ONCE):
            some = at[lo : lo + AT_ONCE]
            yield some, chosen, scores(subset_sums(parts[some]), planes[chosen])


def _first(score: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest allowed scores, in order; equal ones by place."""
    at = np.flatnonzero(allowed)
    if len(at) > most:
        least = np.partition(score[at], len(at) - most)[len(at) - most]
        above, equal = at[score[at] > least], at[score[at] == least]
        at = np.concatenate([above, equal[: most - len(above)]])
    return at[np.lexsort((at, -score[at]))]


def _positives(bits: int, most: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        for some, chosen, score in _by_label(anchors, rows, bits, same=True):
            ids = rows["id"].to_numpy()[chosen]
            for k, a in enumerate(some):
                own = anchors["id"][int(a)].as_py()
                out += [(own, int(ids[j]), int(score[j, k])) for j in _first(score[:, k], ids != own, most)]
        return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(("anchor_id", "positive_id", "positive_score"))})

    return run


def _negatives(bits: int, most: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int, int]] = []
        for some, chosen, score in _by_label(anchors, rows, bits, same=False):
            ids = rows["id"].to_numpy()[chosen]
            for k, a in enumerate(some):
                own, s = anchors["id"][int(a)].as_py(), score[:, k]
                for p in anchors["positives"][int(a)].as_py():
                    within = (low * p["score"] <= 100 * s) & (100 * s <= high * p["score"])
                    out += [(own, p["id"], p["score"], int(ids[j]), int(s[j])) for j in _first(s, within, most)]
        return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))})

    return run


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, fn, schema: str) -> DataFrame:
    """fn(block of anchors, block of rows) for every two blocks."""
    deal = lambda n, of, size: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(max(1, -(-of // size)))).cast("int")
    all_of = lambda of, size: F.explode(F.sequence(F.lit(0), F.lit(max(1, -(-of // size)) - 1)))
    left = anchors.select("*", deal(1, n_anchors, ANCHORS).alias("i"), all_of(n_rows, CANDIDATES).alias("j"))
    right = rows.select("*", deal(2, n_rows, CANDIDATES).alias("j"), all_of(n_anchors, ANCHORS).alias("i"))
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(fn, schema)


def hard_negatives(vectors: DataFrame, anchor: Column, scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    vectors has an id, a label and an array of numbers; a row for which `anchor`, a condition on columns of vectors, holds is
    an anchor. Components become floor(scale * x). The score of a row is its integer inner product with the anchor; higher
    ones come first, equal ones by smaller id. An anchor's positives are the first `positives` other rows of its label. Each
    positive gets the first `negatives` rows of other labels with low % to high % of its score, numbered from 1 by rank.
    Fewer are given where there are fewer; no positive, no rows.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. An empty vector scores 0, a
    shorter one counts as filled up with zeros. Of rows that repeat an id one takes part, the one with the smallest label, then
    vector. Components so large that a score would not fit 62 bits raise a ValueError. Extra columns are ignored; an empty
    table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False))))  # NaN is above all
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.label", "r.anchor", "r.v")
    rows = stored(rows, "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("dims"), F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).first()
    dims = max(1, facts.dims or 0)
    largest = max(-np.floor(scale * (facts.lo or 0.0)), np.floor(scale * (facts.hi or 0.0)) + 1, 1.0)
    bits = int(np.ceil(np.log2(largest))) + 1
    if 2 * bits + int(dims).bit_length() + 8 > 62:
        raise ValueError(f"components up to {largest:g} are too large for exact scores")
    packed = stored(rows.mapInArrow(_pack(dims, bits, scale), "id long, label long, anchor boolean, planes binary"), "planes")
    anchors, candidates = packed.where("anchor").select("id", "label", "planes"), packed.select("id", "label", "planes")
    near = _met(anchors, candidates, facts.anchors, facts.n, _positives(bits, positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    best = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))  # a few each
    asked = stored(anchors.join(best, "id"), "anchors")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _met(asked, candidates, facts.anchors, facts.n, _negatives(bits, negatives, low, high), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    out = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
