"""Near-duplicate classes by SimHash fingerprints, found by multi-index hashing.

A fingerprint of 64 bits is kept in two tables, one for each half. If two fingerprints differ in at most two bits, their first
halves differ in at most one bit, or their second halves are equal. So a search enumerates the ball of radius 1 around the
first half and the ball of radius 0 around the second, fetches what the tables hold under these values, and verifies whole
distances in the join itself. Of two first halves that differ in a bit, the one without it does the search, so a pair meets
once.

Half values under which a table holds many fingerprints would make pairs in number of their square. Whoever searches such a
value, and whoever is found under it, goes another exact way: both ends enumerate the ball of radius 1 around their whole
fingerprint. Two fingerprints within two bits have a point of it in common, and at most 65 can share a point, so linking each
with the smallest there makes rows in proportion to their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.llm.common import components, stored

#: The seed of the shingles' hashes, the bits of a fingerprint and of its halves.
SEED, BITS, HALF = 42, 64, 32
#: Bits in which linked fingerprints differ at most. The balls above are those for two.
DISTANCE = 2
#: A table's value with more fingerprints than this takes the way by common points.
BUCKET = 32
#: Shingles of a text hashed at once, so that a long text takes no more memory.
CHUNK = 1 << 16


def _ones(text: bytes, size: int) -> tuple[np.ndarray, int]:
    """For each bit, lowest first, how many of the text's shingles have it, and the number of shingles."""
    words = text.lower().split()  # of bytes: A-Z, and white space as in \x20\x09-\x0D
    total = np.zeros(BITS, np.int64)
    if not words:
        return total, 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo : lo + CHUNK], ends[lo : lo + CHUNK], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total, len(starts)


def simhash(text: bytes, size: int = 3) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the shingles' hashes; zero without words."""
    ones, n = _ones(text, size)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(size: int):
    def run(batches):
        for batch in batches:
            # one text at a time: a batch of texts isn't copied as a whole
            prints = [simhash((t.as_py() or "").encode(), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "f"])

    return run


def _halves(f: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(f, HALF), f.bitwiseAND(F.lit((1 << HALF) - 1))


def _second(value: Column) -> Column:
    """Values of the second table get a bit above those of the first."""
    return value.bitwiseOR(F.lit(1 << HALF))


def _links(prints: DataFrame) -> DataFrame:
    """Pairs (u, v) of different fingerprints f that join all within two bits of each other, directly or over others."""
    first, second = _halves(F.col("f"))
    table = prints.select(F.col("f").alias("v"), F.explode(F.array(first, _second(second))).alias("value"))
    unset = F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda k: F.getbit("f", k + HALF) == 0)
    ball = F.transform(unset, lambda k: first.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    searches = prints.select(F.col("f").alias("u"), F.explode(F.concat(ball, F.array(first, _second(second)))).alias("value"))
    sizes = table.groupBy("value").agg(F.count("*").alias("n"))
    many = stored(sizes.where(F.col("n") > BUCKET).select("value"), "many")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE
    if many.isEmpty():
        found = searches.join(table, (searches.value == table.value) & near & (F.col("u") != F.col("v")))
        return found.select("u", "v")
    few = table.join(many, "value", "left_anti").withColumnRenamed("value", "own")
    found = searches.join(few, (F.col("value") == F.col("own")) & near & (F.col("u") != F.col("v"))).select("u", "v")
    crowd = searches.join(many, "value", "left_semi").select(F.col("u").alias("f"))
    crowd = crowd.union(table.join(many, "value", "left_semi").select(F.col("v").alias("f"))).distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.col("f").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    points = crowd.select("f", F.explode(F.concat(flips, F.array("f"))).alias("point"))
    smallest = points.groupBy("point").agg(F.min("f").alias("u"), F.collect_list("f").alias("all")).where(F.size("all") > 1)  # 65 at most
    return found.union(smallest.select("u", F.explode("all").alias("v")).where("u <> v")).distinct()


def simhash_classes(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (doc_id, fingerprint, component_id), one row for each row of docs.

    The fingerprint, 16 hex digits, is over the hashes (XXH64 of UTF-8, seed 42) of all `size`-word shingles of the whole
    text with A-Z lower-cased, repeats included; fewer words are one shingle, a text without words or null has fingerprint
    zero, which links like any other. Fingerprints link if they differ in two bits or fewer; component_id is the smallest
    doc_id reachable by links. Rows that repeat a doc_id are rows of their own. A null doc_id takes no part: its row has a
    fingerprint, but component_id is null. Texts may be of any length. Extra columns are ignored; an empty table gives an
    empty result.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = stored(given.mapInArrow(_fingerprints(size), "doc_id long, f long"), "fingerprints")
    prints = stored(marked.where("doc_id is not null").groupBy("f").agg(F.min("doc_id").alias("x")), "prints")
    links = stored(_links(prints.select("f")), "links")
    found = prints.select("f", F.col("x").alias("component_id"))
    if not links.isEmpty():
        labels = components(links)
        member = prints.join(labels.select(F.col("node").alias("f"), "comp"), "f", "left").withColumn("comp", F.coalesce("comp", "f"))
        least = member.groupBy("comp").agg(F.min("x").alias("component_id"))
        found = member.join(least, "comp").select("f", "component_id")
    out = marked.join(found, "f", "left")
    digits = F.lower(F.lpad(F.hex("f"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
