"""Benchmark items inside documents: size-partitioned MinHash containment search, verified by exact shingle containment.

A short item and a long document have a small Jaccard similarity, so the search is by containment. Items are partitioned by
their number of distinct shingles. An item's sketch is its smallest shingle hashes, as many as its partition needs for a sure
hit: a document with at least `percent` of the item's n shingles misses fewer than the sketch has. Documents are searched for
sketch values, and every candidate pair is decided on the texts themselves. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.llm.common import stored
from sparkcast.llm.sqltext import lowered, positions, word_windows, words

#: Item tables go to every task only if they have at most this many rows; larger ones are shuffled.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _missed(n: Column, percent: int) -> Column:
    """Most shingles that a document with `percent` of n may lack."""
    return n - F.ceil(n * percent / 100 - F.lit(1e-9))


def find_contamination(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Returns (doc_id, item_id, n_shingles, n_found, containment) for every pair with containment of percent / 100 or more.

    Shingles are `size` words, A-Z lower-cased; an item of fewer words is one shingle of all its words. Containment is the
    share of an item's distinct shingles found in the document. Items and documents that are null, empty or without words
    match nothing. Rows that repeat an id are one document or item, holding the shingles of all their texts. Null ids take no
    part. Extra columns are ignored; an empty table on either side gives an empty result.
    """
    item_words = items.where("item_id is not null").select("item_id", words(lowered(F.col("text"))).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(size))
    shingles = item_words.select("item_id", length.alias("len"), F.explode(F.transform(positions(F.size("w") - length + 1), lambda i: F.slice("w", i + 1, length))).alias("s"))
    shingles = stored(shingles.select("item_id", "len", F.array_join("s", " ").alias("shingle")).distinct(), "shingles")
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    partition = F.floor(F.log2("n_shingles"))
    sketch_size = 1 + _missed(F.pow(F.lit(2.0), partition + 1) - 1, percent)
    parts = shingles.select("item_id", "len", F.split("shingle", " ").alias("p"))
    # the same function of words as for documents, for each length of shingle that occurs
    lengths = sorted(r[0] for r in shingles.select("len").distinct().collect())
    hashes = None
    for k in lengths:
        own = parts.where(F.col("len") == k).select("item_id", "len", F.explode(word_windows(F.col("p"), k)).alias("h")).distinct()
        hashes = own if hashes is None else hashes.union(own)
    doc_words = docs.where("doc_id is not null").select("doc_id", words(lowered(F.col("text"))).alias("w"))
    if hashes is None:
        return docs.select("doc_id").join(items.select("item_id"), F.lit(False)).select("doc_id", "item_id", *(F.lit(0).cast(t).alias(c) for c, t in (("n_shingles", "long"), ("n_found", "long"), ("containment", "double"))))
    ranked = hashes.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("h", "len"))).alias("all")).join(sizes, "item_id")
    sketch = ranked.select("item_id", F.explode(F.slice("all", 1, sketch_size.cast("int"))).alias("e")).select("item_id", "e.h", "e.len")
    sketch = stored(sketch, "sketch")

    found = None
    for k in lengths:
        seen = doc_words.select("doc_id", F.explode(word_windows(F.col("w"), k)).alias("h"))
        hits = seen.join(_small(sketch.where(F.col("len") == k).select("item_id", "h")), "h").select("doc_id", "item_id")
        found = hits if found is None else found.union(hits)
    pairs = stored(found.distinct(), "candidates")

    chosen = docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", words(lowered(F.col("text"))).alias("w"))
    plain = chosen.select("doc_id", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("plain"))
    lists = shingles.groupBy("item_id").agg(F.collect_list("shingle").alias("shingles"))
    met = plain.join(pairs, "doc_id").join(_small(lists), "item_id")
    met = met.select("doc_id", "item_id", F.size("shingles").cast("long").alias("n_shingles"), F.filter("shingles", lambda s: F.contains(F.col("plain"), F.concat(F.lit(" "), s, F.lit(" ")))).alias("in"))
    out = met.groupBy("doc_id", "item_id", "n_shingles").agg(F.size(F.array_distinct(F.flatten(F.collect_list("in")))).cast("long").alias("n_found"))
    out = out.where(F.col("n_found") * 100 >= F.col("n_shingles") * percent)
    return out.withColumn("containment", F.col("n_found") / F.col("n_shingles"))
