"""A training-corpus pipeline: five stages over `documents`, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.llm.bpe_chunks import encode_and_decode
from sparkcast.llm.common import free_name, read_table, stored
from sparkcast.llm.decontamination import find_contamination
from sparkcast.llm.line_dedup import dedup_lines
from sparkcast.llm.ngram_jaccard import ngram_jaccard
from sparkcast.llm.quality_classifier import THRESHOLD, train_quality
from sparkcast.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier does not reject."""
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) >= THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; n_chars follows, if there. A document that loses all lines stays, empty; rows
    that repeat a doc_id count as one document. Other columns keep their values, whatever their names."""
    hidden = {c: free_name(docs, f"_{k}") for k, c in enumerate(docs.columns) if c in ("n_lines", "n_dropped")}
    out = dedup_lines(docs.withColumnsRenamed(hidden)).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in hidden.items()})
    out = out.select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest doc_id. Rows that repeat a doc_id are one
    document and stay or go together; documents without a doc_id stay."""
    first = ngram_jaccard(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*docs.columns).union(docs.where("doc_id is null"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item, and those without a doc_id."""
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, whose decoded text is compared with the text. Columns named token_ids, n_tokens or
    round_trip are replaced."""
    out = encode_and_decode(docs, tokenizer_path(), name=(new := free_name(docs, "encoding")))
    return out.select(
        *(c for c in docs.columns if c not in ("token_ids", "n_tokens", "round_trip")),
        F.col(f"{new}.ids").alias("token_ids"),
        F.size(f"{new}.ids").cast("long").alias("n_tokens"),
        (F.col(f"{new}.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", clean),
    ("BPE encoding and decoding", tokens),
]

#: SQL has no zstandard dictionaries, so tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
