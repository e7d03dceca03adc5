"""Quality score from compressed sizes under two zstandard dictionaries, one built from good and one from bad labelled text.

A text is cut into pieces of PIECE bytes; each piece is compressed with either dictionary. The difference of the two total
sizes, divided by the text's bytes, goes through a logistic curve fitted on labelled rows that neither dictionary has seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE, LEVEL, DICTIONARY_BYTES = 1000, 3, 1 << 16
#: The bounded training sample: documents for each dictionary, pieces from each of them, documents for the curve.
DICTIONARY_DOCS, DOC_PIECES, CURVE_DOCS = 1500, 4, 6000
#: Labelled rows whose crc32(doc_id) mod 4 is this are held out and never learned from; CURVE_FOLD fits the curve.
HELD_OUT, CURVE_FOLD = 2, 3
THRESHOLD = 0.7


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve's slope and offset. Its size is bounded, so it goes to executors with the function."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, text: Column) -> Column:
        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            z = self.slope * _differences(self.good, self.bad, texts) + self.offset
            return pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))

        return scored(text)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_AUTO if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    given = {"dict_data": zstandard.ZstdCompressionDict(content, dict_type=kind)} if len(content) >= 8 else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **given)


def _differences(good: bytes, bad: bytes, texts: pa.Array) -> np.ndarray:
    """For each text (bytes under `bad` - bytes under `good`) / bytes; 0 for null and empty."""
    with_good, with_bad = _compressor(good), _compressor(bad)
    out = np.zeros(len(texts))
    for row, value in enumerate(pc.fill_null(texts, "").cast(pa.large_binary())):
        raw = memoryview(value.as_buffer())
        pieces = [raw[k : k + PIECE] for k in range(0, len(raw), PIECE)]
        if pieces:
            out[row] = sum(len(with_bad.compress(p)) - len(with_good.compress(p)) for p in pieces) / len(raw)
    return out


def _pieces(batches):
    """(quality, pieces): up to DOC_PIECES pieces spread evenly over the text."""
    for batch in batches:
        found = []
        for value in pc.fill_null(batch.column(1), "").cast(pa.large_binary()):
            raw = value.as_py()
            starts = np.arange(0, len(raw), PIECE)
            found.append([raw[k : k + PIECE] for k in starts[np.unique(np.linspace(0, len(starts) - 1, DOC_PIECES).astype(int))]] if len(starts) else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["quality", "pieces"])


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the text itself serves
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method for a one-variable logistic curve with a slight ridge on the slope."""
    scale = float(np.std(x)) or 1.0
    design, beta = np.stack([x / scale, np.ones_like(x)], axis=1), np.zeros(2)
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def train_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learns from labelled rows with a quality of 0 or 1 outside the HELD_OUT fold.

    The sample is bounded: the rows with the smallest hashes of doc_id, at most DICTIONARY_DOCS of each label for the
    dictionaries and CURVE_DOCS for the curve. Without rows of one label the score is the share of the other.
    """
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.where(fold(F.col("doc_id")) != HELD_OUT)
    first = [F.xxhash64("doc_id"), "doc_id", "quality"]
    texts = docs.select("doc_id", "text")

    def sample(rows: DataFrame, n: int) -> DataFrame:
        return texts.join(F.broadcast(rows.orderBy(*first).limit(n)), "doc_id").select("quality", "text")

    basis = known.where(fold(F.col("doc_id")) != CURVE_FOLD)
    chosen = sample(basis.where("quality = 1"), DICTIONARY_DOCS).union(sample(basis.where("quality = 0"), DICTIONARY_DOCS))
    rows = chosen.mapInArrow(_pieces, "quality int, pieces array<binary>").collect()
    good, bad = (_dictionary(sorted(bytes(p) for r in rows if r.quality == q for p in r.pieces)) for q in (1, 0))

    @F.arrow_udf("double")
    def difference(found: pa.Array) -> pa.Array:
        return pa.array(_differences(good, bad, found))

    curve = sample(known.where(fold(F.col("doc_id")) == CURVE_FOLD), CURVE_DOCS).select("quality", difference("text").alias("x")).collect()
    x, y = np.array([r.x for r in curve]), np.array([float(r.quality) for r in curve])
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return QualityModel(good, bad, 0.0, math.log(share / (1 - share)))
    return QualityModel(good, bad, *_logistic(x, y))


def score_quality(docs: DataFrame, model: QualityModel, score_col: str = "score") -> DataFrame:
    """docs with a score from 0 to 1, higher where label 1 is likelier.

    Only the text is looked at. Null and empty texts get the curve's value for a difference of 0. Rows, repeated or not,
    and other columns stay as they are; an empty table stays empty.
    """
    return docs.withColumn(score_col, model.score(F.col("text")))
