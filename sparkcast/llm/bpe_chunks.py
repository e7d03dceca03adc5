"""Byte-level BPE with content-defined chunk reuse.

A rolling hash over 16 bytes cuts texts into chunks where the content says so, so passages that documents share fall into
equal chunks. The chunks that save most, by copies and length, are encoded once and given to all tasks as a dictionary of
bounded size; what lies between them is encoded in place. Tokens at a join of two pieces may be wrong: the join is encoded
again, from a place in the left piece to one in the right, further and further until both ends agree with the pieces' own
tokens. Such places lie between a visible character and white space, where the pre-tokenizer always splits, so agreement
there means that the result is exactly that of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.bytetext import SPACE, span_hashes, text_slices

WINDOW, CHUNK_BYTES = 16, 1024
#: The dictionary's bounds: chunks, and bytes of each. It is 16 MB of text in the mean and 64 MB at most.
DICTIONARY_CHUNKS, MAX_CHUNK_BYTES = 16384, 4096
#: Fixed value: the pre-tokenizer pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts with a longer run of white space or of other bytes are encoded by the tokenizers library: tiktoken's pattern
#: backtracks over white space, and its merging takes quadratic time on one very long word.
LONG_RUN = 10_000
_SAFE = re.compile(rb"[!-~](?=[ \n])")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes as visible letters: printable bytes stand for themselves, others follow 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    """Encodes and decodes as the tokenizers library does with the file, without added special tokens."""

    def __init__(self, path: str):
        self.path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        if any(vocab[m.replace(" ", "", 1)] != 256 + k for k, m in enumerate(merges)):
            raise ValueError(f"{path}: merges are not in the order of ids")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): k for token, k in vocab.items() if token not in special}
        self._special, self._encoding = set(special), tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.lengths = np.zeros(max(*ranks.values(), *special.values()) + 1, np.int64)
        for token, k in [*ranks.items(), *((s.encode(), k) for s, k in special.items())]:
            self.lengths[k] = len(token)

    def encode(self, raw: bytes) -> list[int]:
        try:
            return self._encoding.encode(raw.decode(), allowed_special=self._special, disallowed_special=()) if raw else []
        except ValueError:  # too much to backtrack over
            return self.encode_long(raw)

    def encode_long(self, raw: bytes) -> list[int]:
        """The same by the tokenizers library, which is slower but takes texts of any kind."""
        if self._library is None:
            self._library = tokenizers.Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library.encode(raw.decode(), add_special_tokens=False).ids

    def decode(self, ids) -> str:
        return self._encoding.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(2)
def load(path: str) -> Bpe:
    return Bpe(path)


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each document of a slice its chunks' bounds, from its start to its end."""
    if len(data) > WINDOW:
        at = np.arange(len(data) - WINDOW)
        cut = at[span_hashes(data, at, at + WINDOW, 1) % np.uint64(CHUNK_BYTES) == 0] + WINDOW
        cut = cut[(data[cut] & 0xC0) != 0x80]
        doc = np.searchsorted(offsets, cut, "right") - 1
        cut = cut[cut - offsets[doc] >= WINDOW]
    else:
        cut = np.zeros(0, np.int64)
    lo, hi = np.searchsorted(cut, offsets[:-1], "right"), np.searchsorted(cut, offsets[1:], "left")
    return [np.concatenate([[a], cut[i:j], [b]]) for a, b, i, j in zip(offsets[:-1], offsets[1:], lo, hi, strict=True)]


def has_long_run(data: np.ndarray) -> bool:
    edges = np.flatnonzero(SPACE[data[1:]] != SPACE[data[:-1]]) if len(data) > LONG_RUN else ()
    return len(data) > LONG_RUN and bool(np.diff(np.concatenate([[-1], edges, [len(data) - 1]])).max() > LONG_RUN)


def _key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _chunks(texts: pa.Array):
    """(document in the batch, chunk) of every chunk of a bearable length."""
    for lo, data, offsets in text_slices(texts):
        raw = data.tobytes()
        for d, bounds in enumerate(chunk_bounds(data, offsets)):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if WINDOW <= b - a <= MAX_CHUNK_BYTES:
                    yield lo + d, raw[a:b]


def _chunk_keys(batches):
    for batch in batches:
        keys, sizes = [], []
        for _, chunk in _chunks(batch.column(0)):
            keys.append(_key(chunk))
            sizes.append(len(chunk))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())], ["key", "bytes"])


def _chosen_chunks(wanted):
    def run(batches):
        left = set(wanted.value)
        for batch in batches:
            found = {}
            for _, chunk in _chunks(batch.column(0)):
                if (key := _key(chunk)) in left:
                    left.discard(key)
                    found[key] = chunk
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["key", "chunk"])

    return run


def _encoded_chunks(path: str):
    def run(batches):
        bpe = load(path)
        for batch in batches:
            ids = [np.array(bpe.encode(c), np.int32).tobytes() for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    return run


def shared_chunks(docs: DataFrame, path: str) -> dict[bytes, bytes]:
    """The dictionary: keys and packed ids of the repeated chunks that save most."""
    texts = docs.select("text")
    counts = texts.mapInArrow(_chunk_keys, "key binary, bytes int").groupBy("key").agg(F.count("*").alias("n"), F.first("bytes").alias("bytes"))
    best = counts.where("n > 1").orderBy(((F.col("n") - 1) * F.col("bytes")).desc(), "key").limit(DICTIONARY_CHUNKS)
    wanted = {bytes(r.key) for r in best.select("key").collect()}
    if not wanted:
        return {}
    given = docs.sparkSession.sparkContext.broadcast(wanted)
    once = texts.mapInArrow(_chosen_chunks(given), "key binary, chunk binary").groupBy("key").agg(F.first("chunk").alias("chunk"))
    return {bytes(r.key): bytes(r.ids) for r in once.mapInArrow(_encoded_chunks(path), "key binary, ids binary").collect()}


class _Piece:
    """A span of a text, with its tokens and their ends in the text if it came from the dictionary."""

    def __init__(self, bpe: Bpe, start: int, end: int, ids: np.ndarray | None):
        self.start, self.end, self.ids, self._safe = start, end, ids, None
        self.ends = None if ids is None else start + np.cumsum(bpe.lengths[ids])

    def safe(self, raw: bytes) -> list[int]:
        """Its safe places, found once."""
        if self._safe is None:
            self._safe = [] if self.ids is None else [m.end() for m in _SAFE.finditer(raw, self.start, self.end)]
        return self._safe

    def tokens(self, a: int, b: int) -> np.ndarray | None:
        """Its tokens from a to b, if both are ends of tokens."""
        i, j = (0 if x == self.start else int(np.searchsorted(self.ends, x)) + 1 for x in (a, b))
        if (i and self.ends[i - 1] != a) or (j and self.ends[j - 1] != b):
            return None
        return self.ids[i:j]


def encode_document(bpe: Bpe, raw: bytes, bounds, known) -> list[int]:
    """ids of raw. bounds: its chunks' bounds; known(chunk) gives a chunk's ids or None."""
    pieces: list[_Piece] = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        ids = known(raw[a:b]) if WINDOW <= b - a <= MAX_CHUNK_BYTES else None
        if ids is None and pieces and pieces[-1].ids is None:
            pieces[-1].end = int(b)
        else:
            pieces.append(_Piece(bpe, int(a), int(b), ids))
    out: list[int] = []
    done, k = 0, 0  # tokens are right up to `done`, which is the text's start or a safe place in pieces[k]
    while k < len(pieces):
        piece = pieces[k]
        safe = piece.safe(raw)
        safe = safe[bisect_right(safe, done) :]
        if k + 1 == len(pieces):
            own = piece.tokens(done, piece.end) if piece.ids is not None else None
            return out + (bpe.encode(raw[done:]) if own is None else own.tolist())
        # the join with the next piece: from a place in this one (or from `done`) to one in a following one
        n = 1
        while True:
            left = safe[-n] if n <= len(safe) else done
            before = safe[-n - 1] if n < len(safe) else None
            head = piece.tokens(done, left) if left > done else []
            check = piece.tokens(before, left) if before is not None else []
            after, j, tail = _place_after(raw, pieces, k + 1, n)
            if after is None:  # no place to the right: the rest is one piece
                return out + (head.tolist() if left > done and head is not None else []) + bpe.encode(raw[left if head is not None else done :])
            if head is not None and check is not None:
                start = left if before is None else before
                again = bpe.encode(raw[start : after[1]])
                end = len(again) - len(tail)
                if again[: len(check)] == list(check) and again[end:] == list(tail) and end >= len(check):
                    out += [*map(int, head), *again[len(check) : end]]
                    done, k = after[0], j
                    break
            n += 1


def _place_after(raw: bytes, pieces: list[_Piece], k: int, n: int):
    """The n-th safe place in pieces[k] or, where those are used up or it has no tokens, in a later piece: ((place, next
    place), piece, its tokens between them); (None, ...) if there is none."""
    for j in range(k, len(pieces)):
        if pieces[j].ids is not None:
            safe = pieces[j].safe(raw)
            for m in range(n - 1, len(safe)):
                a, b = safe[m], safe[m + 1] if m + 1 < len(safe) else pieces[j].end
                own = pieces[j].tokens(a, b)
                if b < pieces[j].end and own is not None:
                    return (a, b), j, own.tolist()
            n = 1
    return None, None, None


def _round_trip(path: str, dictionary):
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        bpe, shared = load(path), dictionary.value

        def known(chunk: bytes):
            ids = shared.get(_key(chunk))
            return None if ids is None else np.frombuffer(ids, np.int32)

        ends, flat, decoded = [0], [], []
        for _, data, offsets in text_slices(texts):
            raw = data.tobytes()
            for bounds in chunk_bounds(data, offsets):
                text = raw[bounds[0] : bounds[-1]]
                long = has_long_run(data[bounds[0] : bounds[-1]])
                ids = bpe.encode_long(text) if long else encode_document(bpe, text, bounds - bounds[0], known)
                flat.append(np.array(ids, np.int32))
                ends.append(ends[-1] + len(ids))
                decoded.append(bpe.decode(ids))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
        return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], ["ids", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, path: str, text: Column | None = None, name: str = "encoding") -> DataFrame:
    """docs with `encoding` (or another name), a struct of `ids` (array of int) and `decoded` (the text that the ids decode to).

    Ids are those of the tokenizers library with the file at `path`, which all executors must have, and add_special_tokens
    off: special tokens' strings in a text become their ids. A null text counts as empty and gives no ids and an empty text.
    Texts may be of any length; one with a run of more than LONG_RUN bytes of white space, or without any, is encoded by that
    library as a whole. Other columns (but one of the new name, which is replaced) and repeated rows stay; an empty table stays
    empty.
    """
    source = docs.withColumn("text", text) if text is not None else docs
    dictionary = docs.sparkSession.sparkContext.broadcast(shared_chunks(source, path))
    return docs.withColumn(name, _round_trip(path, dictionary)(text if text is not None else F.col("text")))
