"""Exact removal of repeated byte strings, with suffix arrays built by linear grouping.

A byte goes if a string of LENGTH bytes that covers it also starts earlier in the corpus. Every such string has one anchor:
the place of the smallest hash among its GRAM-byte substrings. Equal strings have equal anchors at equal places, so strings
need to be compared with those of the same anchor gram only. The strings of one anchor in one document overlap; together
they are the anchor's context of at most 2 * LENGTH - GRAM bytes.

1. Equal contexts of equal grams: all but the first are covered. This is decided within batches and then by one shuffle.
2. Grams with different contexts: contexts are cut to the range of their strings whose hash another context of the gram has,
   and those that have none are left out, as are later copies of what is left, which are covered. The rest is put side by
   side, in blocks, and its suffixes are sorted: suffixes with LENGTH equal bytes are neighbours then, and all but the first
   in the corpus are covered. Grams with very many contexts are dealt over several blocks, and the classes found in each
   block meet in an aggregate.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.bytetext import span_hashes, text_slices
from sparkcast.llm.common import free_name, mix64, stored

LENGTH, GRAM = 100, 32
_SPREAD = LENGTH - GRAM + 1  # places for a gram in a string
#: Bytes of contexts whose suffixes are sorted together; grams with more contexts than HOT are dealt over SALTS parts.
BLOCK_BYTES, HOT, SALTS = 1 << 16, 20_000, 1024
#: Rows of contexts that are filtered together, unless one gram has more.
CONTEXT_ROWS = 1 << 14
_POSITION_BITS = 26


def suffix_array(text: bytes) -> list[int]:
    """Suffix array by linear grouping (Baier 2016), in two phases and without recursion.

    Phase 1 refines groups of suffixes until a group holds the suffixes with one Lyndon prefix. Groups are taken in descending
    order; each of their suffixes points to the nearest suffix before it in a smaller group, and suffixes are moved to a new
    group just above their own by how many pointers they get. Phase 2 goes over the array as it fills, and puts the suffixes
    on the chain of pointers before each entry at the next free place of their groups.
    """
    n = len(text) + 1
    letters = np.zeros(n, np.int64)
    letters[:-1] = np.frombuffer(text, np.uint8)
    letters[:-1] += 1  # 0 ends the text
    order = np.argsort(letters, kind="stable")
    sorted_letters = letters[order]
    starts = np.searchsorted(sorted_letters, letters)
    bucket = np.flatnonzero(np.concatenate([[True], sorted_letters[1:] != sorted_letters[:-1]]))
    group, sa = starts.tolist(), order.tolist()
    place = [0] * n
    for k, i in enumerate(sa):
        place[i] = k
    end = dict(zip(bucket.tolist(), [*bucket[1:].tolist(), n], strict=True))
    before = [-1] * n

    top = n
    while top:
        here = group[sa[top - 1]]
        pointed: dict[int, int] = {}
        for i in sa[here:top] if top - here == 1 else sorted(sa[here:top]):
            j = i - 1
            while j >= 0 and group[j] >= here:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for j, count in pointed.items():
                by_count.setdefault(count, []).append(j)
            for count in sorted(by_count, reverse=True):
                tails: dict[int, int] = {}
                for j in by_count[count]:
                    g = group[j]
                    t = tails.get(g, end[g]) - 1
                    tails[g] = t
                    k, other = place[j], sa[t]
                    sa[k], sa[t], place[other], place[j] = other, j, k, t
                for g, t in tails.items():
                    if t != g:
                        end[t] = end[g]
                        end[g] = t
                        for k in range(t, end[t]):
                            group[sa[k]] = t
        top = here

    out, free, done = [-1] * n, {}, bytearray(n)
    out[0], done[n - 1] = n - 1, 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            at = free.get(g, g)
            out[at], free[g], done[j] = j, at + 1, 1
            j = before[j]
    return out[1:]


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor place, first and last start of its strings, and document, for all anchors of a slice."""
    n = len(data) - GRAM + 1
    if n < _SPREAD:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at = np.arange(n)
    rank = span_hashes(data, at, at + GRAM, 2) >> np.uint64(_POSITION_BITS)
    if n < 1 << _POSITION_BITS:  # smallest rank, then first place, in one number
        least, width = (rank << np.uint64(_POSITION_BITS)) | at.astype(np.uint64), 1
        while width * 2 <= _SPREAD:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if width < _SPREAD:
            least = np.minimum(least[: n - _SPREAD + 1], least[_SPREAD - width : n - width + 1])
        first = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    else:
        first, width = at, 1

        def smaller(a, b):
            return np.where(rank[b] < rank[a], b, a)

        while width * 2 <= _SPREAD:
            first, width = smaller(first[:-width], first[width:]), width * 2
        if width < _SPREAD:
            first = smaller(first[: n - _SPREAD + 1], first[_SPREAD - width : n - width + 1])
    start = np.arange(len(first))
    doc = np.searchsorted(offsets, start, "right") - 1
    whole = start + LENGTH <= offsets[doc + 1]
    start, first, doc = start[whole], first[whole], doc[whole]
    new = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
    last = np.concatenate([new[1:], [len(first)]]) - 1 if len(first) else new
    return first[new], start[new], start[last], doc[new]


def _contexts(texts: pa.Array):
    """Per slice: first row, bytes, offsets and arrays gram, context, and in the document the gram's place, the first and the
    last start of a string; and the document."""
    for lo, data, offsets in text_slices(texts):
        place, first, last, doc = anchors(data, offsets)
        if len(place):
            gram = span_hashes(data, place, place + GRAM, 2)
            context = mix64(span_hashes(data, first, last + LENGTH, 2) + mix64((place - first).astype(np.uint64)))
            start = offsets[doc]
            yield lo, data, offsets, gram.view(np.int64), context.view(np.int64), place - start, first - start, last - start, doc


def _firsts(gram, context, ids, first) -> np.ndarray:
    """Which rows come first in (document, place) among those with their gram and context."""
    order = np.lexsort((first, ids, context, gram))
    g, c = gram[order], context[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    out = np.zeros(len(g), bool)
    out[order[new]] = True
    return out


def _merged(ids: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Spans [a, b) of documents, with overlapping and touching ones joined."""
    order = np.lexsort((a, ids))
    ids, a, b = ids[order], a[order], b[order]
    out: list[list[int]] = []
    for d, x, y in zip(ids.tolist(), a.tolist(), b.tolist(), strict=True):
        if out and out[-1][0] == d and x <= out[-1][2]:
            out[-1][2] = max(out[-1][2], y)
        else:
            out.append([d, x, y])
    return out


_ROWS = "gram long, part int, context long, doc long, first int, last int, covered boolean"


def _anchor_rows(batches):
    """Rows for contexts that come first in their batch, and the spans of the others, which are covered.

    Contexts of a gram that has several in the batch are dealt over parts, as the gram is known to be mixed; part 0 gets a row
    without document in their place, so that it is known there too.
    """
    for batch in batches:
        parts, ids = [], batch.column(0).to_numpy(zero_copy_only=False)
        for lo, _, _, gram, context, _, first, last, doc in _contexts(batch.column(1)):
            parts.append((gram, context, ids[lo + doc], first, last))
        if not parts:
            continue
        gram, context, doc, first, last = (np.concatenate(p) for p in zip(*parts, strict=True))
        keep = _firsts(gram, context, doc, first)
        spans = np.array(_merged(doc[~keep], first[~keep], last[~keep] + LENGTH), np.int64).reshape(-1, 3)
        gram, context, doc, first, last = (x[keep] for x in (gram, context, doc, first, last))
        grams, own, n = np.unique(gram, return_inverse=True, return_counts=True)
        part = np.where(n[own] > 1, 1 + (context.view(np.uint64) % np.uint64(SALTS)).astype(np.int64), 0)
        mixed = grams[n > 1]
        none, empty = np.zeros(len(spans), np.int64), np.zeros(len(mixed), np.int64)
        columns = [(gram, mixed, none), (part, empty, none), (context, empty, none), (doc, empty, spans[:, 0]), (first, empty, spans[:, 1]), (last, empty, spans[:, 2] - LENGTH)]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        arrays = [pa.array(np.concatenate(c), t) for c, t in zip(columns, types, strict=True)]
        evidence = np.repeat([False, True, False], [len(gram), len(mixed), len(spans)])
        arrays[3] = pa.array(np.concatenate(columns[3]), pa.int64(), mask=evidence)
        covered = np.repeat([False, True], [len(gram) + len(mixed), len(spans)])
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(covered)], ["gram", "part", "context", "doc", "first", "last", "covered"])


def _context_bytes(batches):
    """(gram, salt, doc, first, bytes) of the wanted contexts of documents (doc, text, wanted)."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]

    def batch_of(parts, cut):
        columns = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*parts, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary())], ["gram", "salt", "doc", "first", "bytes"])

    parts, cut = [], []
    for batch in batches:
        for doc, text, wanted in zip(*(batch.column(k) for k in range(3)), strict=True):
            doc, raw, wanted = doc.as_py(), (text.as_py() or "").encode(), wanted.values
            gram, first, last = (wanted.field(c).to_numpy() for c in ("gram", "first", "last"))
            cut += (raw[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist(), strict=True))
            salt = wanted.field("hot").to_numpy(zero_copy_only=False) * (1 + int(mix64(np.array([doc]).view(np.uint64))[0] % np.uint64(SALTS)))
            parts.append((gram, salt, np.full(len(gram), doc, np.int64), first))
            if len(cut) >= CONTEXT_ROWS:
                yield batch_of(parts, cut)
                parts, cut = [], []
    if cut:
        yield batch_of(parts, cut)


_FOUND = "doc long, first int, last int, string binary"


def _found(spans, heads=()):
    """Rows of spans (doc, first, last), and of classes' earliest members (doc, first, string)."""
    doc, first, last = (np.concatenate([s, [h[k] for h in heads]]).astype(np.int64) for s, k in zip(spans, (0, 1, 1), strict=True))
    strings = [None] * len(spans[0]) + [hashlib.blake2b(h[2], digest_size=16).digest() for h in heads]
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(strings, pa.binary())], ["doc", "first", "last", "string"])


def _sorted_block(block, open_block: bool):
    """Spans covered within a block of rows (doc, first, bytes), by the order of its suffixes; for a block of a gram that has
    other blocks also each class's earliest member with its string."""
    docs, firsts, raws = zip(*block, strict=True)
    spans, heads = [], []
    lengths = [len(r) + 1 for r in raws]
    start = np.concatenate([[0], np.cumsum(lengths)])
    text = b"".join(r + b"\x00" for r in raws)
    owner = np.repeat(np.arange(len(raws)), lengths)
    left = start[owner + 1] - 1 - np.arange(len(text))
    sa = np.array(suffix_array(text))
    run: list[int] = []

    def close():
        if len(run) > 1 or (run and open_block):
            places = sorted((docs[owner[i]], firsts[owner[i]] + i - int(start[owner[i]])) for i in run)
            spans.extend(places[1:])
            if open_block:
                heads.append((*places[0], text[run[0] : run[0] + LENGTH]))

    for i in sa[left[sa] >= LENGTH].tolist():
        if run and text[i : i + LENGTH] != text[run[0] : run[0] + LENGTH]:
            close()
            run.clear()
        run.append(i)
    close()
    where = np.array(spans, np.int64).reshape(-1, 2)
    found = np.array(_merged(where[:, 0], where[:, 1], where[:, 1] + LENGTH), np.int64).reshape(-1, 3)
    return _found((found[:, 0], found[:, 1], found[:, 2] - LENGTH), heads)


def _first_of_equal(group, mark, size, doc, first):
    """For each row whether it comes first in (doc, first) among those with its group, mark and size."""
    order = np.lexsort((first, doc, size, mark, group))
    g, m, s = group[order], mark[order], size[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (m[1:] != m[:-1]) | (s[1:] != s[:-1])
    out = np.zeros(len(g), bool)
    out[order[new]] = True
    return out


def _shared_range(data, start, end, group):
    """For each context data[start:end] the first and last start of a string that another context of its group has; first is
    -1 where there is none."""
    n = np.maximum(end - start - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(start)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = start[owner] + at
    marks = mix64(span_hashes(data, place, place + LENGTH, 2) + group[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(marks)
    same = marks[order][1:] == marks[order][:-1]
    shared = np.zeros(len(marks), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    lo, hi = np.full(len(start), LENGTH * 2), np.full(len(start), -1)
    np.minimum.at(lo, owner[shared], at[shared])
    np.maximum.at(hi, owner[shared], at[shared])
    return np.where(hi < 0, -1, lo), hi


def _compared(block_bytes: int):
    """Over rows (gram, salt, doc, first, bytes) sorted by gram and salt: covered spans, and heads of classes (see _found)."""

    def run(batches):
        block, size = [], 0

        def whole_groups():
            """The rows in tables that end where a group ends, unless the group is a part of a gram that is dealt over several."""
            held = []
            for batch in batches:
                g, s = (batch.column(k).to_numpy() for k in (0, 1))
                if not len(g):
                    continue
                new = np.flatnonzero((g[1:] != g[:-1]) | (s[1:] != s[:-1])) + 1
                if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (g[0], s[0]):
                    new = np.concatenate([[0], new])
                if len(new) and sum(b.num_rows for b in held) + new[-1] >= CONTEXT_ROWS:
                    yield pa.Table.from_batches([*held, batch.slice(0, new[-1])]).combine_chunks()
                    held = [batch.slice(new[-1])]
                else:
                    held.append(batch)
                if held[-1].column(1)[-1].as_py() and sum(b.num_rows for b in held) >= CONTEXT_ROWS:  # a dealt gram's parts may be split
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
            if held:
                yield pa.Table.from_batches(held).combine_chunks()

        for table in whole_groups():
            gram, salt, doc, first = (table.column(k).to_numpy() for k in range(4))
            raw = table.column(4).combine_chunks().cast(pa.large_binary())
            raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
            group = np.concatenate([[0], np.cumsum((gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1]))])

            def settle(lo, hi, rows):
                """Cuts rows to the strings from lo to hi; equal ones but the first are covered, the others come back."""
                a, b = start[rows] + lo, start[rows] + hi + LENGTH
                own = _first_of_equal(group[rows], span_hashes(data, a, b, 2), b - a, doc[rows], first[rows] + lo)
                return own, _found((doc[rows][~own], (first[rows] + lo)[~own], (first[rows] + hi)[~own]))

            # equal contexts that the first step did not bring together, then those of closed groups by what they share
            lo, hi = np.zeros(len(gram), np.int64), end - start - LENGTH
            rows = np.flatnonzero(hi >= 0)
            own, covered = settle(lo[rows], hi[rows], rows)
            yield covered
            rows = rows[own]
            closed = rows[salt[rows] == 0]
            for turn in range(2):  # what is left after equal ones went may share nothing
                a, b = _shared_range(data, start[closed] + lo[closed], start[closed] + hi[closed] + LENGTH, group[closed])
                closed, a, b = closed[a >= 0], a[a >= 0], b[a >= 0]
                hi[closed] = lo[closed] + b
                lo[closed] += a
                if turn == 0:
                    own, covered = settle(lo[closed], hi[closed], closed)
                    yield covered
                    closed = closed[own]
            many = np.bincount(group[closed], (hi - lo + LENGTH)[closed], group[-1] + 1) > block_bytes
            text = data.tobytes()
            cut = lambda k: (int(doc[k]), int(first[k] + lo[k]), text[start[k] + lo[k] : start[k] + hi[k] + LENGTH])  # noqa: B023, E731
            for k in closed[~many[group[closed]]]:
                if size >= block_bytes and group[k] != last_group:
                    yield _sorted_block(block, False)
                    block, size = [], 0
                block.append(cut(k))
                size += len(block[-1][2])
                last_group = group[k]
            if block:
                yield _sorted_block(block, False)
                block, size = [], 0
            # groups dealt over several blocks
            for k in np.concatenate([closed[many[group[closed]]], rows[salt[rows] > 0]]):
                block.append(cut(k))
                size += len(block[-1][2])
                if size >= block_bytes:
                    yield _sorted_block(block, True)
                    block, size = [], 0
            if block:
                yield _sorted_block(block, True)
                block, size = [], 0

    return run


_RESULT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])


@F.arrow_udf(_RESULT)
def _cut(texts: pa.Array, firsts: pa.Array, ends: pa.Array) -> pa.Array:
    kept, kept_sizes, columns = [], [], [[], [], []]
    for lo, data, offsets in text_slices(texts):
        rows, sizes = len(offsets) - 1, np.diff(offsets)
        a, b = firsts.slice(lo, rows), ends.slice(lo, rows)
        own = np.repeat(np.arange(rows), pc.fill_null(pc.list_value_length(a), 0).to_numpy())
        edge = np.zeros(len(data) + 1, np.int64)
        # rows that repeat a doc_id may be shorter than the text that the spans are of
        np.add.at(edge, offsets[own] + np.minimum(a.flatten().to_numpy(), sizes[own]), 1)
        np.add.at(edge, offsets[own] + np.minimum(b.flatten().to_numpy(), sizes[own]), -1)
        gone = np.cumsum(edge)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = offsets[:-1][sizes > 0]
        begins[edges] = gone[edges]
        of = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        for column, value in zip(columns, (sizes, of(gone), of(begins)), strict=True):
            column.append(value)
        kept.append(data[~gone])
        kept_sizes.append(sizes - columns[1][-1])
    flat = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
    bounds = np.concatenate([[0], np.cumsum(flat(kept_sizes, np.int64))])
    raw = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat(kept, np.uint8))])
    return pa.StructArray.from_arrays([raw.cast(pa.binary()), *(pa.array(flat(c, np.int64)) for c in columns)], ["kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with `dedup`, a struct of kept (bytes that stay), n_bytes, n_removed and n_spans (maximal removed runs).

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of LENGTH bytes covering it also starts earlier: in a smaller
    doc_id, or before it in the same text. Strings never cross texts and are judged on the input. doc_id should be unique:
    rows that repeat one are taken as the same text, cut alike. A null doc_id counts as before all others. Texts shorter
    than LENGTH stay whole. Other columns stay (a column named dedup is replaced); an empty table stays empty.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    texts = docs.select(key.alias("doc"), "text")
    rows = texts.mapInArrow(_anchor_rows, _ROWS)
    equal = Window.partitionBy("gram", "part", "context").orderBy(F.col("doc").isNull(), "doc", "first")
    open_rows = rows.where("not covered").repartition("gram", "part")
    # a gram is mixed if it has several contexts, or several in one batch (parts above 0, and rows without document)
    of_gram = Window.partitionBy("gram", "part")
    ranked = open_rows.withColumn("n", F.row_number().over(equal))
    kinds = F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).over(of_gram) + F.max(F.when(F.col("doc").isNull(), 1).otherwise(F.col("part"))).over(of_gram)
    several = ranked.withColumn("kinds", kinds).where("doc is not null and (n > 1 or kinds > 1)")
    judged = stored(several.select("gram", "doc", "first", "last", "n"), "anchors")
    covered = judged.where("n > 1").select("doc", "first", "last").union(rows.where("covered").select("doc", "first", "last"))

    mixed = judged.where("n = 1")
    hot = mixed.groupBy("gram").count().where(F.col("count") > HOT).select("gram", F.lit(True).alias("hot"))
    wanted = mixed.join(hot, "gram", "left").groupBy("doc").agg(F.collect_list(F.struct("gram", "first", "last", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted"))
    contexts = texts.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(_context_bytes, "gram long, salt int, doc long, first int, bytes binary")
    found = stored(contexts.repartition("gram", "salt").sortWithinPartitions("gram", "salt").mapInArrow(_compared(BLOCK_BYTES), _FOUND), "classes")
    heads = found.where("string is not null")
    later = heads.withColumn("n", F.row_number().over(Window.partitionBy("string").orderBy("doc", "first"))).where("n > 1")
    covered = covered.union(found.where("string is null").select("doc", "first", "last")).union(later.select("doc", "first", "last"))
    own, a, b = (free_name(docs, s) for s in ("_doc", "_first", "_end"))
    spans = covered.groupBy(F.col("doc").alias(own)).agg(F.collect_list("first").alias(a), F.collect_list(F.col("last") + LENGTH).alias(b))
    met = docs.drop("dedup").withColumn(own, key).join(spans, own, "left")
    return met.withColumn("dedup", _cut("text", a, b)).drop(own, a, b)
