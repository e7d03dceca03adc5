"""The document operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeats, empty tables,
extra columns with clashing names."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcast.llm import bpe_chunks, common, line_dedup, suffix_dedup
from sparkcast.llm import ngram_jaccard as jaccard
from sparkcast.llm.decontamination import find_contamination
from sparkcast.llm.license_scan import HEADERS, NOTICES, TEXTS, notices, scan_licenses
from sparkcast.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from sparkcast.llm.ngram_jaccard import ngram_jaccard
from sparkcast.llm.quality_classifier import fold, score_quality, train_quality
from sparkcast.llm.quality_rules import quality_rules
from sparkcast.llm.queries import tokenizer_path

WORD, SPACE = re.compile(r"[^ \t-\r]+"), " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, row string, x string, k1 string, comp string, n_lines string, lang string, source string"


def corpus(seed=1, n=120):
    """Random texts with near copies, shared lines and passages; then the odd ones."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Ähm", "漢字", "the", "The"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 150))) for _ in range(12)]
    lines = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(8)]
    out = []
    for _ in range(n):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(0, 1 + len(w) // 12)):
            w[rng.randrange(len(w))] = rng.choice(words)
        text = " ".join(w) if rng.random() < 0.7 else "\n".join(rng.choice(lines + [" ".join(w[:20])]) for _ in range(rng.randrange(1, 6)))
        out.append(text + rng.choice(["", "", "\n", "\n\n" + rng.choice(lines).upper()]))
    out += [None, "", " \n\t ", "a", "a b c d", "A  b\tc d", "x" * 5000, "ab " * 3000, "\n" * 50, out[0], out[0]]
    return [(k * 3 % 1009, t) for k, t in enumerate(out)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, *["z"] * 7) for i, t in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()


def test_ngram_jaccard(spark, rows, docs):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    assert ngram_jaccard(empty(spark)).count() == 0


def test_ngram_jaccard_large_group_and_odd_ids(spark):
    rng = random.Random(3)
    base = [f"v{k}" for k in range(100)]
    texts = []
    for k in range(90):
        w = base.copy()
        w[rng.randrange(100)] = f"new{k}"
        texts.append((k, " ".join(w)))
    texts += [(200, "p q r s t"), (200, "p q r s t u"), (None, " ".join(base)), (201, "P Q R S T")]
    got = ngram_jaccard(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(r.component_id == 0 for r in got if r.doc_id is not None and r.doc_id < 90)
    assert {r.component_id for r in got if r.doc_id in (200, 201)} == {200}
    assert [r.component_id for r in got if r.doc_id is None] == [None] and len(got) == len(texts)


def test_ngram_jaccard_keeps_chains_of_near_copies(spark):
    """Groups of 10, 100 and 1000 different texts, each linked with its next one only; and texts that share half with them."""
    texts, first = [], {}
    for base, n in ((0, 10), (100, 100), (1000, 1000)):
        w = [f"g{n}w{k}" for k in range(60)]
        for k in range(n):
            if k:
                w = w[1:] + [f"g{n}n{k}"]  # 55 of 57 shingles stay
            texts.append((base + k, " ".join(w)))
            first[base + k] = base
            if k % 7 == 0:
                texts.append((10_000 + base + k, " ".join(w[:30] + [f"o{base + k}x{j}" for j in range(30)])))
                first[10_000 + base + k] = 10_000 + base + k
    random.Random(1).shuffle(texts)
    got = {r.doc_id: r.component_id for r in ngram_jaccard(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == first


def test_ngram_jaccard_without_bitmaps(spark, rows, docs, monkeypatch):
    """More ids than a bitmap may hold: they are joined."""
    want = sorted(map(tuple, ngram_jaccard(docs).collect()))
    monkeypatch.setattr(common, "MAX_BITMAP_BITS", 8)
    assert sorted(map(tuple, ngram_jaccard(docs).collect())) == want


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(k).count("1") % 2] for k in range(n))


def test_long_words_and_lines_that_differ_by_a_pattern(spark):
    """Strings that collide under every polynomial hash modulo a power of two are told apart."""
    one, two = thue_morse(4096), thue_morse(4096, "ba")
    docs = spark.createDataFrame([(1, one), (2, two), (3, two), (4, one.upper())], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_jaccard(docs).collect()} == {1: 1, 2: 2, 3: 2, 4: 1}
    assert {r.doc_id: (r.n_dropped, r.text) for r in dedup_lines(docs).collect()} == {1: (0, one), 2: (0, two), 3: (1, ""), 4: (1, "")}


def lines_by_brute_force(rows):
    owners = collections.defaultdict(set)
    key = lambda line: line.strip(SPACE).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and min(owners[key(x)]) < i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(spark, rows, docs):
    out = dedup_lines(docs)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in out.collect()} == lines_by_brute_force(rows)
    assert dedup_lines(empty(spark)).count() == 0


def test_line_index_is_reversible(spark, rows, docs):
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    old, new = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    index = LineIndex.build(old).insert(new)
    assert texts(index.apply(docs)) == texts(dedup_lines(docs))
    assert texts(index.delete(new).apply(old)) == texts(dedup_lines(old))


def test_line_dedup_with_filters_where_they_lie(spark, rows, docs, monkeypatch):
    """Filters too large for a broadcast, over several shards."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in dedup_lines(docs).collect()} == lines_by_brute_force(rows)


def test_line_index_takes_documents_again(spark, docs):
    index = LineIndex.build(docs)
    assert sorted(map(tuple, index.insert(docs).counts.collect())) == sorted(map(tuple, index.counts.collect()))


def test_line_dedup_repeated_and_null_ids(spark):
    rows = [(5, "one long line here"), (5, "one long line here"), (None, "another long line"), (7, "another long line\nOne long line here ")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_dropped) for r in got) == [(0, "another long line", 0), (5, "one long line here", 0), (5, "one long line here", 0), (7, "", 2)]


def test_cuckoo_filter():
    hashes = common.mix64(np.arange(5000, dtype=np.uint64))
    made = CuckooFilter.of(hashes)
    assert made.contains(hashes).all()
    made.delete(hashes[:2500])
    assert made.contains(hashes[2500:]).all() and made.contains(hashes[:2500]).mean() < 0.01
    assert CuckooFilter.from_bytes(made.to_bytes()).contains(hashes[2500:]).all()


def test_bpe_matches_the_library(spark, rows, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation(), library.no_padding()
    out = bpe_chunks.encode_and_decode(docs, tokenizer_path())
    got = {r.doc_id: (r.encoding.ids, r.encoding.decoded) for r in out.collect()}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False))
    assert bpe_chunks.encode_and_decode(empty(spark), tokenizer_path()).count() == 0


def test_bpe_of_very_long_runs(spark):
    """White space, line breaks, one word and odd white space far beyond what a backtracking pattern can take."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation(), library.no_padding()
    texts = ["a" + " " * 1_000_000 + "b", "\n" * 300_000, "x" * 1_000_000, "\u3000 " * 200_000 + "end", "word " * 100_000]
    docs = spark.createDataFrame([(k, t, "old") for k, t in enumerate(texts)], "doc_id long, text string, encoding string")
    for r in bpe_chunks.encode_and_decode(docs, tokenizer_path()).collect():
        assert r.encoding.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.encoding.decoded == texts[r.doc_id]


def test_bpe_joins_are_repaired():
    """Random texts, half of whose chunks come from a dictionary."""
    bpe, rng = bpe_chunks.load(tokenizer_path()), random.Random(9)
    parts = ["word ", "  ", "\n\n", "it's", "漢字é", "x" * 40, "<|endoftext|>", "12 34", ". ", "\t", "Zeile\n"]
    for _ in range(150):
        raw = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 120))).encode()
        cuts = [0, *sorted({k for k in rng.choices(range(1, len(raw) + 1), k=6) if k < len(raw) and (raw[k] & 0xC0) != 0x80}), len(raw)]
        known = lambda c: np.array(bpe.encode(c), np.int32) if rng.random() < 0.6 else None
        assert bpe_chunks.encode_document(bpe, raw, np.array(cuts), known) == bpe.encode(raw)


def test_chunks_follow_the_content():
    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(20_000)).encode()
    texts = [b"start " + shared, b"another start, longer " + shared]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    chunks = [{data[a:b].tobytes() for a, b in zip(x[:-1], x[1:], strict=True)} for x in bpe_chunks.chunk_bounds(data, offsets)]
    assert len(chunks[0] & chunks[1]) >= 0.8 * len(chunks[0]) > 4


def test_decontamination(spark, rows, docs):
    texts = [t for _, t in rows if t and len(t.split()) > 30]
    items = [(k, " ".join(t.split()[5:25]).upper()) for k, t in enumerate(texts[:6])] + [(10, "A b"), (11, None), (12, " "), (13, texts[7][:80] + " but not found anywhere else at all"), (None, texts[1])]
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in find_contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for k, item in items:
        w = WORD.findall((item or "").translate(LOWER))
        own = shingles(item)
        for i, t in rows:
            d = WORD.findall((t or "").translate(LOWER))
            there = shingles(t) if len(w) >= 5 else {tuple(d[a : a + len(w)]) for a in range(len(d) - len(w) + 1)}
            if k is not None and own and 100 * len(own & there) >= 80 * len(own):
                want[i, k] = (len(own), len(own & there))
    assert got == want and any(k == 10 for _, k in got)
    assert find_contamination(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert find_contamination(empty(spark), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_suffix_array():
    rng = random.Random(5)
    for k in range(300):
        t = bytes(rng.choice(b"ab" if k % 2 else b"abc\x00\xff") for _ in range(rng.randrange(0, 50)))
        assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def repeats_by_brute_force(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        cover = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                cover[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        runs = sum(1 for k in range(len(raw)) if cover[k] and not (k and cover[k - 1]))
        out[i] = (len(raw), sum(cover), runs, bytes(c for c, m in zip(raw, cover, strict=True) if not m))
    return out


@pytest.mark.parametrize("hot, block", [(200, 1 << 16), (1, 500)])
def test_suffix_dedup(spark, rows, docs, monkeypatch, hot, block):
    """With the usual blocks, and with grams dealt over several small blocks."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    got = {r.doc_id: (r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, bytes(r.dedup.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == repeats_by_brute_force(rows)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_dedup_of_an_unsorted_batch_with_several_slices(spark):
    """The earliest copy of a context comes in a later slice than a later copy of it."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    whole, other = text(600), text(400)
    rows = [(50, whole), (30, other[:200] + whole[150:450] + other[200:]), (1000, text(1 << 20)), (10, whole)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.dedup.n_removed, bytes(r.dedup.kept)) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got[30] == (300, other.encode()) and got[50] == (600, b"") and got[10] == (0, whole.encode())


def test_anchors_of_very_long_slices_agree(monkeypatch):
    data = np.random.default_rng(3).integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 2500, 5000])
    want = suffix_dedup.anchors(data, offsets)
    rank = suffix_dedup.span_hashes
    monkeypatch.setattr(suffix_dedup, "_POSITION_BITS", 12)  # the slice is then too long for one number
    monkeypatch.setattr(suffix_dedup, "span_hashes", lambda *a: rank(*a) >> np.uint64(26 - 12) << np.uint64(0))
    assert all((a == b).all() for a, b in zip(want, suffix_dedup.anchors(data, offsets), strict=True))


def test_quality_rules(spark, rows, docs):
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert tuple(got[i])[1:7] == want
        assert not (got[i].kept and got[i].base_failed) and (got[i].distance is None) == got[i].base_failed
    assert quality_rules(empty(spark)).count() == 0
    plain = spark.createDataFrame([(None, None), (1, "a " * 60)], "doc_id long, text string")
    assert quality_rules(plain).count() == 2


def test_quality_verdict_against_brute_force(spark):
    """Distances and verdicts by NumPy: medians and deviations, concentration steps, priors, the fence."""
    from sparkcast.llm import quality_rules as rules

    rng = random.Random(3)
    text = lambda lo: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(lo, 9))) for _ in range(rng.randrange(55, 220)))
    mess = lambda: "\n".join(rng.choice([text(2)[:60], "# * | same line", "$ % & <>"]) for _ in range(60))
    docs = [(k, text(1 + k % 3) if k % 19 else mess(), ("en", "de")[k % 2], f"s{k % 7 % 3 + 3 * (k % 2)}") for k in range(320)]
    docs += [(900, text(2), "en", "alone"), (901, text(2), "fr", "new")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    good = [d for d in docs if not got[d[0]].base_failed]

    def stats(d):
        r = got[d[0]]
        n = max(r.n_words, 1)
        return [np.log1p(r.n_words), r.word_chars / n, np.sqrt(r.n_symbols / max(r.word_chars, 1)), np.sqrt(r.n_dup_lines / n), np.sqrt(r.n_repeat_words / n)]

    x = np.array([stats(d) for d in good])
    floors = np.array([rules.FLOORS[s] for s in rules.STATS])
    quantile = lambda v, p: np.sort(v)[max(0, int(np.ceil(p * len(v))) - 1)]
    units = {}
    for k, (_, _, lang, source) in enumerate(good):
        for unit in ((0, lang, source), (1, lang, ""), (2, "", "")):
            units.setdefault(unit, []).append(k)
    now = {}
    for u, rows in units.items():
        mean = np.array([quantile(v, 0.5) for v in x[rows].T])
        now[u] = (len(rows), mean, np.diag([(1.4826 * quantile(np.abs(v - m), 0.5)) ** 2 for v, m in zip(x[rows].T, mean, strict=True)]))

    def drawn(now):
        out = {}
        for u in sorted(now, reverse=True):  # all rows, languages, groups
            n, mean, cov = now[u]
            if u[0] < 2:
                above = out[(1, u[1], "") if u[0] == 0 else (2, "", "")]
                mean, cov = ((n * a + rules.PRIOR * b) / (n + rules.PRIOR) for a, b in ((mean, above[0]), (cov, above[1])))
            out[u] = (mean, cov)
        return {u: (m, np.linalg.inv(c + np.diag(floors**2))) for u, (m, c) in out.items()}

    def far(u, metrics):
        y = x[units[u]] - metrics[u][0]
        return np.einsum("ki,ij,kj->k", y, metrics[u][1], y)

    for _ in range(rules.STEPS):
        metrics, new = drawn(now), {}
        for u, rows in units.items():
            d = far(u, metrics)
            core = x[np.array(rows)[d <= quantile(d, rules.CORE)]]
            new[u] = (len(core), core.mean(axis=0), np.cov(core.T, bias=True))
        moved = max((np.abs(new[u][2] - now[u][2]) / np.outer(floors, floors)).max() for u in units)
        now = new
        if moved <= rules.STILL:
            break
    metrics = drawn(now)
    middle = {u: (len(units[u]), quantile(far(u, metrics), 0.5)) for u in units}
    want = {}
    for u in units:
        if u[0] == 0:
            (n, own), (_, lang) = middle[u], middle[(1, u[1], "")]
            for k, d in zip(units[u], far(u, metrics), strict=True):
                want[good[k][0]] = d * rules.CHI2_MEDIAN / max((n * own + rules.PRIOR * lang) / (n + rules.PRIOR), 1e-9)
    logs = np.log(np.maximum(list(want.values()), 1e-9))
    q1, q3 = quantile(logs, 0.25), quantile(logs, 0.75)
    most = np.exp(q3 + rules.FENCE * (q3 - q1))
    assert set(want) == {i for i, r in got.items() if r.distance is not None}
    for i, d in want.items():
        assert got[i].distance == pytest.approx(d, rel=1e-6) and got[i].kept == (d <= most)


def test_quality_rules_reject_outliers(spark):
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(60, 200)))
    good = [(k, text(), "en", "hot" if k % 3 else f"s{k % 5}") for k in range(600)]
    bad = [(1000 + k, " | ".join(text().split()), "en", "hot") for k in range(10)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[1000 + k] for k in range(10)) and sum(kept[k] for k in range(600)) >= 597


def test_quality_rules_warn_where_steps_end_before_estimates_settle(spark, monkeypatch):
    from sparkcast.llm import quality_rules as rules

    rng = random.Random(2)
    docs = [(k, " ".join("ab"[rng.randrange(2)] * rng.randrange(1, 9) + str(rng.randrange(99)) for _ in range(rng.randrange(60, 300)))) for k in range(80)]
    docs += [(k + 1000, t) for k, t in docs]  # ties: copies share a verdict
    monkeypatch.setattr(rules, "STEPS", 1)
    with pytest.warns(RuntimeWarning, match="after 1 concentration steps"):
        kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(kept) == 160 and all(kept[k] == kept[k + 1000] for k in range(80))


def test_license_scan(spark, rows):
    texts = [(1, "x\nLicensed under the apache license; version 2.0\ny"), (2, "Released under the MIT License."), (3, "MIT"), (4, None), (5, ""), (2, "Released under the MIT License."), (6, "about the licence of this work"), (None, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame([(i, t, "r") for i, t in texts], "doc_id long, text string, row string")
    got = sorted((r.doc_id or 0, r.line, r.license) for r in scan_licenses(df, notices(spark)).collect())
    # the first text is close enough to the notice as a whole, too
    assert got == [(0, 0, "CC-BY-NC-4.0"), (1, -1, "Apache-2.0"), (1, 1, "Apache-2.0"), (2, 0, "MIT"), (2, 0, "MIT")]
    own = spark.createDataFrame([("b", "one two three"), ("a", "one two three"), (None, "x y"), ("c", "..")], "license string, text string")
    units = spark.createDataFrame([(1, "one two three\nfour")], "doc_id long, text string")
    assert {(r.line, r.license, r.dice) for r in scan_licenses(units, own).collect()} == {(0, "a", 1.0), (-1, "a", 0.8)}
    assert scan_licenses(df.limit(0), own).count() == 0 and scan_licenses(df, own.limit(0)).count() == 0


def windows_by_brute_force(text, template):
    """The best Dice coefficient of a window of words."""
    words = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    w, v = words(text), words(template)
    g, b = list(zip(w, w[1:], strict=False)), set(zip(v, v[1:], strict=False))
    spans = [set(g[i:j]) for i in range(len(g)) for j in range(i + 1, min(len(g), i + int(1.5 * (len(v) - 1))) + 1)]
    return max(2 * len(s & b) / (len(s) + len(b)) for s in spans)


def test_license_scan_finds_parts_of_texts(spark):
    gpl = "This work is licensed\nunder the GNU General Public License, version 3."
    mit = TEXTS["MIT"].replace("free of charge", "free of any charge")
    prose = "some words of prose before and after it that are about other things " * 4
    texts = [f"{prose}\n{prose} {gpl} {prose}", "This project is released under the MIT License.", f"int x;\n{mit}\n{' '.join(f'p{k}' for k in range(300))}", prose]
    texts.append(f"{prose}{gpl}\n{prose}\n{prose}{gpl}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in scan_licenses(df, notices(spark)).collect())
    assert [r[:3] for r in got] == [(0, 1, "GPL-3.0"), (1, 0, "MIT"), (2, 1, "MIT"), (4, 1, "GPL-3.0"), (4, 4, "GPL-3.0")]  # in text 4 a line matches by itself
    want = [windows_by_brute_force(texts[0], NOTICES["GPL-3.0"]), 1.0, windows_by_brute_force(texts[2], TEXTS["MIT"]), 14 / 15, 14 / 15]
    assert [r[3] for r in got] == pytest.approx(want)


def test_license_scan_against_brute_force(spark):
    """Every unit that matches, by comparing each with each template; and every licence that a window of a text matches."""
    rng = random.Random(12)
    templates = [*NOTICES.items(), *HEADERS.items(), *TEXTS.items()]
    norm = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    pairs = lambda w: set(zip(w, w[1:], strict=False)) if len(w) > 1 else set(w)
    dice = lambda a, b: 2 * len(a & b) / (len(a) + len(b))
    prose = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "the", "of", "software", "version"]) for _ in range(n))
    texts = []
    for k in range(60):
        w = templates[k % len(templates)][1].split()
        for _ in range(rng.randrange(0, 1 + len(w) // 10)):
            w[rng.randrange(len(w))] = rng.choice(["x", "other", "words"])
        cuts = sorted(rng.sample(range(1, len(w)), min(len(w) - 1, rng.randrange(3))))
        body = "\n".join(" ".join(w[a:b]) for a, b in zip([0, *cuts], [*cuts, len(w)], strict=True))
        texts.append(rng.choice(["{}", "{}\n{}", "{1}\n{0}\n{2}", "{1} {0}", "{0} {2}"]).format(body, prose(30), prose(20)))
    texts += [prose(100), "", None]
    got = collections.defaultdict(dict)
    for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), notices(spark)).collect():
        got[r.doc_id].setdefault(r.line, []).append((r.license, round(r.dice, 9)))
    sets = [(name, norm(t), pairs(norm(t))) for name, t in templates]
    for k, text in enumerate(texts):
        lines = (text or "").split("\n")
        for n, unit in [*enumerate(lines), *([(-1, text)] if len(lines) > 1 else [])]:
            u = norm(unit)
            best = min(((-dice(pairs(u), b), name) for name, _, b in sets), default=None) if u else None
            if best and -best[0] >= 0.8 - 1e-12:
                assert (best[1], round(-best[0], 9)) in got[k][n]
        g = norm(text or "")
        g = list(zip(g, g[1:], strict=False))
        found = {name for rows in got[k].values() for name, _ in rows}
        for name, w, b in sets:
            longest = int(1.5 * (len(w) - 1) + 1e-9)
            top = max((2 * c / (u + len(b)) for i, x in enumerate(g) if x in b for u, c in growing(g[i : i + longest], b)), default=0)
            if top >= 0.999:  # a whole licence in the text is named, if no other starts in its line
                assert name in found
        if found:
            assert max(max((2 * c / (u + len(b)) for i, x in enumerate(g) if x in b for u, c in growing(g[i : i + int(1.5 * (len(w) - 1))], b)), default=0) for _, w, b in sets) >= 0.8 or any(len(norm(x)) for x in lines)
        else:
            assert all(max((2 * c / (u + len(b)) for i, x in enumerate(g) if x in b for u, c in growing(g[i : i + int(1.5 * (len(w) - 1))], b)), default=0) < 0.8 for _, w, b in sets)


def growing(g, b):
    """(distinct bigrams, those in b) of g's beginnings."""
    seen, common = set(), 0
    for x in g:
        if x not in seen:
            seen.add(x)
            common += x in b
        yield len(seen), common


def test_quality_classifier(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    text = lambda good: " ".join(rng.choice(words[:150] if good else words[150:]) for _ in range(120))
    rows = [(k, text(k % 3 > 0), k % 3 > 0) for k in range(400)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, None), (901, ""), (902, "x" * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(g)) for k, _, g in rows] + [(5, None), (None, 1)], "doc_id long, quality int")
    model = train_quality(docs, labels)
    out = score_quality(docs, model).withColumn("held", fold(F.col("doc_id")) == 2).collect()
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 403
    held = [r for r in out if r.held and r.doc_id < 400]
    assert sum((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held) > 40
    one_kind = train_quality(docs, labels.where("quality = 1"))
    assert score_quality(docs.limit(0), one_kind).count() == 0 and score_quality(docs, train_quality(docs, labels.limit(0))).count() == 403


def test_ngram_jaccard_with_ids_whose_hashes_agree_in_33_bits(spark):
    """Two documents that share most, and a third one with the rest of the first, whose id is confused with the second's."""
    w = [f"w{k}" for k in range(104)]
    texts = [(1, " ".join(w)), (172165, " ".join(w[:92])), (632235, " ".join(w[-12:]))]
    got = {r.doc_id: r.component_id for r in ngram_jaccard(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: 1, 172165: 1, 632235: 632235}


@pytest.mark.parametrize("bits", [2, 8])
def test_ngram_jaccard_with_hashes_of_few_bits(spark, rows, docs, monkeypatch, bits):
    """Merged columns are compared, so colliding marks and numbers change nothing."""
    want = sorted(map(tuple, ngram_jaccard(docs).collect()))
    full = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.shiftleft(full(*c).bitwiseAND(F.lit((1 << bits) - 1)), 20))
    assert sorted(map(tuple, ngram_jaccard(docs).collect())) == want


def shuffled_bytes(spark, run):
    """What run() writes for shuffles."""
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (found.apply(k) for k in range(found.size()))}

    before = stages()
    run()
    return sum(n for k, n in stages().items() if k not in before)


def test_ngram_jaccard_moves_little_for_shingles_of_one_document(spark, tmp_path):
    """Of 363,000 shingles 72,600 are in prefixes: they take little more than their hashes, and counts a few bits (before: 1,994,203 bytes)."""
    rng = random.Random(5)
    texts = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(604))) for k in range(600)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    assert shuffled_bytes(spark, lambda: ngram_jaccard(docs).count()) < 1_600_000


def test_ngram_jaccard_with_rows_packed_in_small_parts(spark, rows, docs, monkeypatch):
    want = sorted(map(tuple, ngram_jaccard(docs).collect()))
    monkeypatch.setattr(jaccard, "BUCKET_ROWS", 50)
    monkeypatch.setattr(jaccard, "PACKED_ROWS", 300)
    assert sorted(map(tuple, ngram_jaccard(docs).collect())) == want
