"""SimHash classes, periodic runs and hard negatives against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkcast.llm import hard_negatives as hard
from sparkcast.llm import periodic_runs as periodic
from sparkcast.llm import queries, simhash

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, f string, x string, comp string, value string, runs string, n_words string"
DATA = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *["z"] * 6) for i, t in rows], SCHEMA).repartition(3)


def odd_texts():
    return [None, "", " \n\t\x0b ", "a", "A  b", "Ähm 漢字 x \x1c y", "ab " * 30_000, "x" * 50_000, "the same text twice", "the same text twice"]


# SimHash


def print_of(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """Smallest id reachable over fingerprints within two bits, by comparing all."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(prints))]


def test_simhash_classes(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["Ähm", "The", "the"]
    texts = []
    for _ in range(12):
        w = [rng.choice(words) for _ in range(rng.randrange(30, 400))]
        for _ in range(8):
            texts.append(" ".join(w))
            w = w.copy()
            w[rng.randrange(len(w))] = rng.choice(words)
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts + odd_texts())]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_classes(docs_of(spark, rows)).collect()}
    prints = [(i, print_of(t)) for i, t in rows]
    assert got == {i: (f"{f:016x}", c) for (i, f), c in zip(prints, classes(prints), strict=True)}
    assert len({c for _, c in got.values()}) < len(rows) - 20
    assert simhash.simhash_classes(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("bucket", [0, 3, 10**6])
def test_simhash_links(spark, monkeypatch, bucket):
    """Fingerprints in crowds and chains, at distances of 1, 2 and 3 over both halves, on either way."""
    rng = random.Random(bucket)
    prints = {0, 2**64 - 1, 2**63, 1}
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            prints.add(f)
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                f ^= 1 << b
    crowd = rng.getrandbits(64)
    prints |= {crowd ^ 1 << a ^ 1 << b for a in range(12) for b in range(32, 44)}
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    signed = [(f - 2**64 if f >> 63 else f,) for f in prints]
    found = [(r.u % 2**64, r.v % 2**64) for r in simhash._links(spark.createDataFrame(signed, "f long")).collect()]
    assert all(0 < (u ^ v).bit_count() <= 2 for u, v in found)
    order = sorted(prints)
    parent = {f: f for f in order}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in found:
        parent[find(u)] = find(v)
    want = classes([(k, f) for k, f in enumerate(order)])
    own = {}
    for f, c in zip(order, want, strict=True):
        own.setdefault(c, set()).add(find(f))
    assert all(len(v) == 1 for v in own.values()) and len(own) == len({find(f) for f in order})


def test_simhash_ids(spark):
    rows = [(None, "p q r s"), (5, "p q r s"), (5, "something else entirely here"), (9, "Something ELSE entirely here"), (None, "alone in the world")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.simhash_classes(docs_of(spark, rows)).collect() if r.doc_id is not None)
    assert [c for *_, c in got] == [5, 5, 5] and len({f for _, _, f, _ in got}) == 2
    assert all(r.component_id is None for r in simhash.simhash_classes(docs_of(spark, rows)).collect() if r.doc_id is None)


# periodic runs


def runs_of(w):
    """Every stretch by every period, smallest periods only."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            size = i + q - a
            if size >= max(12, 2 * q) and not any(all(w[k] == w[k + p] for k in range(a, a + size - p)) for p in range(1, q)):
                out.append((a, size, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def sequences():
    rng, out = random.Random(2), []
    for _ in range(150):
        k, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.randrange(rng.choice([20, 60, 250]))
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(3) if n > 30 else 0):
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 2))
            for i in range(a, rng.randrange(a, n)):
                w[i] = w[a + (i - a) % p]
        out.append(w)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return [*out, [0] * 700, [*range(300)] * 3, fibonacci[-1], [*range(7)] * 2, [1] * 11, [1] * 12]


def test_runs_against_all_periods(spark):
    given = sequences()
    rows = [(k, " \n".join(f"W{x}" for x in w)) for k, w in enumerate(given)]
    odd = [(1000 + k, t) for k, t in enumerate(odd_texts())] + [(None, "a b " * 10)]
    got = {r.doc_id: r for r in periodic.periodic_runs(docs_of(spark, rows + odd)).collect()}
    for k, w in enumerate(given):
        want = runs_of(w)
        assert [tuple(r) for r in got[k].runs] == want and got[k].n_words == len(w)
        gone = {i for a, n, q in want for i in range(a + q, a + n)}
        assert got[k].collapsed == " ".join(f"W{x}" for i, x in enumerate(w) if i not in gone)
    assert [tuple(r) for r in got[1006].runs] == [(0, 30_000, 1)] and got[1006].collapsed == "ab"
    assert got[1000].n_words == 0 and got[1000].runs == [] and got[1005].collapsed == "Ähm 漢字 x \x1c y"
    assert [tuple(r) for r in got[None].runs] == [(0, 20, 2)] and got[None].collapsed == "a b"
    assert periodic.periodic_runs(docs_of(spark, [])).count() == 0


def test_runs_with_periods_beyond_the_longest_transform():
    w = np.arange(90_000)
    w = np.concatenate([w, w, w[:500]])
    assert periodic.find_runs(w, np.array([0, 0, len(w)])) == [[], [(0, len(w), 90_000)]]


def test_runs_when_all_words_look_alike(monkeypatch):
    """Numbers that differ only modulo the prime are false zeros, which the comparison of words drops."""
    given = sequences()[:40]
    bounds = np.cumsum([0, *map(len, given)])
    ids = np.array([x for w in given for x in w]) * periodic.PRIME
    assert periodic.find_runs(ids, bounds) == [runs_of(w) for w in given]


@pytest.mark.parametrize("size,width", [(2, 7), (8, 23), (64, 191), (1000, 1500)])
def test_correlations_are_exact(size, width):
    rng = np.random.default_rng(size)
    a, b = rng.integers(0, periodic.PRIME, (size, 3)), rng.integers(0, periodic.PRIME, (width, 3))
    want = [[sum(int(x) * int(y) for x, y in zip(a[:, k], b[i : i + size, k], strict=True)) % periodic.PRIME for k in range(3)] for i in range(width - size + 1)]
    assert periodic.correlate(a, b).tolist() == want


def test_runs_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](spark, DATA).collect()}
    planted = 0
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall():
        w, h = WORD.findall(t or ""), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        if len(w) > 1500:
            continue  # too slow by brute force; the operator has seen it
        runs = runs_of(w)
        gone = {j for a, n, q in runs for j in range(a + q, a + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        assert (got[i].n_runs, got[i].start, got[i].length, got[i].period, got[i].exponent_milli) == want
        assert got[i].runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
        assert got[i].collapsed_sha256 == hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()
    assert planted > 5


# hard negatives


def mined(rows, anchors, positives=5, negatives=10):
    vectors = {i: (label, np.floor(256 * np.array(v, float)).astype(int)) for i, label, v in rows}
    out = []
    for a in anchors:
        score = {i: int((v[:64] * vectors[a][1][: len(v)]).sum()) for i, (_, v) in vectors.items()}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if vectors[i][0] == vectors[a][0] and i != a][:positives]:
            ok = [i for i in ranked if vectors[i][0] != vectors[a][0] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:negatives]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(ok)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_hard_negatives(spark, monkeypatch, block):
    rng = np.random.default_rng(block)
    rows = [(k, int(rng.integers(3)), rng.normal(0, 0.3, 20).tolist()) for k in range(300)]
    rows += [(300 + k, k % 3, rows[5][2]) for k in range(40)]  # ties
    rows += [(400, 0, []), (401, 1, [0.5, 0.25]), (402, 2, [0.0] * 20), (500, 9, [1.0] * 20)]
    bad = [(None, 1, [1.0] * 20), (600, None, [1.0] * 20), (601, 1, None), (602, 1, [None] * 20), (603, 1, [float("nan")] * 20), (604, 1, [float("-inf")] * 20), (700, 0, [float("inf")])]
    schema = "vec_id long, label int, embedding array<double>, id string, planes string, anchor string, i string"
    df = spark.createDataFrame([(*r, *["z"] * 4) for r in rows + bad + [rows[0], rows[1], (2, 99, rows[3][2])]], schema).repartition(3)
    monkeypatch.setattr(hard, "CANDIDATES", block)
    monkeypatch.setattr(hard, "ANCHORS", block)
    monkeypatch.setattr(hard, "AT_ONCE", 3)
    got = hard.hard_negatives(df, F.col("vec_id") % 20 == 0)
    rows = [(i, label, v + [0.0] * (20 - len(v))) for i, label, v in rows]
    assert sorted(map(tuple, got.collect())) == mined(rows, [r[0] for r in rows if r[0] % 20 == 0])
    assert hard.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_hard_negatives_refuse_scores_that_cannot_be_exact(spark):
    df = spark.createDataFrame([(0, 1, [1e30])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(ValueError):
        hard.hard_negatives(df, F.lit(True))


def test_four_russians_scores_are_inner_products():
    rng = np.random.default_rng(4)
    parts = rng.integers(-300, 300, (50, 24))
    planes = np.packbits(((parts[:, None, :] >> np.arange(10)[:, None]) & 1).astype(np.uint8), axis=2, bitorder="little")
    assert (hard._components(planes) == parts).all()
    assert (hard.scores(hard.subset_sums(parts[:9]), planes) == parts @ parts[:9].T).all()


def test_hard_negatives_query(spark):
    want = duckdb.sql(f"SELECT * FROM ({queries.ORACLE_SQL['op13_hard_negatives'].replace('FROM embeddings', f"FROM '{DATA}/embeddings.parquet'")})").fetchall()
    assert sorted(map(tuple, queries.QUERIES["op13_hard_negatives"](spark, DATA).collect())) == sorted(want) and want
