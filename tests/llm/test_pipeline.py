"""The pipeline's stages on a small corpus, each judged on its own input."""

import math
import random

import corpus_pipeline
from sparkcast.llm.queries import tokenizer_path
from test_documents import LOWER, SPACE, shingles


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    text = lambda n=90: " ".join(rng.choice(words) for _ in range(n))
    item = text(30)
    good = [text() for _ in range(150)]
    texts = [*good, *(f"{g} zz" for g in good[:10]), *(g + "\nThis line is in many documents" for g in (text() for _ in range(20))), f"{text()} {item} {text()}"]
    texts += [" ".join(w.upper() + "!!" for w in text().split()) for _ in range(60)] + [None]
    n = len(texts)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    folder = f"file://{tmp_path}"
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < n - 61), 0) for k in range(n - 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen, at = [], spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, folder)
        out.write.parquet(f"{folder}/{name}")
        at = spark.read.parquet(f"{folder}/{name}")
        seen.append({r.doc_id for r in at.select("doc_id").collect()})
        assert at.columns[:5] == docs.columns and at.count() == len(seen[-1])
    kept, lines, near, clean, tokens = seen
    assert not kept & set(range(n - 61, n - 1)) and len(kept & set(range(150))) >= 145
    assert lines == kept and near <= lines and not near & {150 + k for k in range(10) if k in kept}
    assert clean == near - {180} and tokens == clean
    assert at.where("not round_trip or n_tokens <> size(token_ids)").count() == 0
    assert at.where("text like '%many documents%'").count() <= 1
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()} == tokens


def test_near_copies_keep_documents_without_id(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (None, "no id " + text), (None, None)], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, text), (None, "no id " + text), (None, None)], key=str)


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, encoding string, token_ids string"


def brute_force(rows, benchmark, score):
    """The pipeline's rows (doc_id, text) by plain loops; score(text) is the trained classifier's."""
    rows = [r for r in rows if score(r[1]) >= 0.7]
    key = lambda line: line.strip(SPACE).translate(LOWER)
    owner = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                owner.setdefault(key(line), i)
    rows = [(i, "\n".join(x for x in (t or "").split("\n") if owner.get(key(x), i) == i)) for i, t in rows]
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    rows = [(i, t) for i, t in rows if find(i) == i]
    items = [shingles(t) for t in benchmark]
    return [(i, t) for i, t in rows if not any(100 * len(s & sets[i]) >= 80 * len(s) for s in items)]


def test_pipeline_against_brute_force(spark, tmp_path):
    import zstandard
    from tokenizers import Tokenizer

    from sparkcast.llm.quality_classifier import PIECE, train_quality

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    text = lambda n=60: " ".join(rng.choice(words) for _ in range(n))
    item, lines = text(30), [text(6) for _ in range(5)]
    good = [text() for _ in range(90)]
    texts = [*good, *(f"{g} {rng.choice(words)}" for g in good[:20]), *good[20:25], *(f"{text()}\n{rng.choice(lines)}\n{text(20)}" for _ in range(30)), f"{text()} {item} {text()}", lines[0], ""]
    texts += ["#".join(w.upper() for w in text().split()) for _ in range(40)] + [None]
    n = len(texts)
    folder = f"file://{tmp_path}"
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), "mine", "mine", "mine") for k, t in enumerate(texts)], COLUMNS)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(k, int(k < n - 41), 0) for k in range(n)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    model = train_quality(spark.read.parquet(f"{folder}/documents.parquet"), labels)

    def score(t):
        raw, sizes = (t or "").encode(), []
        for content in (model.bad, model.good):
            z = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(z.compress(raw[k : k + PIECE])) for k in range(0, len(raw), PIECE)))
        x = (sizes[0] - sizes[1]) / len(raw) if raw else 0.0
        return 1 / (1 + math.exp(-(model.slope * x + model.offset)))

    want = dict(brute_force(list(enumerate(texts)), [item], score))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "encoding", "token_ids", "n_tokens", "round_trip"]
    got = got.collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want) > 80
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation(), library.no_padding()
    for r in got:
        assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids and r.round_trip
        assert (r.n_tokens, r.n_chars, r.n_lines, r.encoding) == (len(r.token_ids), len(r.text), "mine", "mine")


def test_pipeline_of_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "source", "token_ids", "n_tokens", "round_trip"]


def test_stages_keep_null_and_repeated_ids(spark, tmp_path):
    folder, long = f"file://{tmp_path}", " ".join(f"w{k}" for k in range(40))
    rows = [(1, long), (1, long), (2, long + " more"), (None, long), (None, None), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(1, "not in there at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert ids(corpus_pipeline.lines(spark, docs, folder)) == ["1", "1", "2", "3", "4", "None", "None"]
    assert ids(corpus_pipeline.near_copies(spark, docs, folder)) == ["1", "1", "3", "4", "None", "None"]
    assert ids(corpus_pipeline.clean(spark, docs, folder)) == ["1", "1", "2", "3", "4", "None", "None"]
    assert ids(corpus_pipeline.tokens(spark, docs, folder)) == ["1", "1", "2", "3", "4", "None", "None"]
