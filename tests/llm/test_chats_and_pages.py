"""Chat formatting and HTML extraction."""

import hashlib
import itertools
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcast.llm.chat_format import END, SEP, START, format_chats, masked_texts, read_chats
from sparkcast.llm.html_extract import BLOCK, Dom, extract_text, labelled_pages, train_extractor
from sparkcast.llm.queries import HOSTILE

TURNS = "conv_id long, turn int, role string, text string, turns string"


def test_chat_round_trip(spark):
    chats = {
        1: [("user", "hi"), ("user", "and &amp; &lt;| " + HOSTILE), ("assistant", "one"), ("assistant", "two<"), ("user", "|x")],
        2: [("assistant", SEP), ("user", START), ("assistant", END)],
        3: [("odd\nrole<|im_end|>", ""), ("", "text\n\nmore"), ("assistant", "")],
    }
    rows = [(c, k, r, t, "z") for c, ts in chats.items() for k, (r, t) in enumerate(ts)]
    rows += [(4, 1, None, None, "z"), (4, 1, "user", "b", "z"), (4, 1, "user", "b", "z"), (4, None, "user", "first", "z"), (None, 0, "user", "no id", "z")]
    out = format_chats(spark.createDataFrame(rows, TURNS).repartition(3)).withColumn("turns", read_chats(F.col("formatted"))).withColumn("loss", masked_texts(F.col("formatted"), F.col("mask"))).collect()
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in out}
    assert {k: got[k] for k in chats} == chats
    assert got[4] == [("user", "first"), ("", ""), ("user", "b"), ("user", "b")] and got[None] == [("user", "no id")]
    loss = {r.conv_id: r.loss for r in out}
    assert loss[1] == ["one", "two<"] and loss[2] == [SEP, END] and loss[3] == [""] and loss[4] == []
    assert next(r for r in out if r.conv_id == 1).formatted.count(START) == 3
    assert format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_of_very_long_texts_and_many_turns(spark):
    rows = [(1, 0, "user", "q &<| " * 200_000), (1, 1, "assistant", "\U0001f600é" * 300_000)] + [(2, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(2000)]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {r.conv_id: r for r in out.select("conv_id", read_chats(F.col("formatted")).alias("turns"), masked_texts(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    for c in (1, 2):
        assert [tuple(t) for t in got[c].turns] == [r[2:] for r in rows if r[0] == c]
        assert got[c].loss == [r[3] for r in rows if r[0] == c and r[2] == "assistant"]


def test_op8_digests(spark, tmp_path):
    from sparkcast.llm.queries import op8_chat_format

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op8_chat_format(spark, f"file://{tmp_path}").collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\n\n").hexdigest() and (got[1].n_turns, got[1].loss_chars) == (2, 0)
    assert got[-1].loss_sha256 == hashlib.sha256(HOSTILE.encode()).hexdigest() and got[-1].n_turns == 2


@pytest.fixture(scope="module")
def model(spark):
    return train_extractor(labelled_pages(spark, 250))


def test_pages(spark, model):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
    <nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now, it is new.</div>
    <article><h1>Head &amp; line</h1><p><b>First  part<br><p>Second\n part &lt;3 &eacute;</p><p></p><p>x</p></article>
    <div class="comments"><p>I like this.</p></div><form><p>Subscribe</p></form><footer>&copy; site</footer></body></html>"""
    rows = [(1, page, "old"), (2, None, "old"), (3, "", "old"), (4, "no markup at all < >", "old"), (5, "<p" * 50, "old"), (6, page.replace("x</p>", "long word " * 20_000 + "</p>"), "old"), (1, page, "old")]
    got = extract_text(spark.createDataFrame(rows, "page_id long, html string, text string"), model).collect()
    want = "Head & line\nFirst part\nSecond part <3 é\nx"
    assert [r.text for r in got if r.page_id == 1] == [want, want]
    assert next(r.text for r in got if r.page_id == 2) == "" and next(r.text for r in got if r.page_id == 3) == ""
    assert next(r.text for r in got if r.page_id == 6).endswith("long word " * 19_999 + "long word")
    assert extract_text(spark.createDataFrame([], "page_id long, html string"), model).count() == 0


def test_broken_markup_takes_linear_time(model):
    import time

    def seconds(page):
        start = time.time()
        model.text(page)
        return time.time() - start

    kinds = [
        lambda n: "<a " * n,
        lambda n: "<a " * n + ">",
        lambda n: '<a ">"' * n,
        lambda n: "<a '>\"" * n,
        lambda n: "<div>" * n + "</section>" * n,
        lambda n: "<b><table>" + "<span>" * n + "</b>" * n,
        lambda n: "<span>" * n + "<h1>" * n,
        lambda n: "<ul>" + "<li><p>x" * n,
        lambda n: "<!" * n,
        lambda n: "<" * n,
        lambda n: "<!--" * n,
        lambda n: "&amp" * n,
    ]
    for k, kind in enumerate(kinds):
        assert seconds(kind(20_000)) < 5, k


def test_parser_on_odd_tags(model):
    dom = Dom("<p title='a > b'>one<p title=\"x>two")
    assert dom.tags == ["#root", "p", "p"] and [t for _, t in dom.texts if t] == ["one", "two"]
    dom = Dom("<ul><li>a<li>b<ul><li>c</ul>d</ul><math><mi>x</mi></math>")
    assert [(dom.tags[k], dom.tags[dom.parents[k]], t) for k, t in dom.texts if t] == [("li", "ul", "a"), ("li", "ul", "b"), ("li", "ul", "c"), ("li", "ul", "d"), ("mi", "math", "x")]


def test_held_out_accuracy(spark, model):
    right = total = 0
    for r in labelled_pages(spark, 80, seed=77).collect():
        dom = Dom(r.html)
        truth, marginals = dom.truth(), model.marginals(dom)
        for node in {k for k, t in dom.texts if t and t.strip()}:
            right += (marginals[node] >= 0.5) == truth[node]
            total += 1
    assert right >= 0.99 * total > 500


def enumerated(model, dom):
    """Marginals by summing over all labellings of the tree."""
    n = len(dom.tags)
    odds = [sum(model.unary.get(f, 0.0) for f in fs) for fs in dom.features()]
    states = np.array([(0, *s) for s in itertools.product((0, 1), repeat=n - 1)])
    mass = np.ones(len(states))
    for k in range(1, n):
        table = np.array(model.edge.get(dom.tags[k], model.edge["*"]))
        mass *= table[states[:, dom.parents[k]], states[:, k]] * np.exp(odds[k] * (states[:, k] - 0.5))
    return mass @ states / mass.sum()


def test_messages_equal_enumeration(model):
    dom = Dom('<div class="ad"><p>one</p></div><article><p>two three</p></article>')
    assert np.allclose(model.marginals(dom), enumerated(model, dom))


class PlainParser(HTMLParser):
    """The standard library's parser on well-formed pages: elements counted in page order, texts with their elements, None at the
    edges of blocks."""

    def __init__(self, page):
        super().__init__()
        self.stack, self.n, self.texts = [(0, "")], 0, []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.n += 1
        if tag == "br":
            self.texts.append((self.stack[-1][0], " "))
            return
        self.texts += [None] if tag in BLOCK else []
        self.stack.append((self.n, tag))

    def handle_endtag(self, tag):
        self.texts += [None] if tag in BLOCK else []
        self.stack.pop()

    def handle_data(self, data):
        if self.stack[-1][1] not in ("script", "style"):
            self.texts.append((self.stack[-1][0], data))


def test_texts_equal_enumeration(spark, model):
    """The operator's texts are those that enumerated marginals and another parser give."""
    rng = np.random.default_rng(3)
    says = lambda: " ".join(rng.choice(["one", "two&amp;", "three\n", "caf&eacute; &#8212;", " four "], rng.integers(1, 25)))
    kinds = ["<nav><a>{}</a></nav>", '<div class="ad">{}</div>', "<p>{}<b>{}</b><br>{}</p>", "<article><h1>{}</h1><p>{}</p></article>", '<div class="content"><p>{}</p>{}</div>', "<script>{}</script>", "<footer>{}</footer>", '<section id="comments"><p>{}</p></section>', "<ul><li>{}</li><li>{}</li></ul>"]
    pages = []
    for _ in range(40):
        page, wrap = "", rng.random() < 0.5
        for kind in rng.permutation(kinds)[: rng.integers(1, 6)]:
            while "{}" in kind:
                kind = kind.replace("{}", says(), 1)
            page += str(kind)
        pages.append(f"<main>{page}</main>" if wrap else page)
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"), model).collect()}
    some = 0
    for k, page in enumerate(pages):
        dom, plain = Dom(page), PlainParser(page)
        assert len(dom.tags) == plain.n + 1 <= 17
        marginals = enumerated(model, dom)
        blocks, block = [], ""
        for piece in [*plain.texts, None]:
            if piece is None:
                blocks, block = [*blocks, " ".join(block.split())], ""
            elif marginals[piece[0]] >= 0.5:
                block += piece[1]
        want = "\n".join(b for b in blocks if b)
        assert got[k] == want, page
        some += bool(want)
    assert 10 < some < 40


def test_a_conversation_of_40000_turns_takes_time_in_proportion(spark):
    def seconds(n):
        began = time.time()
        role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
        turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("<| 😀 "), F.col("id").cast("string")).alias("text"))
        out = format_chats(turns)
        row = out.select(F.array_join(masked_texts(F.col("formatted"), F.col("mask")), "").alias("loss"), F.size(read_chats(F.col("formatted"))).alias("n")).first()
        assert row.n == n and row.loss == "".join(f"<| 😀 {k}" for k in range(n) if k % 3)
        return time.time() - began

    seconds(1000)
    assert seconds(40_000) < 20
