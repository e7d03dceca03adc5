"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a variable with two states, content or not. Potentials tie an element to its parent (by the element's tag)
and to what is seen of it (tag, words of class and id, link density, length of its text). They are estimated from labelled
pages. Sum-product messages go from the leaves up and from the root down; an element's marginal decides on its own text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# HTML's elements by how they are parsed and laid out.
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "textarea", "select", "title", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "head", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPE = {"html", "body", "table", "ul", "ol", "dl", "td", "th", "div", "article", "section", "main", "nav", "aside", "form", "footer", "header", "blockquote", "figure", "button"}
NOT_IN_P = BLOCK - {"html", "head", "body", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot", "legend", "summary", "figcaption"}
#: An element that carries this attribute in a labelled page is content, and so is all inside it; with the value "no" it is not.
LABEL = "data-content"
MAX_FEATURES = 20_000

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]{2,}")


class Dom:
    """Elements in page order: tags, parents, attribute words, labels; and the pieces of text with their elements."""

    def __init__(self, page: str):
        self.tags, self.parents, self.words, self.labels = ["#root"], [-1], [()], [None]
        self.texts: list[tuple[int, str]] = []  # (element, decoded text), None marks the edge of a block
        self._stack, self._open = [0], {}  # open elements, and for each tag where on the stack it is open
        at, last, plain = 0, page.rfind(">"), False
        while at < len(page):
            if page[at] != "<":
                end = page.find("<", at)
                end = len(page) if end < 0 else end
                self.texts.append((self._stack[-1], html.unescape(page[at:end])))
                at = end
                continue
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = len(page) if end < 0 else end + 3
                continue
            closing = page.startswith("/", at + 1)
            name = _NAME.match(page, at + 1 + closing) if at < last else None
            if name is None:
                if page[at + 1 : at + 2] in ("!", "?") and at < last:
                    at = page.index(">", at) + 1
                else:
                    self.texts.append((self._stack[-1], "<"))
                    at += 1
                continue
            end, plain = self._tag_end(page, name.end(), plain)
            tag, attributes, at = name.group().lower(), page[name.end() : end], end + 1
            if closing:
                self._close(tag)
                continue
            if tag in NOT_IN_P:
                self._end({"p"}, SCOPE)
            if tag in CLOSES:
                self._end(CLOSES[tag], SCOPE - CLOSES[tag])
            node = self._add(tag, self._stack[-1], attributes)
            if tag in RAW:
                ended = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = ended.end() if ended else len(page)
            elif tag not in VOID and not attributes.endswith("/"):
                self._open.setdefault(tag, []).append(len(self._stack))
                self._stack.append(node)

    @staticmethod
    def _tag_end(page: str, at: int, plain: bool) -> tuple[int, bool]:
        """The > that ends a tag, outside quotes if they are closed. Where they are not, quotes mean nothing (plain) from there
        on, so that broken pages take one such search only."""
        k = at
        while not plain and (m := _EDGE.search(page, k)):
            if m.group() == ">":
                return m.start(), False
            close = page.find(m.group(), m.end())
            if close < 0:
                break
            k = close + 1
        return page.index(">", at), True

    def _add(self, tag: str, parent: int, attributes: str) -> int:
        words, label = [], None
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role", "aria-label"):
                    words += (w.lower() for w in _WORD.findall("".join(values).replace("-", " ").replace("_", " ")))
                elif name == LABEL:
                    label = "".join(values) != "no"
        if tag in BLOCK or tag == "br":
            self.texts.append((parent, None if tag in BLOCK else " "))
        self.tags.append(tag)
        self.parents.append(parent)
        self.words.append(tuple(dict.fromkeys(words)))
        self.labels.append(label)
        return len(self.tags) - 1

    def _top(self, tags) -> int:
        """The highest place on the stack of an open element with one of the tags; 0 if there is none."""
        return max((places[-1] for t in tags if (places := self._open.get(t))), default=0)

    def _close(self, tag: str) -> None:
        place = self._top((tag,))
        if place and (tag in BLOCK or self._top(SCOPE) <= place):
            self._pop(place)

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """Closes the innermost open element with one of the tags, unless one of scope is open inside it."""
        place = self._top(tags)
        if place and place >= self._top(scope):
            self._pop(place)

    def _pop(self, place: int) -> None:
        for node in self._stack[place:]:
            if self.tags[node] in BLOCK:
                self.texts.append((node, None))
        for node in reversed(self._stack[place:]):
            self._open[self.tags[node]].pop()
        del self._stack[place:]

    def truth(self) -> list[bool]:
        """Each element's label: its own or its parent's."""
        out = [False]
        for k in range(1, len(self.tags)):
            out.append(out[self.parents[k]] if self.labels[k] is None else self.labels[k])
        return out

    def features(self) -> list[list[str]]:
        """What is seen of each element, the whole text below it included."""
        n = len(self.tags)
        chars, linked, in_link = [0] * n, [0] * n, [False] * n
        for k in range(1, n):
            in_link[k] = self.tags[k] == "a" or in_link[self.parents[k]]
        for node, text in self.texts:
            if text:
                size = len(text.strip())
                chars[node] += size
                linked[node] += size * in_link[node]
        for k in range(n - 1, 0, -1):
            chars[self.parents[k]] += chars[k]
            linked[self.parents[k]] += linked[k]
        return [
            [f"tag={self.tags[k]}", f"links={min(4, 5 * linked[k] // max(1, chars[k]))}", f"chars={min(5, (chars[k] // 20).bit_length())}", *(f"word={w}" for w in self.words[k])]
            for k in range(n)
        ]


@dataclass(frozen=True)
class TreeModel:
    """unary[feature] and edge[child tag][parent state] are log odds and log probabilities, estimated from counts."""

    unary: dict[str, float]
    edge: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def marginals(self, dom: Dom) -> list[float]:
        """Each element's probability of being content, by sum-product messages up and down the tree."""
        n, other = len(dom.tags), self.edge["*"]
        odds = np.array([sum(self.unary.get(f, 0.0) for f in fs) for fs in dom.features()])
        own = np.exp(np.clip(np.stack([-odds / 2, odds / 2], axis=1), -200, 200))
        inside, up = own.tolist(), [None] * n
        tables = [self.edge.get(t, other) for t in dom.tags]
        for k in range(n - 1, 0, -1):  # children come after their parents
            (a0, a1), (b0, b1) = tables[k]
            x0, x1 = inside[k]
            m0, m1 = a0 * x0 + a1 * x1, b0 * x0 + b1 * x1
            up[k] = m = (m0 / (m0 + m1), m1 / (m0 + m1))
            p = inside[dom.parents[k]]
            y0, y1 = p[0] * m[0], p[1] * m[1]
            inside[dom.parents[k]] = [y0 / (y0 + y1), y1 / (y0 + y1)]
        whole = [None] * n
        whole[0] = (1.0, 0.0)  # the root stands for no element
        for k in range(1, n):
            (a0, a1), (b0, b1) = tables[k]
            p0, p1 = whole[dom.parents[k]]
            q0, q1 = p0 / max(up[k][0], 1e-300), p1 / max(up[k][1], 1e-300)
            x0, x1 = inside[k]
            y0, y1 = x0 * (a0 * q0 + b0 * q1), x1 * (a1 * q0 + b1 * q1)
            whole[k] = (y0 / (y0 + y1), y1 / (y0 + y1))
        return [w[1] for w in whole]

    def text(self, page: str | None) -> str:
        """The main text: blocks with white space folded, in page order, joined by line breaks."""
        dom = Dom(page or "")
        content = [m >= 0.5 for m in self.marginals(dom)]
        blocks, parts = [], []
        for node, text in [*dom.texts, (0, None)]:
            if text is None:
                if parts and (block := " ".join("".join(parts).split())):
                    blocks.append(block)
                parts = []
            elif content[node]:
                parts.append(text)
        return "\n".join(blocks)


def train_extractor(labelled: DataFrame) -> TreeModel:
    """Counts over labelled pages (column html, elements marked with LABEL).

    A feature has a prior of one case in either state; an element's state has, in its tag's table, a prior of 10 cases of its
    parent's state and 0.2 of the other. A training set has at most MAX_FEATURES kinds of counts; more are an error.
    """

    def count(batches):
        for pdf in batches:
            found: dict[tuple[str, int, int], int] = {}
            for page in pdf["html"]:
                dom = Dom(page or "")
                truth = dom.truth()
                for k, features in enumerate(dom.features()):
                    if k:
                        for key in [*((f, int(truth[k]), -1) for f in features), (f"tag={dom.tags[k]}", int(truth[k]), int(truth[dom.parents[k]]))]:
                            found[key] = found.get(key, 0) + 1
            yield pd.DataFrame([(*k, v) for k, v in found.items()], columns=["feature", "state", "parent", "n"])

    counts = labelled.select("html").mapInPandas(count, "feature string, state int, parent int, n long").groupBy("feature", "state", "parent").agg(F.sum("n").alias("n"))
    rows = counts.limit(MAX_FEATURES + 1).collect()
    if len(rows) > MAX_FEATURES:
        raise ValueError(f"labelled pages with more than {MAX_FEATURES} kinds of features")
    seen = {(r.feature, r.state, r.parent): r.n for r in rows}
    total = [sum(n for (f, s, p), n in seen.items() if p < 0 and s == state and f.startswith("tag=")) + 2 for state in (0, 1)]
    odds = {f: float(np.log((seen.get((f, 1, -1), 0) + 1) / total[1]) - np.log((seen.get((f, 0, -1), 0) + 1) / total[0])) for f, _, p in seen if p < 0}
    # link density and length are sums over what lies below: weak evidence, as the elements below speak for themselves
    unary = {f: v if f.startswith(("tag=", "word=")) else 0.25 * v for f, v in odds.items()}
    edge = {}
    for tag in ["*", *{f[4:] for f, _, p in seen if p >= 0}]:
        table = []
        for parent in (0, 1):
            stay = [sum(n for (f, s, p), n in seen.items() if p == parent and s == state and (tag == "*" or f == f"tag={tag}")) + (10.0 if state == parent else 0.2) for state in (0, 1)]
            table.append((stay[0] / sum(stay), stay[1] / sum(stay)))
        edge[tag] = tuple(table)
    return TreeModel(unary, edge)


def extract_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """pages with `text` from `html`; null and empty pages, and pages without content, give an empty text.

    Character references are decoded; scripts, styles, comments and what noscript holds are no text. A page may be of any
    length and its markup broken in any way: parsing takes time in proportion to its length. Other columns and repeated rows stay (a column
    named text is replaced); an empty table stays empty.
    """

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pages.map(model.text)

    return pages.withColumn("text", text("html"))


_WORDS = "a an and as at be by for from in is it of on or that the this to was with one two over under new old".split()


def labelled_pages(spark: SparkSession, n: int = 400, seed: int = 5) -> DataFrame:
    """Labelled pages of customary layouts, made by rule: a bounded training set that does not depend on the given tables."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    says = lambda lo, hi: " ".join(rng.choice(_WORDS, rng.integers(lo, hi))).capitalize() + pick(".", ".", "", "!")
    link = lambda: f'<a href="/{rng.integers(99)}">{says(1, 4)}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.integers(3, 9))) + "</ul>"

    def article() -> str:
        parts = [f"<h1>{says(3, 12)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.integers(1, 9)):
            kind = rng.random()
            if kind < 0.65:
                text = says(1, 90)
                parts.append(pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<p>{text} {link()} {says(2, 20)}</p>", f"<p><em>{text}</em> <strong>{says(1, 5)}</strong></p>", f"<div>{text}</div>", f"<div><p>{text}</p></div>", f"<section><p>{text}</p></section>"))
            elif kind < 0.75:
                parts.append(f"<h{rng.integers(2, 5)}>{says(1, 8)}</h2>")
            elif kind < 0.85:
                parts.append(pick("<ul>{}</ul>", "<ol>{}</ol>").format("".join(f"<li>{says(2, 20)}</li>" for _ in range(rng.integers(2, 6)))))
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{says(5, 40)}</p></blockquote>")
            elif kind < 0.94:
                parts.append(f"<table><tr><th>{says(1, 3)}</th></tr><tr><td>{says(1, 8)}</td></tr></table>")
            elif kind < 0.97:
                parts.append(f'<figure><img src="x.png"><figcaption>{says(3, 15)}</figcaption></figure><pre><code>{says(3, 20)}</code></pre>')
            else:
                parts.append(pick(*(f'<div class="{c}" {LABEL}="no">{says(2, 20)} {link()}</div>' for c in ("ad", "advert", "share social", "related posts", "newsletter signup"))))
        body = "".join(parts)
        return pick(*[f"<article {LABEL}>{body}</article>"] * 4, f'<main><div class="content" {LABEL}>{body}</div></main>', f"<main {LABEL}>{body}</main>", f'<div class="{pick("post", "entry", "article", "story")}-{pick("body", "content", "text")}" {LABEL}>{body}</div>', f'<div id="content" {LABEL}>{body}</div>')

    def extra() -> str:
        c = lambda *xs: pick("class", "id") + f'="{pick(*xs)}"'
        return pick(
            f"<nav>{links()}</nav>",
            f'<div {c("nav", "menu", "navbar", "breadcrumbs")}>{links()}</div>',
            f"<header><div {c('logo', 'site-title', 'brand')}>{says(1, 4)}</div>{links()}</header>",
            f"<aside>{pick(links(), f'<p>{says(3, 40)}</p>')}</aside>",
            f'<div {c("sidebar", "widget", "related", "recommended")}><h3>{says(1, 4)}</h3>{links()}<p>{says(3, 30)}</p></div>',
            f'<div {c("ad", "ads", "advert", "sponsored", "promo", "banner")}>{says(2, 40)}</div>',
            f'<div {c("cookie-notice", "consent", "notice", "alert", "popup")}><p>{says(4, 30)}</p><button>{says(1, 2)}</button></div>',
            f'<form {c("search", "login", "subscribe", "newsletter")}><label>{says(1, 4)}</label><input name="q"><p>{says(2, 15)}</p><button>{says(1, 2)}</button></form>',
            f'<section {c("comments", "comment-list", "discussion", "responses")}><h2>{says(1, 3)}</h2>' + "".join(f'<div class="comment"><p>{says(3, 50)}</p></div>' for _ in range(rng.integers(1, 5))) + "</section>",
            f"<footer>&copy; {says(2, 25)} &middot; {link()}</footer>",
            f'<div {c("footer", "copyright", "legal")}>{says(3, 25)}</div>',
        )

    pages = []
    for _ in range(n):
        before, after = ("".join(extra() for _ in range(rng.integers(1, 5))) for _ in range(2))
        main = article()
        if rng.random() < 0.3:
            main = f'<div class="{pick("wrapper", "container", "page", "row")}">{main}{extra()}</div>'
        foot = f"<footer>&copy; {says(2, 25)}</footer>" if rng.random() < 0.7 else ""
        pages.append((f"<!DOCTYPE html><html><head><title>{says(2, 9)}</title></head><body>{before}{main}{after}{foot}</body></html>",))
    return spark.createDataFrame(pages, "html string")
