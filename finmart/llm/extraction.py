"""Main text of web pages by gradient-boosted trees over the nodes of their trees.

A node is wholly main text, wholly something else, or holds both. Trees give each node log-probabilities of the three from
its size, text density, attribute words, depth and neighbours. The states of a page are then chosen together: what is inside
a node that is wholly one thing is that thing too, so no choice contradicts one above or below it, and among the choices
left the one with the largest sum wins.

The trees are fitted on a bounded sample of the pages. Where a page names its parts (``article``, ``nav``, ``role``,
classes), the names tell the labels. The same texts are also laid out anew in many ways, with named and unnamed parts, so
that the trees do not depend on one way of naming.
"""

from __future__ import annotations

import pickle
import random
from collections.abc import Iterator
from html import escape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm import boosting
from finmart.llm.dom import Node, parse
from finmart.session import spread, written

# The sample the trees are fitted on: pages of at most so many characters, and layouts of their texts in all.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 200_000
LAYOUTS = 600
# Characters of pages whose nodes are scored together.
BLOCK_CHARS = 2_000_000
MAIN, OTHER, BOTH = 0, 1, 2

# Words of names, for labels and for layouts.
MAIN_WORDS = ("article articlebody body-text content copy entry main mainentity post postcontent richtext story text "
              "page-content blog-post").split()
OTHER_WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip".split(),
    "header": "header masthead banner site-header logo branding".split(),
    "footer": "footer site-footer copyright colophon legal bottom imprint".split(),
    "sidebar": "sidebar aside widget rail related recommended trending more-stories tags popular secondary complementary".split(),
    "notice": "cookie cookies consent notice gdpr privacy alert popup modal overlay disclaimer paywall message".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad teaser outbrain commercial".split(),
    "form": "form newsletter signup subscribe search login contact survey".split(),
    "comments": "comment comments discussion respond replies reply disqus responses thread".split(),
    "share": "share social sharing follow like buttons".split(),
}
_OTHER_TOKENS = frozenset(t for words in OTHER_WORDS.values() for w in words for t in w.split("-")) - {
    "body", "text", "more", "site", "stories", "bottom", "legal", "message", "like", "thread", "secondary"}
_OTHER_TAGS = frozenset(("<nav>", "<footer>", "<aside>", "<form>", "<dialog>", "<menu>"))
_MAIN_TAGS = frozenset(("<article>", "<main>"))
_PLAIN_WORDS = "wrapper container row col inner page site layout outer block section box wrap grid".split()
_END_SIGNS, _COMMAS = ".!?…。", ",;:"


def _is_other(node: Node) -> bool:
    return "hidden" in node.tokens or node.tokens[0] in _OTHER_TAGS or not _OTHER_TOKENS.isdisjoint(node.tokens[1:])


def _named(nodes: list[Node]) -> np.ndarray | None:
    """Which text runs are main by the page's own names; None where it names no main part."""
    state = []  # 0 outside, 1 main, 2 something else
    for node in nodes:
        above = state[node.parent] if node.parent >= 0 else 0
        main = node.tokens[0] in _MAIN_TAGS or "articlebody" in node.tokens or (
            node.tokens[0] != "<body>" and "main" in node.tokens[1:])
        state.append(2 if above == 2 or _is_other(node) else 1 if main else above)
    labels = np.array(state) == 1
    return labels if labels.any() else None


class Model(NamedTuple):
    trees: boosting.Trees
    tokens: dict[str, tuple[float, float]]


_NO_TOKEN = (0.0, 0.0)


def features(pages: list[list[Node]], tokens: dict[str, tuple[float, float]]) -> np.ndarray:
    """A row of numbers for each node of the pages."""
    base, columns, counts, tags = 0, [], [], ([], [], [], [])
    order, parents, ends, starts = [], [], [], []
    for nodes in pages:
        own, above = [], []
        seen = [0] * len(nodes)
        for i, node in enumerate(nodes):
            scores = [tokens.get(t, _NO_TOKEN) for t in node.tokens]
            up = node.parent
            pair = above[up] if up >= 0 else (-9.0, -9.0, 0)
            top = max(s[0] for s in scores), max(s[1] for s in scores)
            above.append((max(pair[0], top[0]), max(pair[1], top[1]), pair[2] + 1))
            own.append((*scores[0], *top, *above[-1][:2], above[-1][2], node.children, node.raw is not None,
                        up < 0 or nodes[up].tokens[0] == "<body>"))
            if node.raw is None:
                counts.append((0, 0, 0, 0, 0, 0))
            else:
                text = " ".join(node.text().split())
                counts.append((len(text), text.count(" ") + 1, min(node.link, len(text)), sum(map(text.count, _END_SIGNS)),
                               sum(map(text.count, _COMMAS)), sum(map(str.isdigit, text[:200]))))
            order.append(seen[up] if up >= 0 else 0)
            if up >= 0:
                seen[up] += 1
            parents.append(base + max(up, 0))
            ends.append(base + node.end)
            starts.append(base)
        for held, names in zip(tags, (("h1", "h2", "h3", "h4"), ("p",), ("li", "td", "option"), ("a", "button", "input", "label"))):
            held += [node.name in names for node in nodes]
        columns += own
        base += len(nodes)
    own, counts = np.array(columns, float), np.array(counts, float)
    parents, ends, starts, order = map(np.array, (parents, ends, starts, order))
    at = np.arange(base)

    def inside(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0)])
        return total[ends] - total[at]

    under = inside(counts)
    leaves, elements = inside(own[:, 8]), ends - at
    chars, words, links, signs, commas, digits = under.T
    words = np.maximum(words, 1)
    deepest = np.zeros(base)  # the longest run below
    longest = counts[:, 0].copy()
    for i in range(base - 1, -1, -1):
        if parents[i] < i and longest[i] > longest[parents[i]]:
            longest[parents[i]] = longest[i]
    siblings = own[parents, 7]
    before, after = np.zeros(base), np.zeros(base)
    last: dict[int, int] = {}
    for i in range(base):
        up = int(parents[i])
        if up < i:
            if up in last:
                before[i], after[last[up]] = chars[last[up]], chars[i]
            last[up] = i
    running = np.cumsum(counts[:, 0])
    whole = np.maximum(chars[starts], 1)
    deepest = np.log1p(longest)
    tag_counts = np.column_stack([inside(np.array(t, float)) for t in tags])
    return np.column_stack([
        own, own[parents, :6], np.log1p(chars), np.log1p(words), links / np.maximum(chars, 1), signs / words, commas / words,
        chars / words, digits / np.maximum(np.minimum(chars, 200 * leaves), 1), np.log1p(chars / np.maximum(leaves, 1)),
        np.log1p(leaves), np.log1p(chars / elements), deepest, chars / whole, chars / np.maximum(chars[parents], 1),
        np.log1p(chars[parents]), (links / np.maximum(chars, 1))[parents], (signs / words)[parents],
        order / np.maximum(siblings - 1, 1), siblings, np.log1p(before), np.log1p(after),
        (running - counts[:, 0] - (running[starts] - counts[starts, 0])) / whole, tag_counts, tag_counts[parents]])


def _labels(nodes: list[Node], main: np.ndarray) -> np.ndarray:
    """MAIN, OTHER or BOTH for each node, -1 where there is no text."""
    run = np.array([n.raw is not None for n in nodes])
    total = np.concatenate([[[0, 0]], np.cumsum(np.column_stack([run & main, run & ~main]), 0)])
    ends = np.array([n.end for n in nodes])
    good, bad = (total[ends] - total[:-1]).T
    return np.select([(good > 0) & (bad > 0), good > 0, bad > 0], [BOTH, MAIN, OTHER], -1)


def _decode(nodes: list[Node], scores: np.ndarray) -> list[bool]:
    """Which nodes are wholly main text in the likeliest choice without contradictions."""
    n = len(nodes)
    main, other, best = scores[:, MAIN].tolist(), scores[:, OTHER].tolist(), scores[:, BOTH].tolist()
    pick = [BOTH] * n
    text = [node.raw is not None for node in nodes]
    for i in range(n - 1, -1, -1):
        if nodes[i].raw is not None:
            best[i] = max(main[i], other[i])
        elif not text[i]:
            main[i] = other[i] = best[i] = 0.0
        best[i] = max(best[i], main[i], other[i])
        pick[i] = MAIN if best[i] == main[i] else OTHER if best[i] == other[i] else BOTH
        up = nodes[i].parent
        if up >= 0 and text[i]:
            main[up] += main[i]
            other[up] += other[i]
            best[up] += best[i]
            text[up] = True
    for i in range(1, n):
        if pick[nodes[i].parent] != BOTH:
            pick[i] = pick[nodes[i].parent]
    return [p == MAIN for p in pick]


def main_text(nodes: list[Node], chosen: list[bool]) -> str:
    """The chosen runs: those of a block joined as they stand, white space as one blank, blocks joined by a blank."""
    parts: list[str] = []
    block = None
    for node, kept in zip(nodes, chosen):
        if node.raw is not None:
            if node.block != block:
                parts.append(" ")
                block = node.block
            parts.append(node.text() if kept else " ")
    return " ".join("".join(parts).split())


def predict(pages: list[list[Node]], model: Model) -> list[str]:
    scores = model.trees.scores(features(pages, model.tokens))
    out, at = [], 0
    for nodes in pages:
        out.append(main_text(nodes, _decode(nodes, scores[at:at + len(nodes)])))
        at += len(nodes)
    return out


class _Layout:
    """A page written anew from given texts; a private sign before a run of text tells what it is."""

    MAIN, OTHER = "\ue000", "\ue001"

    def __init__(self, rng: random.Random, paragraphs: list[str]):
        self.rng, self.words = rng, [w for p in paragraphs for w in p.split()] or ["text"]
        self.paragraphs = paragraphs or ["text"]

    def some(self, least: int, most: int) -> str:
        n = self.rng.randint(least, most)
        at = self.rng.randrange(max(1, len(self.words) - n))
        return " ".join(self.words[at:at + n])

    def prose(self) -> str:
        kind = self.rng.random()
        text = self.rng.choice(self.paragraphs) if kind < 0.6 else self.some(1, 12) if kind < 0.75 else self.some(10, 120)
        return text if text[-1:] in _END_SIGNS or self.rng.random() < 0.3 else text + "."

    def named(self, tag: str, names: list[str], inner: str, unnamed: float) -> str:
        if self.rng.random() < unnamed:
            return f"<{tag}>{inner}</{tag}>"
        name = self.rng.choice(names)
        more = self.rng.choice(["", " " + self.rng.choice(_PLAIN_WORDS), "-" + self.rng.choice(_PLAIN_WORDS), "__" + name])
        return f'<{tag} {self.rng.choice(["class", "class", "class", "id"])}="{name}{more}">{inner}</{tag}>'

    def line(self, text: str, sign: str) -> str:
        words = text.split()
        if len(words) > 6 and self.rng.random() < 0.2:
            at = self.rng.randrange(len(words) - 3)
            tag = self.rng.choice(["b", "i", "em", "strong", 'a href="/x"', 'span class="x"', "code"])
            close = tag.split()[0]
            return f"{sign}{escape(' '.join(words[:at]))} <{tag}>{sign if 'class' in tag else ''}" \
                   f"{escape(' '.join(words[at:at + 2]))}</{close}>{sign if 'class' in tag else ''} {escape(' '.join(words[at + 2:]))}"
        return sign + escape(text)

    def article(self) -> list[str]:
        rng, sign, out = self.rng, self.MAIN, []
        if rng.random() < 0.7:
            out.append(f"<h1>{self.line(self.some(2, 12), sign)}</h1>")
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.72:
                tag = "p" if rng.random() < 0.9 else "div"
                out.append(f"<{tag}>{self.line(self.prose(), sign)}</{tag}>" if rng.random() < 0.9 else f"<p>{self.line(self.prose(), sign)}")
            elif kind < 0.8:
                out.append(f"<h2>{self.line(self.some(1, 8), sign)}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.line(self.some(2, 20), sign)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote><p>{self.line(self.prose(), sign)}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<figure><figcaption>{self.line(self.some(3, 15), sign)}</figcaption></figure>")
            elif kind < 0.96:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.line(self.some(1, 4), sign)}</td>" for _ in range(3)) + "</tr>"
                                               for _ in range(rng.randint(2, 4))) + "</table>")
            else:
                out.append(f"<p><b>{self.line(self.prose(), sign)}<br><p>{self.line(self.prose(), sign)}</p>")
        return out

    def other(self, kind: str) -> str:
        rng, sign = self.rng, self.OTHER
        links = "".join(f'<li><a href="/{i}">{self.line(self.some(1, 4), sign)}</a></li>' for i in range(rng.randint(2, 9)))
        short = f"{sign}{escape(self.some(1, 15))}"
        names = OTHER_WORDS[kind]
        if kind == "menu":
            return rng.choice([f"<nav><ul>{links}</ul></nav>", self.named("div", names, f"<ul>{links}</ul>", 0.2),
                               self.named("ul", names, links, 0.3)])
        if kind == "header":
            inner = rng.choice([f"<div>{short}</div>", f"<h1>{short}</h1>", f"<a href='/'>{short}</a><ul>{links}</ul>", short])
            return f"<header>{inner}</header>" if rng.random() < 0.5 else self.named("div", names, inner, 0)
        if kind == "footer":
            inner = rng.choice([f"{sign}&copy; {escape(self.some(2, 12))}", f"<p>{sign}{escape(self.some(4, 30))}.</p>",
                                f"<ul>{links}</ul><p>{short}</p>"])
            return f"<footer>{inner}</footer>" if rng.random() < 0.6 else self.named("div", names, inner, 0)
        if kind == "sidebar":
            inner = rng.choice([f"<h3>{short}</h3><ul>{links}</ul>", f"<p>{sign}{escape(self.some(8, 60))}.</p>", f"<ul>{links}</ul>"])
            return f"<aside>{inner}</aside>" if rng.random() < 0.5 else self.named("div", names, inner, 0)
        if kind == "notice":
            return self.named(rng.choice(["div", "div", "section", "p", "dialog"]), names,
                              f"{sign}{escape(self.some(5, 30))}." + rng.choice(["", f"<a href='/ok'>{short}</a>", "<button>ok</button>"]), 0)
        if kind == "advert":
            return self.named(rng.choice(["div", "div", "aside", "section", "p", "ins"]), names, rng.choice(
                [f"{sign}{escape(self.some(3, 25))}.", f"<p>{sign}{escape(self.some(5, 30))}.</p>", f"<a href='/ad'>{short}</a>"]), 0)
        if kind == "form":
            inner = f"<label>{short}</label><input name=q><button>go</button>" + rng.choice(["", f"<p>{sign}{escape(self.some(4, 20))}.</p>"])
            return f"<form>{inner}</form>" if rng.random() < 0.7 else self.named("div", names, f"<form>{inner}</form>", 0)
        if kind == "comments":
            one = [self.named(rng.choice(["div", "li", "article"]), ["comment", "reply", "response"],
                              f"<p>{sign}{escape(self.some(3, 60))}.</p>", 0.2) for _ in range(rng.randint(1, 6))]
            return self.named(rng.choice(["div", "section", "ol"]), names, f"<h3>{short}</h3>" * rng.randint(0, 1) + "".join(one), 0)
        return self.named(rng.choice(["div", "ul"]), names, f"<ul>{links}</ul>" if rng.random() < 0.5 else short, 0)

    def page(self) -> str:
        rng = self.rng
        kinds = list(OTHER_WORDS)
        rest = [self.other(k) for k in rng.choices(kinds, k=rng.choice([0, 0, 1, 2, 3, 4, 5, 6, 8]))]
        inner = self.article() if rng.random() < 0.96 else []
        for _ in range(rng.choice([0, 0, 1, 2])):
            if inner:
                inner.insert(rng.randint(0, len(inner)), self.other(rng.choice(["advert", "share", "sidebar", "notice", "form", "comments"])))
        if inner and rng.random() < 0.3:
            inner.append(self.other("comments"))
        body = "".join(inner)
        if inner:
            kind = rng.random()
            if kind < 0.3:
                body = f"<article>{body}</article>"
            elif kind < 0.45:
                body = f"<main>{body}</main>"
            elif kind < 0.78:
                body = self.named(rng.choice(["div", "div", "section", "td"]), MAIN_WORDS, body, 0.25)
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(rest))
            body, rest = self.named("div", _PLAIN_WORDS, "".join(rest[:at][:2]) + body, 0.3), rest[:at][2:] + rest[at:]
        at = rng.randint(0, len(rest))
        whole = "".join(rest[:at]) + body + "".join(rest[at:])
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{whole}</body></html>" if rng.random() < 0.9 else whole


def _laid_out(rng: random.Random, paragraphs: list[str]) -> tuple[list[Node], np.ndarray]:
    nodes = parse(_Layout(rng, paragraphs).page())
    main = np.zeros(len(nodes), bool)
    above = False
    for i, node in enumerate(nodes):
        if node.raw is not None:
            text = "".join(node.raw)
            main[i] = above = _Layout.MAIN in text or (_Layout.OTHER not in text and above)
            node.raw = [text.replace(_Layout.MAIN, "").replace(_Layout.OTHER, "")]
    return nodes, main


def train(pages: list[str], layouts: int = LAYOUTS, seed: int = 0) -> Model:
    """Trees and attribute words from pages that name their parts and from layouts of the texts of all."""
    rng = random.Random(seed)
    samples: list[tuple[list[Node], np.ndarray]] = []
    each = -(-layouts // max(1, len(pages)))
    for page in pages:
        nodes = parse(page)
        main = _named(nodes)
        runs = [" ".join(n.text().split()) for n in nodes if n.raw is not None]
        if main is not None:
            samples.append((nodes, main))
            runs = [" ".join(n.text().split()) for n, kept in zip(nodes, main) if kept and n.raw is not None]
        samples += [_laid_out(rng, runs) for _ in range(each)]
    if not pages:
        samples = [_laid_out(rng, []) for _ in range(layouts)]
    labels = [_labels(*s) for s in samples]
    counts: dict[str, np.ndarray] = {}
    for (nodes, _), label in zip(samples, labels):
        for node, one in zip(nodes, label.tolist()):
            if one >= 0:
                for token in node.tokens:
                    counts.setdefault(token, np.zeros(3))[one] += 1
    shares = sum(counts["<#text>"]) and (sum(counts.values()) / sum(counts.values()).sum())
    tokens = {}
    for token, n in counts.items():
        chance = (n + 4 * shares) / (n.sum() + 4)
        tokens[token] = tuple(float(np.log(chance[c] / shares[c])) for c in (MAIN, OTHER))
    x = features([nodes for nodes, _ in samples], tokens)
    label = np.concatenate(labels)
    return Model(boosting.fit(x[label >= 0], label[label >= 0], 3), tokens)


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> Model:
    """The model, fitted in one task on the ``sample_pages`` pages of the smallest hashes among those of at most
    ``sample_chars`` characters; NULL and empty pages are not in the sample."""
    page = F.col(f"`{html_col}`").cast("string")
    sample = pages.select(page.alias("html")).where(F.length("html").between(1, sample_chars)).orderBy(
        F.xxhash64("html"), "html").limit(sample_pages)
    empty = pages.sparkSession.range(0, 1, 1, 1).select(F.lit(None).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(p for batch in batches for p in batch.column(0).to_pylist() if p is not None)
        model = train(held)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((tuple(model.trees), model.tokens))], pa.binary())], ["model"])

    stored = written(sample, "sample")
    trees, tokens = pickle.loads(
        stored.unionByName(empty).repartition(1).mapInArrow(run, "model binary").first()["model"])
    return Model(boosting.Trees(*trees), tokens)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` (the main text, empty if there is none), ``n_chars`` (its code points), a row per page.

    A NULL or empty page has an empty text. Character references are decoded, white space inside a block is one blank,
    blocks are joined by a blank in page order. Repeated pages and ids stay rows, pages of any length are read whole, an
    empty table gives an empty one; other columns of ``pages`` are not read.
    """
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, block, size = [], [], 0
            for page in batch.column(2):
                page = page.as_py() or ""
                block.append(parse(page))
                size += len(page)
                if size >= BLOCK_CHARS:
                    out += predict(block, shared.value)
                    block, size = [], 0
            out += predict(block, shared.value) if block else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return spread(slim, "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
