"""Main text against the pages' own article, hand-made pages, laid-out pages with known text, and a brute-force decoder."""

import html
import itertools
import random
import re
import time

import numpy as np
import pytest

from finmart.llm import boosting, extraction
from finmart.llm.dom import parse

FOLDER = "/root/testdata/sf0.001"
TEXT = "Ein längerer Satz, der wie ein Artikel klingt, steht hier. Danach folgt ein zweiter Satz mit vielen Wörtern darin."


def article(page):
    """The text of a page of the given tables by its one article element."""
    found = re.search(r"<article>(.*)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>|<br>", found[1])
    return " ".join(" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks if b.strip())


@pytest.fixture(scope="module")
def model(spark):
    return extraction.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_given_pages(spark, model):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    told = {r["page_id"]: r for r in extraction.extract(pages, model).collect()}
    rows = pages.collect()
    assert len(told) == len(rows)
    for r in rows:
        got = told[r["page_id"]]
        assert got["text"] == article(r["html"]) and got["n_chars"] == len(got["text"]) and got["url"] == r["url"]


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


MENU = '<div class="menu"><ul>' + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(6)) + "</ul></div>"
PROSE = "".join(f"<p>{TEXT} Nummer {i}.</p>" for i in range(6))
PLAIN = " ".join(f"{TEXT} Nummer {i}." for i in range(6))


@pytest.mark.parametrize("built,expected", [
    (page(f"<div class='post-content'>{PROSE}</div>", MENU, "<footer>&copy; 2020 Jemand</footer>"), PLAIN),
    (page(f"<main>{PROSE}</main>", "<header><h1>Seite</h1></header>" + MENU, f"<aside><p>{TEXT}</p></aside>"), PLAIN),
    (page(f"<article>{PROSE}<div class='ad'>Kaufen Sie jetzt. Nur heute.</div><p>Ende.</p></article>", MENU), PLAIN + " Ende."),
    (page(f"<article>{PROSE}</article>", "<div class='cookie-notice'>Wir verwenden Cookies. <button>Ja</button></div>",
          f"<section id='comments'><div class='comment'><p>{TEXT}</p></div></section>"), PLAIN),
    (page(f"<article>{PROSE}</article>", "<form><label>Suche</label><input name=q></form>"), PLAIN),
    (page(f"<article><p>a &amp; b&nbsp;&lt;c&#62; <b>fe</b>tt<br>neu\n\t zwei</p>{PROSE}<script>var x = '</p>';</script></article>", MENU),
     "a & b <c> fett neu zwei " + PLAIN),
    (page(f"<article><p>offen {TEXT}<p>wieder {TEXT}<ul><li>eins {TEXT}<li>zwei {TEXT}</article>", MENU),
     f"offen {TEXT} wieder {TEXT} eins {TEXT} zwei {TEXT}"),
])
def test_hand_made_pages(model, built, expected):
    assert extraction.predict([parse(built)], model) == [expected]


def test_laid_out_pages(model):
    rng = random.Random(4)
    held = [f"{TEXT} {i}" for i in range(20)]
    samples = [extraction._laid_out(rng, held) for _ in range(200)]
    runs = right = 0
    for nodes, main in samples:
        told = extraction._decode(nodes, model.trees.scores(extraction.features([nodes], model.tokens)))
        same = [a == b for n, a, b in zip(nodes, told, main) if n.raw is not None]
        runs, right = runs + len(same), right + sum(same)
    assert right > 0.97 * runs


def test_choices_do_not_contradict():
    rng = np.random.default_rng(2)
    nodes = parse("<div><p>a</p><div>b<p>c</p><b class=x>d</b></div></div><div></div>e")
    above = [n.parent for n in nodes]
    runs = [i for i, n in enumerate(nodes) if n.raw is not None]
    told = [any(i <= r < n.end for r in runs) for i, n in enumerate(nodes)]
    for _ in range(30):
        scores = boosting._log_softmax(rng.normal(size=(len(nodes), 3)) * 2)
        best, choice = -np.inf, None
        for pick in itertools.product(range(3), repeat=sum(told)):
            state = dict(zip([i for i, t in enumerate(told) if t], pick))
            if any(state[r] == extraction.BOTH for r in runs) or any(
                    above[i] >= 0 and state[above[i]] != extraction.BOTH and state[i] != state[above[i]] for i in state):
                continue
            total = sum(scores[i, s] for i, s in state.items())
            if total > best:
                best, choice = total, [state[r] == extraction.MAIN for r in runs]
        got = extraction._decode(nodes, scores)
        assert [got[r] for r in runs] == choice


def test_awkward_pages(spark, model):
    schema = "page_id long, url string, html string, text int, n_chars string, model string, lang string"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "   "), (3, "u", page(PROSE)), (3, "u", page(PROSE)), (4, "v", "<"),
            (5, "v", "<p>"), (6, "v", "<!-- " + PROSE), (7, "v", page(f"<article>{PROSE * 2000}</article>", MENU))]
    pages = spark.createDataFrame([(*r, 1, "2", "m", "de") for r in rows], schema)
    told = extraction.extract(pages, model)
    assert told.columns == ["page_id", "url", "text", "n_chars"]
    got = [(r["page_id"], r["text"]) for r in told.collect()]
    assert sorted((i or 0, t) for i, t in got if i != 4) == sorted(
        [(1, ""), (2, ""), (0, ""), (3, PLAIN), (3, PLAIN), (5, ""), (6, ""), (7, " ".join([PLAIN] * 2000))])
    empty = spark.createDataFrame([], schema)
    assert extraction.extract(empty, extraction.fit(empty)).count() == 0


@pytest.mark.parametrize("part", ["<a ", "<p>", "<div>", "<!-- ", "<ul><li>", "<", "<a '\">", "</div>", "<script>", "&amp",
                                  "<p><b class=x>", "<li><div>", '<a "', "<span class=x>"])
def test_hostile_pages_take_linear_time(part):
    start = time.perf_counter()
    parse(part * (1_000_000 // len(part)))
    assert time.perf_counter() - start < 20


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    label = (x[:, 0] > 0).astype(int) + (x[:, 0] > 0) * (x[:, 1] > 0.5)
    trees = boosting.fit(x[:2000], label[:2000], 3)
    assert (trees.scores(x[2000:]).argmax(1) == label[2000:]).mean() > 0.97
