"""Divergences against exact integers over every term and every two sources."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from finmart.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, tile int, value long, rank string"


def rows():
    rng = random.Random(9)
    names = "the of And tree É größe x".split() + [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(rng.choice(names) + rng.choice([" ", ".", "9", "\x00"]) for _ in range(rng.randint(1, 40)))
             for _ in range(150)]
    texts += [None, "", "123 ...", "longword" * 3000, *["hot text of copies"] * 60]
    places = [(lang, source) for lang in ("en", "de", None, "") for source in ("s1", "S2", None, "é", "s10", "s3")]
    held = [(t, *(places[i % len(places)] if i < 150 else ("en", "hot"))) for i, t in enumerate(texts)]
    held += [("42", "xx", "only"), (None, "yy", "a"), ("", "yy", "b")]
    return [(i, *h, "t", 1, 2, "r") for i, h in enumerate(held)]


def expected(held, least, top):
    docs, counts, groups = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source, *_ in held:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs.update({(lang, w) for w in words})
        counts.update((lang, source, w) for w in words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (k, w), n in docs.items() if k == lang and n >= least]
        sources = sorted((s for k, s in groups if k == lang), key=str.encode)

        def p(count):
            total = sum(count.values())
            return {w: 1 + 10**9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        count = {s: {w: counts[lang, s, w] for w in kept} for s in sources}
        share = {s: p(count[s]) for s in sources}
        whole = p({w: sum(count[s][w] for s in sources) for w in kept})
        for s in sources:
            pairs = [(-sum(abs(share[s][w] - share[t][w]) for w in kept), t.encode(), t) for t in sources if t != s]
            terms = [(share[s][w] - whole[w], w) for w in kept if count[s][w] and share[s][w] > whole[w]]
            terms = [(-f, w.encode(), w) for f, w in terms]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("tile,stripe_bytes,cells", [(512, 1 << 24, 2_000_000), (2, 300, 8)])
def test_audit(spark, monkeypatch, tile, stripe_bytes, cells):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CELLS", cells)
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    for least, top in ((3, 50), (1, 2)):
        got = divergence.audit(docs, least=least, top=top, stripe_bytes=stripe_bytes)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        told = [tuple(r) for r in got.collect()]
        assert set(told) == expected(rows(), least, top) and len(told) == len(set(told))


def test_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    assert divergence.audit(spark.createDataFrame(rows()[-3:], SCHEMA)).where("value <> 0").count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    pairs = [(rng.randrange(b + 1), b) for b in itertools.chain([1, 7, 9 * 10**15 - 1], (rng.randrange(1, 10**15) for _ in range(500)))]
    got = divergence.shares(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert got.tolist() == [1 + 10**9 * a // b for a, b in pairs]
