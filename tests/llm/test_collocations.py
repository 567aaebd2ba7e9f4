"""Phrases against a brute-force count of all runs, with groups so small that common prefixes are extended."""

import collections
import random
import re

import numpy as np
import pytest

from finmart.llm import collocations

SCHEMA = "doc_id long, text string, lang string, word string, h long, n string, g int, rank int"


def rows():
    rng = random.Random(3)
    names = "the of And tree É größe a\x00b x 12".split(" ")
    texts = [" ".join(rng.choice(names) + rng.choice(["", "", "", ",", ".", "\t", "!"]) for _ in range(rng.randint(1, 60)))
             for _ in range(60)]
    texts += ["hot passage that very many documents share"] * 200
    texts += [None, "", " \t\n", "....", "one", "the " * 5000, "tree of\rtree of\x0btree of"]
    langs = ["en", "de", None, "und", ""]
    return [(i, t, langs[i % 5] if i < 60 else "en", "x", 1, "y", 2, 3) for i, t in enumerate(texts)]


def expected(held, least, top):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in held:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        cand = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        inside = {d[i:j] for d, b in cand.items() for i in range(len(d)) for j in range(i + 2, len(d) + 1)
                  if j - i < len(d) and b >= cand[d[i:j]]}
        scored = []
        for w, a in cand.items():
            if w not in inside:
                score, _, left, right = min((1000 * a * total[lang] // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]])
                                            for k in range(1, len(w)))
                scored.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, total[lang], -score)
    return out


@pytest.mark.parametrize("budget,held", [(2_000_000, 1_000_000), (150, 30)])
def test_phrases(spark, monkeypatch, budget, held):
    monkeypatch.setattr(collocations, "HELD_SUFFIXES", held)
    monkeypatch.setattr(collocations, "GROUP_SUFFIXES", budget)
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    for least, top in ((4, 12),) if budget > 150 else ((3, 2000),):
        got = collocations.phrases(docs, least=least, top=top, budget=budget)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {(r[0], r[1]): tuple(r)[2:] for r in got.collect()} == expected(rows(), least, top)


def test_nothing(spark):
    assert collocations.phrases(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.phrases(spark.createDataFrame(rows()[:5], SCHEMA)).count() == 0


def test_clash_of_words(spark, monkeypatch):
    """Words that share a hash are told apart by another seed."""
    spark.createDataFrame([("a",)], "word string")
    real = collocations.F.xxhash64
    tried = []

    def clashing(salt, *columns):
        tried.append(salt)
        return real(salt, *columns).bitwiseAND(3) + 1 if len(tried) == 1 else real(salt, *columns)

    monkeypatch.setattr(collocations.F, "xxhash64", clashing)
    got = collocations.phrases(spark.createDataFrame(rows(), SCHEMA), least=3, top=2000)
    assert len(tried) == 2 and {(r[0], r[1]): tuple(r)[2:] for r in got.collect()} == expected(rows(), 3, 2000)


def test_equal_keys_are_not_equal_suffixes(monkeypatch):
    monkeypatch.setattr(collocations, "_keys", lambda rows: np.zeros(rows.shape, np.uint64))
    rows = np.array([[1, 2, 0, 0, 0], [1, 3, 0, 0, 0], [1, 2, 0, 0, 0], [1, 2, 0, 0, 0]], np.uint64)
    told, count = collocations._combined(rows, np.array([1, 1, 1, 1]))
    total = {}
    for row, n in zip(map(tuple, told.tolist()), count.tolist()):
        total[row] = total.get(row, 0) + n
    assert total == {(1, 2, 0, 0, 0): 3, (1, 3, 0, 0, 0): 1}
