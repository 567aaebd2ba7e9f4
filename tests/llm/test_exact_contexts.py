"""Features of exact contexts, which grow with the corpus."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finmart.llm import lm_score


def test_changed_probabilities_add_up():
    rng = np.random.default_rng(3)
    base = rng.dirichlet(np.ones(6), 40)
    entries = np.empty(40 * 6 * 3, lm_score.ENTRY)
    entries["context"] = np.repeat(np.arange(40), 18)
    entries["outcome"] = np.tile(np.arange(6), 120)
    entries["base"] = base[entries["context"].astype(int), entries["outcome"].astype(int)]
    # some tokens train; those of the last context never do
    trains = (rng.random(len(entries)) < 0.3) & (entries["context"] < 39)
    entries["row"] = np.arange(len(entries)) + trains * lm_score.TRAINS
    entries = rng.permutation(entries)
    logs = lm_score.exact_logs(entries)
    changed = np.zeros((40, 6))
    changed[entries["context"].astype(int), entries["outcome"].astype(int)] = entries["base"] * 10**logs
    assert changed.sum(1) == pytest.approx(np.ones(40), abs=1e-5)
    assert np.abs(logs[entries["context"] == 39]).max() < 1e-12 and np.abs(logs).max() > 0.1


@pytest.mark.parametrize("entries", [lm_score.BUCKET_ENTRIES, 500])
def test_rare_words_learn_from_rare_words(spark, monkeypatch, entries):
    """Words beyond the vocabulary come in fixed pairs; only a feature of the two words themselves can tell."""
    monkeypatch.setattr(lm_score, "BUCKET_ENTRIES", entries)
    rng = random.Random(4)
    texts = [(i, " ".join(f"a{k} b{k}" for k in (rng.randrange(300) for _ in range(40)))) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    scored = lm_score.score_documents(df, vocabulary_size=20).where("held_out")
    base, score = scored.agg(F.sum("base_score"), F.sum("score")).first()
    # half of the words are all but certain
    assert score > 0.75 * base
