"""What lies on disk while a query runs: no shuffle of a step that has ended, no row twice where once will do."""

import random

import pytest

from finmart.llm import jaccard_join, lm_score
from finmart.session import written


def shuffles(spark):
    """Shuffles whose files are still there."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def test_a_stored_step_leaves_no_shuffle(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).selectExpr("id % 100 AS k", "id").groupBy("k").count()
    before, setting = shuffles(spark), spark.conf.get(key)
    table = written(df.join(df.withColumnRenamed("count", "n"), "k").repartition(3, "k"), "step")
    assert table.count() == 100 and written(table, "again").count() == 100
    left = shuffles(spark)
    assert spark.conf.get(key) == setting
    assert left <= before + 2  # those of the two counts


def texts(n=150, words=400):
    """Texts of many lengths that share a few runs of words by chance, and near copies."""
    rng = random.Random(7)
    runs = [" ".join(f"r{k}w{j}" for j in range(6)) for k in range(60)]
    out = []
    for i in range(n):
        own = [f"d{i}x{j}" for j in range(int(words * 1.012 ** (i % 40)))]
        for k in rng.sample(range(60), 3):
            own.insert(rng.randrange(len(own)), runs[k])
        out.append(" ".join(own))
        if i % 5 == 0:
            for _ in range(4):
                near = list(own)
                near[rng.randrange(len(near))] = "changed"
                cut = rng.randrange(int(len(near) * 0.1))
                out.append(" ".join(near[cut:]))
    return list(enumerate(out))


def oracle(rows, words=4, percent=85):
    sets = []
    for _, text in rows:
        w = text.split()
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)})
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
    return links


def test_texts_that_cannot_link_do_not_travel(spark, monkeypatch):
    """Documents that only share a rare run of words stay where they are; the linked ones are all found."""
    stored = {}
    monkeypatch.setattr(jaccard_join, "written", lambda df, label: stored.setdefault(label, written(df, label)))
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["id"]: r["n_links"] for r in jaccard_join.similar_documents(df, rounds=1).collect()}
    links = oracle(rows)
    assert got == dict(enumerate(links)) and sum(n > 0 for n in links) == 150
    assert stored["wanted"].select("id").distinct().count() <= 1.2 * 150


def prose(n, words):
    """Texts of common and rare words, one without an id and one without words among them."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 50_000}" for _ in range(words))) for i in range(n)]
    return [*rows, (None, "w1 w2 w3 w777777"), (n, None), (3, rows[3][1])]


def test_tokens_in_exact_contexts_are_not_stored(spark, monkeypatch):
    """They are shuffled round by round; a table of them took some thirty bytes for each context of a token."""
    stored = []
    monkeypatch.setattr(lm_score, "written", lambda df, label: stored.extend(df.columns) or written(df, label))
    df = spark.createDataFrame(prose(20, 30), "doc_id long, text string")
    assert lm_score.score_documents(df, steps=1).count() == 23
    assert stored and "entries" not in stored


def test_rounds_do_not_change_scores(spark, monkeypatch):
    df = spark.createDataFrame(prose(120, 150), "doc_id long, text string").repartition(2)

    def scores():
        rows = lm_score.score_documents(df, vocabulary_size=300, steps=2).collect()
        return sorted((str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows)

    once = scores()
    monkeypatch.setattr(lm_score, "BUCKET_ENTRIES", 3000)
    monkeypatch.setattr(lm_score, "ROUND_BUCKETS", 2)
    for a, b in zip(once, scores(), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
