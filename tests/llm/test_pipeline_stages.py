"""Stages of the pipeline on small tables of their own."""

import corpus_pipeline


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r["doc_id"] or -1, r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())


def test_near_duplicates_are_five_words_at_four_fifths(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles of five words
    more = [f"m{i}" for i in range(30)]
    whole = " ".join(words)
    appended = " ".join(words + more[:20])  # 100 of 120 shingles in common: 0.83
    exact = " ".join(words + more[:25])  # 100 of 125: 0.8
    longer = " ".join(more + words)  # 100 of 130 with the first: 0.77, with the others less
    assert kept(spark, [(1, whole), (2, appended)]) == [(1, whole)]
    assert kept(spark, [(1, whole), (2, exact)]) == [(1, whole)]
    assert kept(spark, [(1, whole), (2, longer)]) == [(1, whole), (2, longer)]


def test_near_duplicates_go_row_by_row(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    assert kept(spark, [(3, one), (5, one), (5, two)]) == [(3, one), (5, two)]
    assert kept(spark, [(1, one), (1, one), (1, one), (2, two)]) == [(1, one), (2, two)]
    assert kept(spark, [(None, one), (4, one), (None, two), (None, two), (None, ""), (None, "")]) == [
        (-1, ""), (-1, ""), (-1, two), (4, one)]
