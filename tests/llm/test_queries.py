"""The registered queries over whole small tables, and the pipeline against its operators' brute-force versions."""

import collections

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from finmart.llm import queries
from finmart.llm.base import table
from tests.compare import assert_same
from tests.llm.test_operators import alnum, jaccard_oracle

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert_same(queries.QUERIES[name](spark, FOLDER), duck.sql(queries.SQL[name]))


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    first = corpus_pipeline.quality_classifier(spark, docs, FOLDER)
    assert first.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    one = {i for i, (_, component, _) in jaccard_oracle(kept.items(), words=5, percent=80).items() if i == component}
    windows = collections.defaultdict(set)
    for r in table(spark, FOLDER, "benchmark").collect():
        words = alnum(r["text"])
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[n].add(tuple(words[i:i + n]))
    clean = set()
    for i in one:
        words = alnum(kept[i])
        if not any(tuple(words[a:a + n]) in held for n, held in windows.items() for a in range(len(words) - n + 1)):
            clean.add(i)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == clean
