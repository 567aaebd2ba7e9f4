"""Notices whose template would begin before the text."""

from finmart.llm import licenses


def test_a_text_may_open_with_the_mandatory_phrase(spark):
    texts = ["GNU General Public License version 3", "Mozilla Public License v 2.0 and more words", "public license version 3",
             "the GNU General Public License, version 3 follows", "General Public License version 3 gnu general"]
    # the words around the phrases are common, so those of the phrases are looked up
    texts += ["this work is licensed under the source code form subject to terms of"] * 20
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r["id"]: r for r in licenses.report(*licenses.scan(df)).collect()}
    assert [got[i]["labels"] for i in range(5)] == ["gpl-3", "mpl-2", "", "gpl-3", ""]
    assert got[0]["score"] == 6 / 12 and got[3]["score"] == 7 / 12
