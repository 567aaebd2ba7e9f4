"""Licence notices by a positional index of rare words, in DataFrame operations only.

The index holds, for the words of each template that are rarest in the corpus, their places in the template. A text's
occurrences of indexed words propose where a template would begin; a begin that enough of the template's rare words
agree on is kept, and the template's mandatory phrase must stand there word by word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.session import written


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # the mandatory phrase, a part of the text
    base: bool = False


# Phrases that alone decide, then notices of the method's own.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files", "permission is hereby granted free of charge to any person"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                         "license at http www apache org licenses license 2 0", "http www apache org licenses license 2 0"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("gpl-2", "this program is licensed under the gnu general public license version 2",
             "gnu general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             "gnu lesser general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
                    "that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                    "hereby granted", "permission to use copy modify and or distribute this software"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license",
             "creative commons attribution noncommercial"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license",
             "creative commons attribution sharealike"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
)
_WORD = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rare words by which a template is looked up, and how many must agree on where it begins (all where it has fewer).
ANCHORS, AGREE = 4, 2


def _words(text_col: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(_WORD), 1)


def _plain(word: Column) -> Column:
    return F.translate(word, _UPPER, _LOWER)


def document_frequencies(df: DataFrame, words: list[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and in how many of them each of the given words occurs, over all texts."""
    held = F.array_distinct(F.filter(F.transform(_words(text_col), lambda w: F.lower(w)), lambda w: w.isin(words)))
    # the empty string stands for the document itself
    rows = df.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in rows.collect()}
    return counts.pop("", 0), counts


def index(templates: tuple[Template, ...], documents: int, frequency: dict[str, int], anchors: int = ANCHORS) -> list[tuple]:
    """Postings (word, template, place, anchors of the template) of each template's rarest words."""
    def rarity(word: str) -> tuple[float, str]:
        return -math.log((1 + documents) / (1 + frequency.get(word, 0))), word

    rows = []
    for number, template in enumerate(templates):
        words = template.text.split()
        chosen = sorted(set(words), key=rarity)[:anchors]
        places = [(words.index(word), word) for word in chosen]
        rows += [(word, number, place, len(chosen)) for place, word in places]
    return rows


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES,
         anchors: int = ANCHORS, agree: int = AGREE) -> tuple[DataFrame, DataFrame]:
    """(documents, notices): ``row``, ``id``, ``n_words`` of all rows; ``row``, ``template``, ``start``, ``coverage``,
    ``found`` of each place where a template's rare words agree.

    Words are runs of letters, digits and non-ASCII characters with A-Z in lower case. NULL and empty texts have none.
    Rows that repeat an id or have none stay rows of their own. ``coverage`` is the share of the template's words that
    stand where they should; ``found`` says that the mandatory phrase does. ``start`` is negative where a template would
    begin before the text, which then opens with its mandatory phrase or words before that. An empty table gives two empty tables.
    """
    spark = df.sparkSession
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    postings = index(templates, *document_frequencies(df, vocabulary, text_col), anchors)
    looked_up = sorted({p[0] for p in postings})
    reach = max(len(t.text.split()) for t in templates)
    split = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), _words(text_col).alias("words"))

    def near(word: Column, place: Column) -> Column:
        """A looked-up word with its place and the words around it."""
        begin = F.greatest(place - reach, F.lit(0))
        around = F.transform(F.slice("words", begin + 1, F.lit(2 * reach + 1)), _plain)
        return F.when(F.lower(word).isin(looked_up), F.struct(
            _plain(word).alias("word"), place.alias("place"), begin.alias("begin"), around.alias("around")))

    hits = F.filter(F.transform("words", near), lambda h: h.isNotNull())
    stored = written(split.select("id", F.size("words").cast("long").alias("n_words"), hits.alias("hits")).withColumn(
        "row", F.monotonically_increasing_id()), "licence-hits")

    # the index and the templates are fixed and small
    entries = spark.createDataFrame(
        [(*p, t.text.split(), _at(t), t.key.split())
         for p in postings for t in [templates[p[1]]]],
        "word string, template int, at int, anchors int, text array<string>, key_at int, key array<string>")
    seen = stored.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    # a template may begin before the text when its mandatory phrase lies in it
    met = seen.join(F.broadcast(entries), "word").withColumn("start", F.col("place") - F.col("at")).where("start + key_at >= 0")
    here = F.col("start") - F.col("begin")
    before = F.greatest(-here, F.lit(0))
    inside = F.slice("text", before + 1, F.size("text"))
    stands = F.slice("around", here + before + 1, F.size("text") - before)
    same = F.size(F.filter(F.zip_with(inside, stands, lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))
    checked = met.where((F.col("start") >= F.col("begin")) | (F.col("begin") == 0)).select(
        "row", "template", "start", "anchors", (same / F.size("text")).alias("coverage"),
        (F.slice("around", here + F.col("key_at") + 1, F.size("key")) == F.col("key")).alias("found"))
    notices = checked.groupBy("row", "template", "start").agg(
        F.count(F.lit(1)).alias("agreed"), F.max("anchors").alias("anchors"), F.max("coverage").alias("coverage"),
        F.max("found").alias("found")).where(F.col("agreed") >= F.least(F.col("anchors"), F.lit(agree)))
    return stored.select("row", "id", "n_words"), notices.select("row", "template", "start", "coverage", "found")


def _at(template: Template) -> int:
    """Word place of the mandatory phrase in the template."""
    words, key = template.text.split(), template.key.split()
    return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def report(documents: DataFrame, notices: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` per document.

    ``score`` is the best coverage of a notice, halved where the mandatory phrase is missing; 0 without any.
    """
    spark = documents.sparkSession
    names = spark.createDataFrame([(i, t.label, t.base) for i, t in enumerate(templates)], "template int, label string, base boolean")
    told = notices.join(F.broadcast(names), "template")
    base = F.col("base") & F.col("found")
    labels = [F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",") for c in (base, F.col("found"))]
    per_row = told.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), labels[0].alias("base_labels"), labels[1].alias("labels"),
        F.max(F.when(F.col("found"), F.col("coverage")).otherwise(F.col("coverage") / 2)).alias("score"))
    return documents.join(per_row, "row", "left").select(
        "id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
