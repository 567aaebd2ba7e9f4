"""Benchmark decontamination by a broadcast set of hashed word windows.

The windows of all benchmark items are hashed and sorted. A worker hashes every window of a document, looks the hashes
up, compares the words of each hit with the item's, and marks the words that a true hit covers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import WordHashes, alnum_words, ngram_hashes, sliced, texts
from finmart.session import written

WINDOW_WORDS = 10
# Benchmark text that one broadcast may hold; a larger benchmark is scanned in slices of this size.
SLICE_BYTES = 32 * 1024 * 1024


class Index:
    """Windows of one slice of the benchmark: sorted hashes per length, with the words and all items behind each."""

    def __init__(self, items: list[tuple[object, bytes | None]], window: int):
        self.words = [alnum_words(raw) for _, raw in items]
        self.names = [name for name, _ in items]
        hashes = WordHashes()
        found: dict[int, list] = {}
        for i, words in enumerate(self.words):
            if words:
                length = min(window, len(words))
                values = ngram_hashes(hashes.of(words), length)
                found.setdefault(length, []).append((values, np.full(len(values), i), np.arange(len(values))))
        self.tables = []
        for length, parts in sorted(found.items()):
            values, item, start = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(values, kind="stable")
            self.tables.append((length, *self._distinct(length, values[order], item[order], start[order])))

    def _distinct(self, length: int, values: np.ndarray, item: np.ndarray, start: np.ndarray):
        """Equal windows as one: hashes, an item and place of each, and the items of those that stand more than once."""
        edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        sizes = np.diff(np.r_[edges, len(values)])
        keep, members = np.zeros(len(values), bool), {}
        keep[edges[sizes == 1]] = True
        for a, n in zip(edges[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            found: dict[tuple, int] = {}
            for k in range(a, a + n):
                i, s = int(item[k]), int(start[k])
                first = found.setdefault(tuple(self.words[i][s:s + length]), k)
                keep[first] = True
                members.setdefault(first, set()).add(i)
        kept = np.flatnonzero(keep)
        place = {k: p for p, k in enumerate(kept.tolist()) if k in members}
        return values[kept], item[kept], start[kept], {place[k]: held for k, held in members.items()}

    def hits(self, words: list[bytes], hashed: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words an occurring window covers, and the items with occurring windows."""
        covered = np.zeros(len(words) + 1, np.int64)
        items: set[int] = set()
        for length, values, item, start, members in self.tables:
            seen: set[int] = set()
            runs = ngram_hashes(hashed, length)
            if not len(runs):
                continue
            low = np.searchsorted(values, runs)
            low[low == len(values)] = 0
            for at in np.flatnonzero(values[low] == runs).tolist():
                k, here, true = int(low[at]), words[at:at + length], False
                while k < len(values) and values[k] == runs[at]:
                    i, s = int(item[k]), int(start[k])
                    if self.words[i][s:s + length] == here:
                        seen.add(k)
                        true = True
                    k += 1
                if true:
                    covered[at] += 1
                    covered[at + length] -= 1
            for k in seen:
                items |= members.get(k) or {int(item[k])}
        return np.cumsum(covered)[:-1] > 0, items


def spans_of(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First word and word count of each run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()


def _scan(shared, window: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, window)
        hashes = WordHashes()
        for batch in batches:
            counts, starts, lengths, names = [], [], [], []
            for raw in texts(batch):
                words = alnum_words(raw)
                hit, items = index.hits(words, hashes.of(words))
                first, long = spans_of(hit)
                counts.append(len(words))
                starts.append(first)
                lengths.append(long)
                names.append(sorted({index.names[i] for i in items if index.names[i] is not None}))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
                pa.array(lengths, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))], names=columns)
    return run


def _slices(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list]:
    """The items in slices of bounded bytes, streamed to the driver a partition at a time."""
    kept, size = [], 0
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    for row in rows.where("text IS NOT NULL").toLocalIterator():
        raw = row["text"].encode()
        if kept and size + len(raw) > limit:
            yield kept
            kept, size = [], 0
        kept.append((row["item"], raw))
        size += len(raw)
    yield kept


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
         slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``id``, ``n_words``, ``starts``, ``lengths`` (runs of hit words), ``items`` (sorted strings), a row per document.

    An item of fewer than ``window`` words is one window; an item without words or text has none. The windows of an item
    without an id hit, but there is no id to list. NULL and empty documents have no words. Items that repeat an id count
    once, and repeated documents stay rows. A benchmark beyond ``slice_bytes`` is scanned slice by slice: a slice is read,
    scanned and its finds stored before its place in memory goes to the one after the next, and the finds of a document
    are put together by its row number.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spark, columns = docs.sparkSession, ["id", "n_words", "starts", "lengths", "items"]
    kind = slim.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_words bigint, starts array<bigint>, lengths array<bigint>, items array<string>"
    parts = _broadcasts(spark, benchmark, item_col, item_text_col, slice_bytes)
    part, following = next(parts), next(parts, None)
    if following is None:
        return slim.mapInArrow(_scan(part, window, columns), shape)
    frozen = written(slim.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "scanned")
    numbered, told = frozen.select(F.col("row").alias("id"), "text"), None
    while part is not None:
        one = numbered.mapInArrow(_scan(part, window, columns), shape.replace(f"id {kind}", "id bigint", 1))
        # the first slice lists every document, the others those that it hits
        one = written(one if told is None else one.where(F.size("starts") > 0), "finds")
        part.destroy()
        told = one if told is None else told.unionByName(one)
        part, following = following, next(parts, None)
    merged = told.groupBy("id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list(F.arrays_zip("starts", "lengths"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # runs of several slices may overlap: words are listed and counted once
    words = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["starts"], r["starts"] + r["lengths"] - 1)))))
    apart = merged.withColumn("words", words).select(
        F.col("id").alias("row"), "n_words", F.col("words").alias("starts"),
        F.transform("words", lambda w: F.lit(1).cast("long")).alias("lengths"), "items")
    return frozen.select("row", "id").join(apart, "row").select(*columns)


def _broadcasts(spark, benchmark: DataFrame, item_col: str, text_col: str, limit: int):
    for part in _slices(benchmark, item_col, text_col, limit):
        yield spark.sparkContext.broadcast(part)


def report(found: DataFrame) -> DataFrame:
    """``id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    hit = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select("id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def _cleaned(shared, window: int, text_col: str, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, window)
        hashes = WordHashes()
        for batch in sliced(batches, text_col):
            keep, out = [], []
            for raw in texts(batch, text_col):
                words = alnum_words(raw)
                hit = index.hits(words, hashes.of(words))[0] if words else np.zeros(0, bool)
                keep.append(spans or not hit.any())
                out.append(_without(raw, hit) if hit.any() else raw and raw.decode())
            if spans:
                at = batch.schema.get_field_index(text_col)
                yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
            else:
                yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def _without(raw: bytes, hit: np.ndarray) -> str:
    """The text without the bytes from the first to the last word of each run of hit words."""
    kept, position, at = [], 0, 0
    words = alnum_words(raw)
    low = raw.lower()
    for i, word in enumerate(words):
        start = low.index(word, at)
        at = start + len(word)
        if hit[i]:
            if not (i and hit[i - 1]):
                kept.append(raw[position:start])
            position = at
    return b"".join([*kept, raw[position:]]).decode()


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = False, text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
           slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Documents without contamination: contaminated ones go, or with ``spans`` lose the hit runs of their text.

    All columns and all other rows stay as they are, in one pass over the documents. A benchmark beyond ``slice_bytes``
    gives the same: documents go slice by slice, and spans are cut once, after all slices have told theirs.
    """
    parts = _broadcasts(docs.sparkSession, benchmark, item_col, item_text_col, slice_bytes)
    part, following = next(parts), next(parts, None)
    if spans and following is not None:
        return _cut_once(docs, benchmark, text_col, item_col=item_col, item_text_col=item_text_col, window=window,
                         slice_bytes=slice_bytes)
    while part is not None:
        docs = docs.mapInArrow(_cleaned(part, window, text_col, spans), docs.schema)
        if following is not None:
            docs = written(docs, "cleaned")
            part.destroy()
        part, following = following, next(parts, None)
    return docs


def _cut_once(docs: DataFrame, benchmark: DataFrame, text_col: str, **options) -> DataFrame:
    """The documents without the words that :func:`scan` finds in their whole texts."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "uncut")
    found = scan(rows, benchmark, row, text_col, **options).where(F.size("starts") > 0)
    runs = found.select(F.col("id").alias(row), F.struct("starts", "lengths").alias(f"{row}runs"))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, told in zip(texts(batch, text_col), batch.column(batch.num_columns - 1).to_pylist()):
                if told:
                    hit = np.zeros(len(alnum_words(raw)), bool)
                    for start, length in zip(told["starts"], told["lengths"]):
                        hit[start:start + length] = True
                    out.append(_without(raw, hit))
                else:
                    out.append(raw and raw.decode())
            kept = batch.select(list(range(batch.num_columns - 1)))
            at = kept.schema.get_field_index(text_col)
            yield kept.set_column(at, kept.schema.field(at), pa.array(out, kept.schema.field(at).type))

    whole = rows.join(runs, row, "left").select(*(F.col(f"`{c}`") for c in docs.columns), f"{row}runs")
    return whole.mapInArrow(run, schema)
