"""How far the sources of a language differ in their words, by in-mapper stripes.

A map task folds whole documents into one stripe a term, its document frequency and its count at each source, in a hash
table that is spilled when the texts behind it reach ``STRIPE_BYTES``. Spills meet sorted by key and are merged term by
term as they stream by, so a task holds one stripe however many spills a common term has. A merged stripe tells at once
what its term adds to the divergence of every two sources and of each source from its language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.words import Splitter, blocks
from finmart.session import spread, written

MIN_DOCUMENTS = 30
SMOOTHING = 5
TOP_TERMS = 50
# Text that is folded before its stripes are spilled.
STRIPE_BYTES = 16 * 1024 * 1024
# Sources of a language compared in one table of a task; more are compared in tiles of two times as many.
TILE = 512
# Cells of a dense block of stripes.
CELLS = 2_000_000
_SEPARATORS = [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_STRIPE = "lang int, term string, df bigint, sources array<int>, counts array<bigint>"


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * count / total), exact for 0 <= count <= total < 9 * 10**15: three steps of long division."""
    rest, out = count, np.zeros_like(count)
    for _ in range(3):
        step = rest * 1000
        out = out * 1000 + step // total
        rest = step % total
    return out + 1


def _ragged(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))


def _stripes(lang: np.ndarray, term: pa.Array, df: np.ndarray, row: np.ndarray, source: np.ndarray,
             count: np.ndarray) -> pa.RecordBatch:
    """Stripes of cells that are sorted by row."""
    sizes = np.bincount(row, minlength=len(lang))
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.int32()), term.cast(pa.string()), pa.array(df, pa.int64()),
         _ragged(source.astype(np.int32), sizes), _ragged(count.astype(np.int64), sizes)],
        ["lang", "term", "df", "sources", "counts"])


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, source, count) of a batch of stripes."""
    lists = batch.column("sources")
    return (pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy(),
            batch.column("counts").flatten().to_numpy())


def _fold(shared, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, place = shared.value
        splitter = Splitter(_SEPARATORS)
        for lang, block, sources in blocks(batches, "lang", "source", most):
            words = splitter.split(block)
            if not len(words.codes):
                continue
            number, size = place[lang]
            source = np.array([number[s] for s in sources])
            code = words.codes.astype(np.int64)
            cell, count = np.unique(code * len(number) + source[words.doc], return_counts=True)
            seen = np.unique(code * len(block) + words.doc) // len(block)
            terms = len(words.dictionary)
            yield _stripes(np.full(terms, size), words.dictionary, np.bincount(seen, minlength=terms),
                           cell // len(number), cell % len(number), count)
    return run


def _joined(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring stripes of one term as one."""
    lang, term = batch.column("lang").to_numpy(), batch.column("term")
    new = np.ones(batch.num_rows, bool)
    new[1:] = (lang[1:] != lang[:-1]) | pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    row, source, count = _cells(batch)
    wide = int(source.max(initial=0)) + 1
    key = group[row] * wide + source
    order = np.argsort(key, kind="stable")
    key = key[order]
    edges = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[edges]
    return _stripes(lang[first], term.take(pa.array(first)), np.add.reduceat(batch.column("df").to_numpy(), first),
                    key // wide, key % wide, np.add.reduceat(count[order], edges))


def _merge(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = [b for b in (held, batch) if b is not None]
            merged = _joined(pa.concat_batches([b.cast(both[0].schema) for b in both]))
            held, done = merged.slice(merged.num_rows - 1), merged.slice(0, merged.num_rows - 1)
            yield done.filter(pc.greater_equal(done.column("df"), least))
        if held is not None:
            yield held.filter(pc.greater_equal(held.column("df"), least))
    return run


def _tiles(sources: int) -> list[tuple[range, range]]:
    """Pairs of ranges of sources; every two sources meet in one pair."""
    parts = [range(a, min(a + TILE, sources)) for a in range(0, sources, TILE)]
    return [(a, b) for i, a in enumerate(parts) for b in parts[i:]]


def _emit(shared, top: int):
    """Partial sums for every two sources of a tile, and the leading terms of every source in a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, whole = shared.value
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            row, source, count = _cells(batch)
            lang, tile = batch.column("lang").to_numpy(), batch.column("tile").to_numpy()
            for number in np.unique(lang).tolist():
                total, all_of = totals[number], whole[number]
                rows = np.flatnonzero((lang == number) & (tile == 0))
                mine = np.isin(row, rows)
                yield _leading(number, batch.column("term"), row[mine], source[mine], count[mine], total, all_of, top)
                for part in np.unique(tile[lang == number]).tolist():
                    a, b = _tiles(len(total))[part]
                    kept = np.array(sorted({*a, *b}))
                    rows = np.flatnonzero((lang == number) & (tile == part))
                    step = max(1, CELLS // len(kept))
                    for start in range(0, len(rows), step):
                        some = rows[start:start + step]
                        inside = np.isin(row, some) & np.isin(source, kept)
                        dense = np.full((len(some), len(kept)), SMOOTHING, np.int64)
                        dense[np.searchsorted(some, row[inside]), np.searchsorted(kept, source[inside])] += count[inside]
                        dense = shares(dense, total[kept])
                        held = sums.setdefault((number, part), np.zeros((len(a), len(b)), np.int64))
                        right = dense[:, np.searchsorted(kept, b)]
                        for i, column in enumerate(np.searchsorted(kept, a).tolist()):
                            held[i] += np.abs(right - dense[:, column, None]).sum(0)
        for (number, part), held in sums.items():
            a, b = _tiles(len(totals[number]))[part]
            left, right = np.repeat(np.array(a), len(b)), np.tile(np.array(b), len(a))
            apart = left != right
            left, right, value = left[apart], right[apart], held.ravel()[apart]
            if a != b:
                left, right, value = np.r_[left, right], np.r_[right, left], np.r_[value, value]
            yield _told(number, left, right, None, value)
    return run


def _told(lang: int, source: np.ndarray, other: np.ndarray | None, term: pa.Array | None, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, lang), pa.int32()), pa.array(source, pa.int32()),
         pa.nulls(n, pa.int32()) if other is None else pa.array(other, pa.int32()),
         pa.nulls(n, pa.string()) if term is None else term, pa.array(value, pa.int64())],
        ["lang", "source", "other", "term", "value"])


def _leading(lang: int, term: pa.Array, row: np.ndarray, source: np.ndarray, count: np.ndarray, total: np.ndarray,
             whole: int, top: int) -> pa.RecordBatch:
    """Terms commoner at a source than in its language, the ``top`` of each source and all that tie with the last."""
    in_lang = np.zeros(len(term), np.int64)
    np.add.at(in_lang, row, count)
    value = shares(count + SMOOTHING, total[source]) - shares(in_lang[row] + SMOOTHING, np.full(len(row), whole))
    place = np.flatnonzero(value > 0)
    place = place[np.lexsort((-value[place], source[place]))]
    first = np.flatnonzero(np.diff(source[place], prepend=-1))
    size = np.diff(np.r_[first, len(place)])
    cut = value[place[first + np.minimum(size, top) - 1]] if len(first) else value[:0]
    place = place[value[place] >= np.repeat(cut, size)]
    return _told(lang, source[place], None, term.take(pa.array(row[place])), value[place])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least: int = MIN_DOCUMENTS, top: int = TOP_TERMS, stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value``, ``rank``.

    A language keeps the terms in at least ``least`` of its documents; the share of a term is smoothed and exact. Part
    ``pair`` tells every other source of the language with the summed differences of shares, also where no term is kept
    (0) and for sources without terms. Part ``term`` tells the ``top`` terms that are commoner at the source than in the
    language. Ties go to the smaller item by its bytes. NULL text, language and source are empty; repeated rows count each;
    an empty table gives an empty one. Other columns of ``docs`` are not read.

    The list of (language, source) groups goes to the driver and every task: the result has a row for each two of them, so
    it is as small as the square root of what is asked for.
    """
    spark = docs.sparkSession
    slim = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    groups: dict[str, list[str]] = {}
    for row in slim.select("lang", "source").distinct().collect():
        groups.setdefault(row["lang"], []).append(row["source"])
    langs = sorted(groups)
    for found in groups.values():
        found.sort(key=str.encode)
    place = {lang: ({s: i for i, s in enumerate(groups[lang])}, n) for n, lang in enumerate(langs)}
    folded = spread(slim, "text").mapInArrow(_fold(spark.sparkContext.broadcast((langs, place)), stripe_bytes), _STRIPE)
    merged = written(folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(
        _merge(least), _STRIPE), "stripes")

    sizes = {r["lang"]: r["terms"] for r in merged.groupBy("lang").agg(F.count("*").alias("terms")).collect()}
    totals = [np.full(len(groups[lang]), SMOOTHING * sizes.get(n, 0), np.int64) for n, lang in enumerate(langs)]
    cells = merged.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("cell"))
    for row in cells.groupBy("lang", F.col("cell.sources").alias("source")).agg(F.sum("cell.counts").alias("n")).collect():
        totals[row["lang"]][row["source"]] += row["n"]
    whole = [int(t.sum() - (len(t) - 1) * SMOOTHING * sizes.get(n, 0)) for n, t in enumerate(totals)]

    tiles = [len(_tiles(len(groups[lang]))) for lang in langs]
    number = F.element_at(F.array(*map(F.lit, tiles or [1])), F.col("lang") + 1)
    rows = merged.withColumn("tile", F.explode(F.sequence(F.lit(0), number - 1)))
    if max(tiles, default=1) > 1:
        rows = rows.repartition("lang", "tile", F.pmod(F.hash("term"), F.lit(16)))
    told = written(rows.mapInArrow(
        _emit(spark.sparkContext.broadcast((totals, whole)), top),
        "lang int, source int, other int, term string, value bigint"), "divergences")

    names = spark.createDataFrame([(n, i, lang, s) for n, lang in enumerate(langs) for i, s in enumerate(groups[lang])],
                                  "lang int, source int, lang_name string, source_name string")
    sums = told.where("term IS NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    other = names.select("lang", F.col("source").alias("other"), F.col("source_name").alias("item"))
    pairs = names.join(other, "lang").where("source <> other").join(sums, ["lang", "source", "other"], "left").select(
        "lang_name", "source_name", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    terms = told.where("term IS NOT NULL").join(F.broadcast(names), ["lang", "source"]).select(
        "lang_name", "source_name", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = []
    for part, most in ((pairs, None), (terms, top)):
        order = Window.partitionBy("lang_name", "source_name").orderBy(F.desc("value"), "item")
        part = part.withColumn("rank", F.row_number().over(order))
        ranked.append(part.where(F.col("rank") <= most) if most else part)
    return ranked[0].unionByName(ranked[1]).select(
        F.col("lang_name").alias("lang"), F.col("source_name").alias("source"), "part", "item", "value", "rank")
