"""Phrases whose words stand together more than chance has it, counted in depth-truncated suffix subtrees.

The words are counted first, then the pairs of frequent words, by 64-bit keys alone. A suffix is the run of frequent words
and pairs from a place of a piece on, five words at most; nothing beyond them can be in a candidate. Word prefixes are
extended by a word until each stands before no more suffixes than the memory budget of a group, and prefixes are put
together into groups of that budget. Every group takes its
suffixes, sorts them into a subtree and reads the counts of all phrases from the totals of its leaves, independently of
the others. Cuts, scores and the drop of contained phrases are joins of the frequent phrases.

A word is a 64-bit hash of its language and itself, with another seed if any two words of the table share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.base import mixed
from finmart.llm.words import Splitter, blocks
from finmart.session import spread, written

DEPTH = 5
LEAST = 100
TOP = 2000
# Suffixes of a group, which a task holds as 56 bytes each.
GROUP_SUFFIXES = 1_000_000
BLOCK_BYTES = 4 * 1024 * 1024
# Suffixes a map task holds before it adds up equal ones and hands them on.
HELD_SUFFIXES = 300_000
# Bits of the filters of frequent words and pairs, 32 MB each. Fuller filters let more through; the counts stay exact.
FILTER_BITS = 28
_SEPARATORS, _BREAKS = (9, 32), (*b".,;:!?", *range(10, 14))
_ROW = ["g", *(f"h{d}" for d in range(1, DEPTH + 1)), "n"]
_ROW_TYPE = ", ".join(f"{c} {'int' if c == 'g' else 'bigint'}" for c in _ROW)


def _hashes(lang: str, words: pa.BinaryArray, salt: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(salt.encode(), 42))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = Splitter(_SEPARATORS, _BREAKS)
    for lang, block, _ in blocks(batches, "lang", None, BLOCK_BYTES):
        words = splitter.split(block)
        count = np.bincount(words.codes, minlength=len(words.dictionary))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(count)), words.dictionary.cast(pa.string()), pa.array(count)], ["lang", "word", "n"])


class Filter:
    """A bit set that holds every frequent word or pair, and some others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(64 * len(bits) - 1)

    def __contains(self, slot: np.ndarray) -> np.ndarray:
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0

    def holds(self, words: np.ndarray) -> np.ndarray:
        return self.__contains(words & self.mask) & self.__contains((words >> np.uint64(32)) & self.mask)


def _filter(frequent: DataFrame) -> Filter:
    """The filter's non-empty longs, at most ``2 ** FILTER_BITS / 64`` rows, are put together by aggregates."""
    bits = min(FILTER_BITS, max(16, (16 * frequent.count()).bit_length()))
    mask = F.lit((1 << bits) - 1)
    slots = frequent.select(F.explode(F.array(
        F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("slot"))
    longs = slots.groupBy(F.shiftright("slot", 6).alias("place")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow()
    held = np.zeros(1 << (bits - 6), np.uint64)
    held[longs["place"].to_numpy()] = longs["bits"].to_numpy().view(np.uint64)
    return Filter(held)


def _next_key(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(key * np.uint64(0x9E3779B97F4A7C15) + word)


def _keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key of the first 1, 2, ... words of each suffix, by column."""
    out = rows.copy()
    for d in range(1, rows.shape[1]):
        out[:, d] = _next_key(out[:, d - 1], rows[:, d])
    return out


def _heavy_depth(keys: np.ndarray, lengths: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """How many prefixes of a suffix, from one word on, are too common for one group."""
    depth = np.zeros(len(keys), np.int64)
    for d, common in enumerate(heavy[:keys.shape[1]]):
        depth += (depth == d) & (lengths > d) & np.isin(keys[:, d], common)
    return depth


def _suffixes(words, hashed: np.ndarray, known: Filter, pairs: Filter | None, width: int) -> np.ndarray:
    """Word hashes of the frequent words and pairs from each place on, 0 beyond; places with such a pair."""
    hashed = np.where(known.holds(hashed), hashed, np.uint64(0))[words.codes] if len(hashed) else hashed
    n = len(hashed)
    pair = np.zeros(n, bool)
    pair[:-1] = (words.piece[1:] == words.piece[:-1]) & (hashed[:-1] > 0) & (hashed[1:] > 0)
    if pairs is not None:
        at = np.flatnonzero(pair)
        pair[at] = pairs.holds(_next_key(hashed[at], hashed[at + 1]))
    at = np.flatnonzero(pair)
    rows = np.zeros((len(at), width), np.uint64)
    rows[:, 0], rows[:, 1] = hashed[at], hashed[np.minimum(at + 1, n - 1)]
    on = np.ones(len(at), bool)
    for d in range(2, width):
        place = np.minimum(at + d - 1, n - 1)
        on &= pair[place]
        rows[on, d] = hashed[place[on] + 1]
    return rows


def _combined(rows: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal suffixes added up."""
    if not len(rows):
        return rows, count
    order = np.argsort(_keys(rows)[:, -1])
    rows, count = rows[order], count[order]
    # unequal suffixes that share a key may part equal ones, which are then handed on apart
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[new], np.add.reduceat(count, new)


def _map_suffixes(batches: Iterator[pa.RecordBatch], salt: str, known: Filter, pairs: Filter | None, width: int = DEPTH,
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(suffixes, counts) of a map task, the first ``width`` words of each, equal ones added up as far as it holds them."""
    splitter = Splitter(_SEPARATORS, _BREAKS)
    rows, count = np.zeros((0, width), np.uint64), np.zeros(0, np.int64)
    for lang, block, _ in blocks(batches, "lang", None, BLOCK_BYTES):
        words = splitter.split(block)
        more = _suffixes(words, _hashes(lang, words.dictionary, salt), known, pairs, width)
        rows, count = _combined(np.concatenate([rows, more]), np.concatenate([count, np.ones(len(more), np.int64)]))
        if len(rows) >= HELD_SUFFIXES:
            yield rows, count
            rows, count = rows[:0], count[:0]
    yield rows, count


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their sums, a place of each)."""
    found, first, place = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, count)
    return found, total, first


def _pairs(shared):
    """Counts of the pairs of frequent words, with the slot of their first word, -1 where it is too common for a group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, known, heavy, slots = shared.value
        for rows, count in _map_suffixes(batches, salt, known, None, 2):
            key, total, first = _summed(_keys(rows)[:, 1], count)
            word = rows[first, 0]
            slot = np.where(np.isin(word, heavy), -1, (mixed(word) & np.uint64(slots - 1)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(slot, pa.int32()), pa.array(total)], ["h", "slot", "n"])
    return run


def _extend(shared, depth: int):
    """Counts of the prefixes of ``depth`` words whose shorter prefixes are all too common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, known, pairs, heavy = shared.value
        for rows, count in _map_suffixes(batches, salt, known, pairs, depth):
            lengths, keys = (rows > 0).sum(1), _keys(rows)
            mine = (_heavy_depth(keys, lengths, heavy) == depth - 1) & (lengths >= depth)
            key, total, _ = _summed(keys[mine, depth - 1], count[mine])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(total)], ["h", "n"])
    return run


def _packed(rows: np.ndarray, count: np.ndarray) -> bytes:
    """A sorted run of suffixes, column by column: what neighbours share takes little room."""
    raw = b"".join([*(np.ascontiguousarray(c).tobytes() for c in rows.T), count.tobytes()])
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(block: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(block, 8 * (DEPTH + 1) * size, codec="zstd", asbytes=True), np.uint64)
    columns = raw.reshape(DEPTH + 1, size)
    return np.ascontiguousarray(columns[:DEPTH].T), columns[DEPTH].view(np.int64)


def _route(shared):
    """Every suffix to the group of its prefix, as a sorted run for each group that a map task's suffixes go to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, known, pairs, heavy, groups = shared.value
        for rows, count in _map_suffixes(batches, salt, known, pairs):
            lengths, keys = (rows > 0).sum(1), _keys(rows)
            depth = np.minimum(_heavy_depth(keys, lengths, heavy), lengths - 1)
            key = keys[np.arange(len(keys)), depth]
            group = groups[mixed(key) & np.uint64(len(groups) - 1)]
            order = np.lexsort([*rows.T[::-1], group])
            rows, count, group = rows[order], count[order], group[order]
            edges = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(group)]
            cuts = list(zip(edges, edges[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(group[a]) for a, _ in cuts], pa.int32()), pa.array([b - a for a, b in cuts], pa.int64()),
                 pa.array([_packed(rows[a:b], count[a:b]) for a, b in cuts], pa.binary())], ["g", "size", "run"])
    return run


def _subtree(shared, least: int):
    """Phrases of a group, from the sorted suffixes and how many words each shares with the one before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value
        parts, held = [], 0
        for batch in batches:
            for block, size in zip(batch.column(2), batch.column(1).to_pylist()):
                parts.append(_unpacked(block.as_py(), size))
                held += size
                if held > 2 * GROUP_SUFFIXES:  # copies from very many tasks
                    parts = [_combined(*map(np.concatenate, zip(*parts)))]
                    held = len(parts[0][0])
        if not held:
            return
        rows, count = map(np.concatenate, zip(*parts))
        order = np.lexsort(rows.T[::-1])
        rows, count = rows[order], count[order]
        shared_words = np.zeros(len(rows), np.int64)
        equal = np.ones(len(rows) - 1, bool)
        for d in range(DEPTH):
            equal &= rows[1:, d] == rows[:-1, d]
            shared_words[1:] += equal
        for d in range(2, DEPTH + 1):
            first = np.flatnonzero((shared_words < d) | (np.arange(len(rows)) == 0))
            total = np.add.reduceat(count, first)
            long = rows[first, d - 1] > 0
            first, total = first[long], total[long]
            # a phrase whose prefixes are all too common has its suffixes in several groups
            lead = rows[first, :d]
            told = (total >= least) | (_heavy_depth(_keys(lead), np.full(len(lead), d), heavy) >= d)
            phrase = rows[first[told]].view(np.int64).copy()
            phrase[:, d:] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(told.sum(), d), pa.int32()), *(pa.array(c) for c in phrase.T), pa.array(total[told])], _ROW)
    return run


def frequent_phrases(slim: DataFrame, frequent: DataFrame, salt: str, least: int, budget: int) -> DataFrame:
    """``w`` (array of word hashes), ``f``: all phrases of 2 to 5 words that occur ``least`` times."""
    spark = slim.sparkSession
    share = spark.sparkContext.broadcast
    known = _filter(frequent)
    # as many slots of prefixes as eight for each group, which is a task
    slots = 1 << max(12, int(8 * (frequent.agg(F.sum("f")).first()[0] or 0) / budget).bit_length())
    totals = np.zeros(slots, np.int64)

    def add(by_slot: DataFrame) -> None:
        told = by_slot.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        totals[told["slot"].to_numpy()] += told["n"].to_numpy()

    def common(prefixes: DataFrame) -> np.ndarray:
        """No more than the words of the corpus by the budget."""
        return np.sort(prefixes.where(F.col("n") > budget).select("h").toArrow()["h"].to_numpy().view(np.uint64))

    heavy = [common(frequent.select("h", F.col("f").alias("n")))]
    counted = slim.mapInArrow(_pairs(share((salt, known, heavy[0], slots))), "h bigint, slot int, n bigint").groupBy(
        "h", "slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    prefixes = written(counted, "pairs")
    pairs = _filter(prefixes.select("h"))
    add(prefixes.where("slot >= 0"))
    prefixes = prefixes.where("slot < 0")
    for depth in range(2, DEPTH + 1):
        if not len(heavy[-1]):
            break
        if depth > 2:
            prefixes = written(slim.mapInArrow(_extend(share((salt, known, pairs, heavy)), depth), "h bigint, n bigint").groupBy(
                "h").agg(F.sum("n").alias("n")), "prefixes")
        light = prefixes.where(F.col("n") <= budget) if depth < DEPTH else prefixes
        add(light.select("h", "n").mapInArrow(_slots(slots), "slot int, n bigint"))
        if depth < DEPTH:
            heavy.append(common(prefixes))
    groups = ((np.cumsum(totals) - totals) // budget).astype(np.int32)
    rows = slim.mapInArrow(_route(share((salt, known, pairs, heavy, groups))), "g int, size bigint, run binary")
    parted = rows.repartitionById(int(groups[-1]) + 1, F.col("g"))
    told = parted.mapInArrow(_subtree(share(heavy), least), _ROW_TYPE)
    columns = [f"h{d}" for d in range(1, DEPTH + 1)]
    summed = told.groupBy("g", *columns).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(summed.select(F.slice(F.array(*columns), F.lit(1), F.col("g")).alias("w"), "f"), "phrases")


def _slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = mixed(batch.column(0).to_numpy().view(np.uint64)) & np.uint64(slots - 1)
            place, total, _ = _summed(slot, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total)], ["slot", "n"])
    return run


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
            budget: int = GROUP_SUFFIXES) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's ``top`` phrases.

    A phrase of 2 to 5 words that occurs ``a >= least`` times within pieces scores, at its worst cut,
    ``floor(1000 * a * n / (l * r))``, exact up to 10**17 words; of equal cuts the one after fewer words counts. Phrases
    that stand inside a longer one as often are dropped. Order: score, ``a``, then the bytes of the phrase.

    NULL texts are empty, rows without a language are of language ``und``, repeated rows count each, an empty table or one
    without a frequent phrase gives an empty table. Other columns of ``docs`` are not read.
    """
    slim = spread(docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                              F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")), "text")
    words = written(slim.mapInArrow(_count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(
        F.sum("n").alias("f")), "words")
    for attempt in range(10):
        salt = str(attempt)
        hashed = words.withColumn("h", F.xxhash64(F.lit(salt), "lang", "word"))
        clash = hashed.groupBy("h").count().where("count > 1 OR h = 0").limit(1).count()
        if not clash:
            break
    else:
        raise RuntimeError("ten seeds gave equal hashes of different words")
    frequent = written(hashed.where(F.col("f") >= least), "frequent")
    long = frequent_phrases(slim, frequent, salt, least, budget)

    known = long.unionByName(frequent.select(F.array("h").alias("w"), "f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # a phrase inside a longer one as frequent is also inside one that is longer by a word
    inner = long.where("size(w) > 2").select(F.explode(F.array(
        F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("w"), "f")
    covering = inner.groupBy("w").agg(F.max("f").alias("covering"))
    kept = long.join(covering, "w", "left").where("covering IS NULL OR covering < f").select("w", F.col("f").alias("a"))
    cuts = kept.select("w", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k")).withColumns(
        {"left": F.expr("slice(w, 1, k)"), "right": F.expr("slice(w, k + 1, size(w) - k)")})
    cuts = cuts.join(known.select(F.col("w").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(known.select(F.col("w").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.withColumn("h", F.element_at("w", 1)).join(frequent.select("h", "lang"), "h").join(totals, "lang")
    score = "(cast(1000 AS decimal(4)) * cast(a AS decimal(17)) * cast(n AS decimal(17))) div " \
            "(cast(l AS decimal(17)) * cast(r AS decimal(17)))"
    worst = cuts.withColumn("score", F.expr(score)).groupBy("lang", "n", "w", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # the phrases' words are looked up for those alone that can be among the first
    close = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"))
    near = written(worst.withColumn("near", F.rank().over(close)).where(F.col("near") <= top), "near")
    spelled = near.select("w", F.posexplode("w").alias("at", "h")).join(frequent.select("h", "word"), "h").groupBy("w").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = near.join(spelled, "w").select(
        "lang", F.array_join("words.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
