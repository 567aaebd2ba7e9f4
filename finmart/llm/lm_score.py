"""A hashed maximum-entropy language model: n-gram and skip features, class-factored softmax.

The next token's class is drawn by a softmax over classes whose weights come from four hashed features of the words
before it: none, the last word (n-gram), the last but one (skip) and both (n-gram). Its word is then drawn by a softmax
within the class, from the word's own weight and the pair with the last word. Words beyond the vocabulary are one class.

The log-likelihood of such a model depends on the corpus only through how often each outcome follows each hashed
context. Those counts come from all training texts in one pass; every gradient update then runs over the counts, spread
over the cluster, and is the exact gradient over the whole corpus.

These shared weights are as many at every size and serve what the commonest words share. On top of them every context of
exact words that holds a word beyond the OWN commonest has features of its own, one for each outcome seen after it in
training: classes after the last two words, words of the vocabulary after the last word and a class, and rare words after
any last word. The shared model is their base measure. They grow with the corpus, so they are never gathered: all tokens
of a context meet in one bucket, where its features are counted, fitted and used, and the number of buckets follows the
number of tokens.

Texts are cut into words once; the tokens are stored as numbers of the distinct words of some texts, with the counts of
these words. The contexts are dealt to rounds, and only the tokens of one round's contexts lie on disk at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import blank_words, mixed, sliced, small_side, sorted_groups, texts
from finmart.session import written

VOCABULARY = 4096
CLASSES = 64  # and one for rare words
LAST = 512  # hashed values of the last word; the commonest OWN words have their own, the last one is "none"
OWN = 440
SKIP = CLASSES + 2  # the last but one by its class, rare, or none
PAIRS = 4096  # hashed values of both
END = b""  # no word is empty
SMOOTH = 0.1
# Text whose tokens share a list of distinct words, about, and tokens handled at a time inside a task.
RECORD_BYTES = 16_000_000
BLOCK_TOKENS = 500_000
# Tokens of exact contexts in a bucket, about, and texts whose sums travel together, as a power of two.
BUCKET_ENTRIES = 1_000_000
SLICE_BITS = 10
# Rounds at most, and buckets that a round has at least: what lies on disk for the contexts is one round's share.
ROUNDS = 16
ROUND_BUCKETS = 4
# A token in an exact context; ``row`` is that of its text, and TRAINS is added for training texts.
ENTRY = np.dtype([("context", "<u8"), ("row", "<i8"), ("outcome", "<u8"), ("base", "<f4")])
SUM = np.dtype([("row", "<i8"), ("value", "<f8")])
TRAINS = 1 << 62
# Tasks of an update step; the counts they share are as many at every size of the corpus.
STEP_TASKS = 8


@dataclass
class Vocabulary:
    """The commonest words by hash, with class and count; rows are in falling order of count."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int

    def __post_init__(self) -> None:
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        mass = np.cumsum(np.sqrt(self.counts)) - np.sqrt(self.counts) / 2
        share = mass / max(1.0, float(np.sqrt(self.counts).sum()))
        self.class_of = np.append(np.minimum((share * CLASSES).astype(np.int64), CLASSES - 1), CLASSES)

    @property
    def rare(self) -> int:
        return len(self.hashes)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word, ``rare`` for others."""
        if not len(self.sorted):
            return np.full(len(hashes), self.rare, np.int64)
        at = np.searchsorted(self.sorted, hashes)
        at[at == len(self.sorted)] = 0
        return np.where(self.sorted[at] == hashes, self.order[at], self.rare)

    def last_of(self, place: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        other = OWN + (hashes >> np.uint64(40)).astype(np.int64) % (LAST - 1 - OWN)
        return np.where(place < min(OWN, self.rare), place, other)


class Told:
    """What the vocabulary says of the distinct words of a record; a row more stands for no word."""

    def __init__(self, vocabulary: Vocabulary, words: np.ndarray):
        self.hashes = np.append(words, np.uint64(0))
        self.place = vocabulary.places(words)
        self.known = self.place < vocabulary.rare
        self.group = np.append(vocabulary.class_of[self.place], SKIP - 1)
        self.last = np.append(vocabulary.last_of(self.place, words), LAST - 1)
        self.common = (self.last < OWN) | (self.last == LAST - 1)  # has shared weights of its own

    def before(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last word and the last but one of each token of texts laid end to end; ``starts`` are their first tokens."""
        none = len(self.hashes) - 1
        one = np.append(none, codes[:-1])
        one[starts] = none
        two = np.append(none, one[:-1])
        two[starts] = none
        return one, two


def _pair(last: np.ndarray, skip: np.ndarray) -> np.ndarray:
    return ((last * SKIP + skip) * 2_654_435_761 % (1 << 32) * PAIRS) >> 32


def _exact(one: np.ndarray, two: np.ndarray, kind: int) -> np.ndarray:
    """Contexts by a hash of two values; another ``kind`` gives unrelated hashes."""
    return mixed(mixed(one + np.uint64(kind)) + two * np.uint64(0x9E3779B97F4A7C15))


def _dealt(entries: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Entries by the bucket of their context."""
    bucket = (entries["context"] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield int(bucket[start]), entries[start:end].tobytes()


def exact_logs(entries: np.ndarray, steps: int = 8, penalty: float = 1.0) -> np.ndarray:
    """For each entry the log10 by which its context's own features change its base probability.

    A context has a feature for each outcome that follows it in training, fitted by diagonal Newton steps; outcomes
    without one share what is left. The changed probabilities of a context add up to what the base ones do.
    """
    order = np.lexsort((entries["outcome"], entries["context"]))
    entries = entries[order]
    context, outcome = entries["context"], entries["outcome"]
    fresh = np.append(True, context[1:] != context[:-1])[:len(context)]
    pairs = fresh | np.append(True, outcome[1:] != outcome[:-1])[:len(context)]
    pair = np.cumsum(pairs) - 1
    which = (np.cumsum(fresh) - 1)[pairs]
    n = np.bincount(pair, weights=entries["row"] >= TRAINS)
    seen = np.flatnonzero(n)
    at, counts, base, contexts = which[seen], n[seen], entries["base"][pairs][seen].astype(float), int(fresh.sum())
    total = np.bincount(at, weights=counts, minlength=contexts)[at]
    weight = np.zeros(len(seen))

    def whole() -> np.ndarray:
        return np.maximum(1 + np.bincount(at, weights=base * np.expm1(weight), minlength=contexts), 1e-9)

    for _ in range(steps):
        share = np.minimum(base * np.exp(weight) / whole()[at], 1.0)
        slope = total * share * (1 - share) + penalty
        weight += np.clip(0.8 * (counts - total * share - penalty * weight) / slope, -2.0, 2.0)
    logs = -np.log(whole())[which]
    logs[seen] += weight
    out = np.empty(len(entries))
    out[order] = logs[pair] / np.log(10)
    return out


def _exact_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the exact contexts of a bucket add to the score of each text, by slices of texts."""
    for group in sorted_groups(batches, "bucket"):
        entries = np.frombuffer(b"".join(group.column("entries").to_pylist()), ENTRY)
        logs = exact_logs(entries)
        rows, place = np.unique(entries["row"] & (TRAINS - 1), return_inverse=True)
        sums = np.empty(len(rows), SUM)
        sums["row"], sums["value"] = rows, np.bincount(place, weights=logs)
        slices = rows >> SLICE_BITS
        cuts = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(rows)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slices[cuts[:-1]]), pa.array([sums[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
            names=["slice", "sums"])


def _slice_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in sorted_groups(batches, "slice"):
        sums = np.frombuffer(b"".join(group.column("sums").to_pylist()), SUM)
        rows, place = np.unique(sums["row"], return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.bincount(place, weights=sums["value"]))], names=["row", "exact"])


def _packed(values: np.ndarray, size: int) -> bytes:
    """Whole numbers below 256**size, all lowest bytes first, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, count: int, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, count * size, codec="zstd"), np.uint8).reshape(size, count)
    out = np.zeros((count, 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<i8").ravel()


def _width(most: int) -> int:
    return max(1, (int(most).bit_length() + 7) // 8)


class Codes(dict):
    """A word's place in the order in which words came."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _tokens(fold: int | None):
    """Texts as records; without ``fold`` all train."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in sliced(batches, most=RECORD_BYTES):
            if not batch.num_rows:
                continue
            known, parts = Codes(), []
            for raw in texts(batch):
                words = blank_words(raw)
                words.append(END)
                parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            ids, codes = batch.column(0), np.concatenate(parts)
            lengths = np.array([len(p) for p in parts])
            trains = np.ones(len(parts), bool) if fold is None else _trains(ids, fold)
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
            yield pa.RecordBatch.from_arrays([
                pa.array([row]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([len(codes)]), *(pa.array([raw], pa.binary()) for raw in (
                    _packed(lengths, 8), _packed(trains, 1), words.tobytes(), _packed(codes, _width(len(words)))))],
                names=["row", "ids", "tokens", "lengths", "trains", "words", "codes"])
            row += len(parts)
    return run


_TOKENS = "row bigint, ids array<bigint>, tokens bigint, lengths binary, trains binary, words binary, codes binary"


class Record:
    """The texts of one stored row."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        cell = dict(zip(batch.schema.names, (column[i] for column in batch.columns)))
        self.row, self.ids = cell["row"].as_py(), cell["ids"].values
        self.words = np.frombuffer(cell["words"].as_py(), np.uint64)
        self.lengths = _unpacked(cell["lengths"].as_py(), len(self.ids), 8)
        self.trains = _unpacked(cell["trains"].as_py(), len(self.ids), 1).astype(bool)
        self.codes = _unpacked(cell["codes"].as_py(), cell["tokens"].as_py(), _width(len(self.words)))
        self.raw_counts = cell["counts"].as_py() if "counts" in cell else None

    def counts(self, vocabulary: Vocabulary, told: Told) -> np.ndarray:
        """How often each word occurs in training."""
        out = np.append(vocabulary.counts, 0)[told.place]
        rare = np.flatnonzero(~told.known)
        if len(rare):
            order = np.argsort(self.words[rare].view(np.int64), kind="stable")
            out[rare[order]] = _unpacked(self.raw_counts, len(rare), 8)
        return out

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first text, texts, codes, starts, text of each token) of runs of texts with at least BLOCK_TOKENS tokens."""
        ends = np.cumsum(self.lengths)
        first = start = 0
        while first < len(ends):
            last = min(int(np.searchsorted(ends, start + BLOCK_TOKENS)) + 1, len(ends))
            lengths = self.lengths[first:last]
            yield (first, last - first, self.codes[start:ends[last - 1]], np.cumsum(lengths) - lengths,
                   np.repeat(np.arange(last - first), lengths))
            first, start = last, int(ends[last - 1])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Record(batch, i)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for record in _records(batches):
        n = np.bincount(record.codes[np.repeat(record.trains, record.lengths)], minlength=len(record.words))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(record.words[seen].view(np.int64)), pa.array(n[seen])], names=["word", "n"])


def _rare_words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in _records(batches):
            words = record.words[shared.value.places(record.words) == shared.value.rare]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), record.row)), pa.array(words.view(np.int64))], names=["row", "word"])
    return run


def _counts_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a record's rare words, in the order of the words."""
    for group in sorted_groups(batches, "row"):
        yield pa.RecordBatch.from_arrays(
            [group.column("row").slice(0, 1).combine_chunks(), pa.array([_packed(group.column("c").to_numpy(), 8)], pa.binary())],
            names=["row", "counts"])


def _cells(shared):
    """How often an outcome follows a context: classes after (last, skip), words after last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        classes = np.zeros(LAST * SKIP * (CLASSES + 1), np.int64)
        words = np.zeros(LAST * max(1, vocabulary.rare), np.int64)
        for record in _records(batches):
            told = Told(vocabulary, record.words)
            for first, _, codes, starts, text in record.blocks():
                one, two = told.before(codes, starts)
                trains = record.trains[first + text]
                codes, last, skip = codes[trains], told.last[one[trains]], told.group[two[trains]]
                cell = (last * SKIP + skip) * (CLASSES + 1) + told.group[codes]
                classes += np.bincount(cell, minlength=len(classes))
                known = told.known[codes]
                words += np.bincount(last[known] * vocabulary.rare + told.place[codes[known]], minlength=len(words))
        for kind, cells in ((0, classes), (1, words)):
            held = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), kind, np.int32)), pa.array(held), pa.array(cells[held])], names=["kind", "cell", "n"])
    return run


class Weights:
    """Class weights: rows for no feature, last, skip and pair."""

    def __init__(self):
        self.rows = np.zeros((1 + LAST + SKIP + PAIRS, CLASSES + 1))

    @staticmethod
    def active(last: np.ndarray, skip: np.ndarray) -> np.ndarray:
        return np.stack([np.zeros_like(last), 1 + last, 1 + LAST + skip, 1 + LAST + SKIP + _pair(last, skip)], axis=1)

    def log_probabilities(self, last: np.ndarray, skip: np.ndarray) -> np.ndarray:
        scores = self.rows[self.active(last, skip)].sum(1)
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def _class_step(shared, first: bool):
    """Expected feature counts of the contexts of one task, summed, and the observed ones, which the first step tells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights()
        weights.rows = shared.value
        observed, expected = np.zeros_like(weights.rows), np.zeros_like(weights.rows)
        loss = 0.0
        for batch in batches:
            cell, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
            context, place = np.unique(cell // (CLASSES + 1), return_inverse=True)
            counts = np.zeros((len(context), CLASSES + 1))
            np.add.at(counts, (place, cell % (CLASSES + 1)), n)
            last, skip = context // SKIP, context % SKIP
            logs = weights.log_probabilities(last, skip)
            loss -= float((counts * logs).sum())
            model = counts.sum(1, keepdims=True) * np.exp(logs)
            for rows in weights.active(last, skip).T:
                if first:
                    np.add.at(observed, rows, counts)
                np.add.at(expected, rows, model)
        raws = [x.astype(np.float32).tobytes() if told else None for x, told in ((observed, first), (expected, True))]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([raw], pa.binary()) for raw in raws), pa.array([loss])], names=["observed", "expected", "loss"])
    return run


def _train_classes(cells: DataFrame, vocabulary: Vocabulary, steps: int, penalty: float) -> tuple[Weights, list[float]]:
    """Full-gradient updates: each weight moves by its gradient over its expected count."""
    context = cells.sparkSession.sparkContext
    # whole contexts in a task: a context's outcomes are neighbours in the sorted cells
    spread = written(cells.repartition(STEP_TASKS, F.floor(F.col("cell") / (CLASSES + 1))).sortWithinPartitions("cell"), "contexts")
    spread = spread.select("cell", "n").coalesce(STEP_TASKS)
    weights, losses = Weights(), []
    # a class without words, as a small vocabulary leaves some, gets no share
    weights.rows[0, np.setdiff1d(np.arange(CLASSES), vocabulary.class_of)] = -60.0
    observed = np.zeros_like(weights.rows)

    def summed(told: list, name: str) -> np.ndarray:
        return sum((np.frombuffer(r[name], np.float32).astype(float) for r in told), np.zeros(weights.rows.size)).reshape(weights.rows.shape)

    for step in range(steps):
        shared = context.broadcast(weights.rows)
        told = spread.mapInArrow(_class_step(shared, not step), "observed binary, expected binary, loss double").collect()
        if not step:
            observed = summed(told, "observed")
        expected = summed(told, "expected")
        losses.append(sum(r["loss"] for r in told))
        gradient = observed - expected - penalty * weights.rows
        weights.rows = weights.rows + np.clip(0.4 * gradient / (expected + penalty), -0.6, 0.6)
        shared.destroy()
    return weights, losses


def _word_rows(shared, steps: int, penalty: float):
    """Weights of (last, word) pairs, by gradient updates on the words after one last word; log10 probabilities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        size, classes = vocabulary.rare, vocabulary.class_of[:-1]
        segments = np.flatnonzero(np.diff(classes, prepend=-1))
        which = np.searchsorted(segments, np.arange(size), side="right") - 1
        base = np.log(vocabulary.counts)

        def logs(weight: np.ndarray) -> np.ndarray:
            score = base + weight
            score = score - np.maximum.reduceat(score, segments)[which]
            return score - np.log(np.add.reduceat(np.exp(score), segments))[which]

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for last in np.unique(cell // size).tolist():
                here = cell // size == last
                held.setdefault(last, np.zeros(size))[cell[here] % size] += n[here]
        lasts, out = [], []
        for last, counts in held.items():
            total = np.add.reduceat(counts, segments)[which]
            weight = np.zeros(size)
            for _ in range(steps):
                expected = total * np.exp(logs(weight))
                gradient = counts - expected - penalty * weight
                weight = weight + np.clip(0.6 * gradient / (expected + penalty), -1.0, 1.0)
            lasts.append(last)
            out.append((logs(weight) / np.log(10)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lasts, pa.int64()), pa.array(out, pa.binary())], names=["last", "logs"])
    return run


class Model:
    """Log10 probabilities: ``classes`` after (last, skip), ``words`` in their class after last."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights, rows: dict[int, np.ndarray]):
        self.vocabulary = vocabulary
        context = np.arange(LAST * SKIP)
        logs = weights.log_probabilities(context // SKIP, context % SKIP) / np.log(10)
        self.classes = logs.astype(np.float32)
        size, classes = vocabulary.rare, vocabulary.class_of[:-1]
        plain = np.zeros(size)
        if size:
            totals = np.bincount(classes, weights=vocabulary.counts, minlength=CLASSES)
            plain = np.log10(vocabulary.counts / totals[classes])
        self.words = np.empty((LAST, size), np.float32)
        for last in range(LAST):
            self.words[last] = rows.get(last, plain)


def _trains(ids: pa.Array, fold: int) -> np.ndarray:
    """Which texts train, as ``score_documents`` says it in columns."""
    return np.array([i is not None and zlib.crc32(str(i).encode()) % fold != 0 for i in ids.to_pylist()], bool)


def _scored(shared):
    """A row for each text, with sums over its tokens; the rare words' share of their class is left out of the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        vocabulary = model.vocabulary
        for record in _records(batches):
            told = Told(vocabulary, record.words)
            counts = record.counts(vocabulary, told)
            logs = np.log10(counts + SMOOTH)
            for first, size, codes, starts, text in record.blocks():
                one, two = told.before(codes, starts)
                known = told.known[codes]
                last = told.last[one]
                score = model.classes[last * SKIP + told.group[two], told.group[codes]].astype(float)
                score[known] += model.words[last[known], told.place[codes[known]]]
                score[~known] += logs[codes[~known]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(record.row + first + np.arange(size)), record.ids.slice(first, size),
                    pa.array(np.bincount(text, minlength=size)), pa.array(np.bincount(text[counts[codes] > 0], minlength=size)),
                    pa.array(np.bincount(text[~known], minlength=size)),
                    pa.array(np.bincount(text, weights=logs[codes], minlength=size)),
                    pa.array(np.bincount(text, weights=score, minlength=size))],
                    names=["row", "id", "n_tokens", "n_known", "n_rare", "base", "score"])
    return run


def _entries(shared, shares: np.ndarray, buckets: int, rounds: int, turn: int):
    """Buckets with tokens in those exact contexts that it is the turn of; all tokens of a context have one turn.

    ``shares`` has the smoothed counts of all rare words, then of each part of them. The commonest last words have a
    context for each part, so that none is large.
    """
    parts = len(shares) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        vocabulary = model.vocabulary
        for record in _records(batches):
            told = Told(vocabulary, record.words)
            counts = record.counts(vocabulary, told)
            rare, common, known = ~told.known & (counts > 0), told.common, told.known
            part = 1 + record.words.view(np.int64) % parts
            seed = (mixed(told.hashes) % np.uint64(rounds)).astype(np.int16)
            for first, _, codes, starts, text in record.blocks():
                one, two = told.before(codes, starts)
                common_one, seed_one = common[one], seed[one]
                classed = np.flatnonzero((seed_one + seed[two]) % rounds == turn)
                classed = classed[~(common_one[classed] & common[two[classed]])]
                worded = np.flatnonzero((seed_one == turn) & ~common_one)
                worded = worded[known[codes[worded]]]
                rares = np.flatnonzero(rare[codes])
                parted = np.where(common_one[rares], part[codes[rares]], 0)
                mine = (seed_one[rares] + parted) % rounds == turn
                rares, parted = rares[mine], parted[mine]
                entries = np.empty(len(classed) + len(worded) + len(rares), ENTRY)
                at = np.concatenate([classed, worded, rares])
                entries["row"] = record.row + first + text[at] + record.trains[first + text[at]] * TRAINS
                here, last, group = entries[:len(classed)], told.last[one[classed]], told.group[codes[classed]]
                here["context"] = _exact(told.hashes[one[classed]], told.hashes[two[classed]], 1)
                here["outcome"] = group
                here["base"] = 10.0 ** model.classes[last * SKIP + told.group[two[classed]], group]
                here, last, place = entries[len(classed):-len(rares) or None], told.last[one[worded]], told.place[codes[worded]]
                here["context"] = _exact(told.hashes[one[worded]], told.group[codes[worded]].astype(np.uint64), 2)
                here["outcome"] = place
                here["base"] = 10.0 ** model.words[last, place]
                here, codes = entries[len(classed) + len(worded):], codes[rares]
                here["context"] = _exact(told.hashes[one[rares]], parted.astype(np.uint64), 3)
                here["outcome"] = record.words[codes]
                here["base"] = (counts[codes] + SMOOTH) / shares[parted]
                dealt = list(_dealt(entries, buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in dealt], pa.int64()), pa.array([e for _, e in dealt], pa.binary())],
                    names=["bucket", "entries"])
    return run


def _rare_shares(words: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Smoothed counts of the rare words: of all, and of as many parts as a part has words."""
    parts = max(1, math.isqrt(vocabulary.distinct - vocabulary.rare))
    told = words.groupBy(F.pmod("word", F.lit(parts)).alias("part")).agg((F.sum("c") + SMOOTH * F.count(F.lit(1))).alias("share"))
    shares = np.zeros(parts)
    for r in told.collect():
        shares[r["part"]] = r["share"]
    shares -= np.bincount(vocabulary.hashes.view(np.int64) % parts, weights=vocabulary.counts + SMOOTH, minlength=parts)
    return np.append(max(shares.sum(), SMOOTH), np.maximum(shares, SMOOTH))


def _stored_tokens(slim: DataFrame, fold: int | None) -> DataFrame:
    return written(slim.select("id", "text").mapInArrow(_tokens(fold), _TOKENS), "tokens")


def train(slim: DataFrame, **options) -> tuple[Model, DataFrame, list[float]]:
    """(model, counts of all training words, loss before each step) from a frame with the column ``text``."""
    return _train(_stored_tokens(slim.select(F.lit(None).cast("long").alias("id"), "text"), None), **options)


def _train(tokens: DataFrame, vocabulary_size: int = VOCABULARY, steps: int = 14, penalty: float = 1.0) -> tuple[Model, DataFrame, list[float]]:
    """The same from stored tokens, of which those of training texts count."""
    spark = tokens.sparkSession
    words = tokens.mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("c"))
    words = written(words, "words")
    sums = words.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    top = words.orderBy(F.desc("c"), "word").limit(vocabulary_size).collect()
    vocabulary = Vocabulary(np.array([r["word"] for r in top], np.int64).view(np.uint64),
                            np.array([r["c"] for r in top], np.int64), sums["total"] or 0, sums["distinct"])
    shared = spark.sparkContext.broadcast(vocabulary)
    cells = written(tokens.mapInArrow(_cells(shared), "kind int, cell bigint, n bigint").groupBy("kind", "cell").agg(
        F.sum("n").alias("n")), "cells")
    weights, losses = _train_classes(cells.where("kind = 0"), vocabulary, steps, penalty)
    pairs = cells.where("kind = 1").select("cell", "n")
    rows = {}
    if vocabulary.rare:
        # as many rows as LAST at every size
        told = pairs.repartition(STEP_TASKS, F.floor(F.col("cell") / vocabulary.rare)).mapInArrow(
            _word_rows(shared, 20, penalty), "last bigint, logs binary").collect()
        rows = {r["last"]: np.frombuffer(r["logs"], np.float32) for r in told}
    return Model(vocabulary, weights, rows), words, losses


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 10, **options) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``: a row per document.

    Documents whose crc32(id) mod ``fold`` is not 0 train; one without an id never does and counts as held out. NULL and
    empty texts are the end token alone. Repeated rows stay rows and count each. Without training documents every word is
    unknown and the model is uniform. Words are told apart by 64-bit hashes.
    """
    spark = df.sparkSession
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % fold == 0, F.lit(True))
    tokens = _stored_tokens(slim, fold)
    model, words, _ = _train(tokens, **options)
    vocabulary = model.vocabulary
    shared = spark.sparkContext.broadcast(model)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # each record gets the counts of its rare words
    rare = tokens.mapInArrow(_rare_words(spark.sparkContext.broadcast(vocabulary)), "row bigint, word bigint").join(
        words, "word", "left").select("row", "word", F.coalesce("c", F.lit(0)).alias("c"))
    counts = written(rare.repartition(parts, "row").sortWithinPartitions("row", "word").mapInArrow(
        _counts_together, "row bigint, counts binary"), "counts")
    tokens = written(tokens.join(small_side(counts), "row", "left"), "counted")
    scored = written(tokens.mapInArrow(_scored(shared), "row bigint, id bigint, n_tokens bigint, n_known bigint, "
                                                        "n_rare bigint, base double, score double"), "scored")
    # a token is in one or two exact contexts
    buckets = max(1, math.ceil(1.5 * vocabulary.total / BUCKET_ENTRIES))
    rounds = max(1, min(ROUNDS, buckets // ROUND_BUCKETS))
    buckets, shares, exact = -(-buckets // rounds), _rare_shares(words, vocabulary), None
    for turn in range(rounds):
        met = tokens.mapInArrow(_entries(shared, shares, buckets, rounds, turn), "bucket bigint, entries binary")
        told = met.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_exact_sums, "slice bigint, sums binary")
        told = written(told.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(
            _slice_sums, "row bigint, exact double"), "exact")
        exact = told if exact is None else exact.unionByName(told)
    exact = exact.groupBy("row").agg(F.sum("exact").alias("exact"))
    total, distinct = vocabulary.total, vocabulary.distinct
    rare_total, rare_kinds = total - int(vocabulary.counts.sum()), distinct - vocabulary.rare
    whole = float(np.log10(total + SMOOTH * (distinct + 1)))
    within = float(np.log10(rare_total + SMOOTH * (rare_kinds + 1)))
    return scored.join(exact, "row", "left").select(
        "id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score") - F.col("n_rare") * within + F.coalesce("exact", F.lit(0.0))).alias("score"))
