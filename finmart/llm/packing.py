"""Documents packed into sequences by bin completion.

Only the lengths decide a packing, and there are at most as many lengths as a sequence has tokens. So the search runs on
the counts of the lengths, which stay small at every size, and yields runs: a filling and how often it is repeated.
Each piece then finds its sequence from its length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.base import sliced, texts
from finmart.llm.tokens import Encoder
from finmart.session import written

SEQUENCE_TOKENS = 1024
Filling = tuple[int, ...]
# The search completes its sequences by best fit at every so many branches.
INCUMBENT_EVERY = 16


def _dominated(taken: Filling, left: int, spare: int) -> bool:
    """Whether a piece that is not taken could stand for one taken piece, being larger, or for several, being as large
    as they are together or larger, within the room ``left`` beside them. ``spare``: a bit for each length that remains.
    """
    one = many = 0
    for length in taken:
        many |= many << length | one << length
        one |= 1 << length
    # the sums of one piece shifted by 1 to left, those of several by 0 to left, by doubling
    reached, width = many | one << 1 if left else many, 1
    while width < left:
        step = min(width, left - width)
        reached |= reached << step
        width += step
    if left:
        reached |= many << left
    return bool(reached & spare)


def _fillings(lengths: list[int], counts: dict[int, int], room: int, most_waste: int, limit: int) -> tuple[list[Filling], bool]:
    """(fillings, whole): the undominated ways to fill ``room`` that waste ``most_waste`` at most, least waste first.

    A filling dominates another when its pieces can take the places of one or several pieces of the other each, none
    smaller than what it stands for. A branch ends when the pieces still to come cannot bring the waste down to
    ``most_waste``. ``lengths`` descends. After ``limit`` steps the enumeration ends, and ``whole`` is False.
    """
    if counts.get(room):
        return [(room,)], True  # one piece that fills the room dominates everything
    found: list[tuple[int, Filling]] = []
    # tokens of all pieces from a length on
    ahead = [*accumulate(length * counts[length] for length in reversed(lengths))][::-1]
    spare = sum(1 << length for length in lengths)
    steps = 0
    # (place in lengths, room left, pieces taken, lengths of which none remains)
    stack: list[tuple[int, int, Filling, int]] = [(0, room, (), 0)]
    while stack and steps < limit:
        at, left, taken, gone = stack.pop()
        steps += 1
        while at < len(lengths) and lengths[at] > left:
            at += 1
        if at == len(lengths) or left - ahead[at] > most_waste:
            if left <= most_waste and not _dominated(taken, left, spare & ~gone) and not spare & ~gone & ((1 << left + 1) - 1):
                found.append((left, taken))
            continue
        length = lengths[at]
        stack.append((at + 1, left, taken, gone))
        held = taken.count(length) + 1
        stack.append((at if held < counts[length] else at + 1, left - length, (*taken, length),
                      gone if held < counts[length] else gone | 1 << length))
    found.sort(key=lambda f: (f[0], [-x for x in f[1]]))
    return [filling for _, filling in found], not stack


def _best_fit(counts: dict[int, int], size: int) -> list[tuple[Filling, int]]:
    """Best-fit completion without branching: the largest piece, then always the largest that fits."""
    left, order, runs = dict(counts), sorted(counts), []
    while order:
        room, used, top = size, {}, len(order)
        while top := bisect_right(order, room, 0, top):
            length = order[top := top - 1]
            used[length] = n = min(left[length], room // length)
            room -= n * length
        times = min(left[length] // n for length, n in used.items())
        runs.append((tuple(x for length, n in used.items() for x in [length] * n), times))
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del order[bisect_left(order, length)]
    return runs


def _uses(filling: Filling) -> dict[int, int]:
    return {length: filling.count(length) for length in set(filling)}


def _sequences(runs: list[tuple[Filling, int]]) -> int:
    return sum(times for _, times in runs)


def _completion(counts: dict[int, int], order: list[int], room: int) -> Filling:
    """The best-fit completion of one sequence: always the largest piece that fits. ``order`` descends."""
    taken: list[int] = []
    for length in order:
        n = min(counts[length], room // length)
        taken += [length] * n
        room -= length * n
    return tuple(taken)


def plan(counts: dict[int, int], size: int = SEQUENCE_TOKENS, branches: int = 6000, limit: int = 300) -> list[tuple[Filling, int]]:
    """Runs (filling, times) that place all pieces in few sequences.

    Depth-first search: the largest piece left is completed by its undominated fillings, best first, each repeated as
    long as its pieces last. Where the enumeration of fillings ends at ``limit`` steps, the best-fit completion is added
    to what it found, so no branch is given up for having been cut. A branch ends when its sequences so far and the bound
    for the rest, the larger of total tokens over ``size`` and the number of pieces beyond half, cannot beat the
    incumbent; incumbents are the best-fit solutions of the whole, of what is left where the search turns to another
    choice and at every ``INCUMBENT_EVERY``-th branch, and whatever the search completes. It is run twice, with the three
    best fillings of a branch, so that early choices are revised too, and with all of them; each time it stops after
    ``branches`` branches or when the bound is met, and the best incumbent is the result.
    """
    def bound(left: dict[int, int]) -> int:
        total = sum(length * n for length, n in left.items())
        return max(-(-total // size), sum(n for length, n in left.items() if 2 * length > size))

    def choices(left: dict[int, int], used: int) -> Iterator[tuple[dict[int, int], Filling, int]]:
        """What is left after each filling of the largest piece, the filling and how often it is repeated."""
        largest = max(left)
        spare = {length: n for length, n in {**left, largest: left[largest] - 1}.items() if n}
        order = sorted(spare, reverse=True)
        # more waste than this cannot beat the incumbent
        waste = (fewest - used - 1) * size - sum(length * n for length, n in left.items())
        ways, whole = _fillings(order, spare, size - largest, waste, limit)
        if not whole and (usual := _completion(spare, order, size - largest)) not in ways:
            ways.append(usual)
        for way in ways:
            filling = (largest, *way)
            need = _uses(filling)
            times = min(left[length] // n for length, n in need.items())
            rest = {length: n - need.get(length, 0) * times for length, n in left.items()}
            yield {length: n for length, n in rest.items() if n}, filling, times

    start = {length: n for length, n in counts.items() if n and length}
    best = _best_fit(start, size)
    fewest, least = _sequences(best), bound(start)
    for width in (3, None):
        # the choices still to be tried at each depth, the run that led there, and the sequences so far
        path = [(islice(choices(start, 0), width), None, 0)] if start else []
        turned = False
        for number in range(branches):
            if not path or fewest <= least:
                break
            ways, _, used = path[-1]
            step = next(ways, None)
            if step is None:
                path.pop()
                turned = True
                continue
            left, filling, times = step
            used += times
            runs = [run for _, run, _ in path if run] + [(filling, times)]
            if not left:
                if used < fewest:
                    best, fewest = runs, used
                turned = True
            elif used + bound(left) >= fewest:
                turned = True
            else:
                if (turned or number % INCUMBENT_EVERY == 0) and used + _sequences(rest := _best_fit(left, size)) < fewest:
                    best, fewest = [*runs, *rest], used + _sequences(rest)
                turned = False
                path.append((islice(choices(left, used), width), (filling, times), used))
    return best


def _pieces(tokenizer: str, path: str | None, end: int, size: int):
    """Pieces of each document; ``part`` and ``k`` number the pieces of one length inside the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, path)
        ending = np.array([end], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        number = np.zeros(size + 1, np.int64)
        for batch in sliced(batches):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or b"" for t in texts(batch)])):
                raw = ids + ending
                n = len(raw) // 4
                cuts = [0, *range(n % size or size, n + 1, size)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    length = stop - start
                    rows.append((doc, piece, start, length, zlib.crc32(raw[4 * start:4 * stop]), part, int(number[length])))
                    number[length] += 1
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["id", "piece", "start", "length", "ids_crc32", "part", "k"])
    return run


def _placements(runs: list[tuple[Filling, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first number, first sequence, copies per sequence and offset of each of its runs."""
    table: dict[int, list] = {}
    done: dict[int, int] = {}
    sequence = 0
    for filling, times in runs:
        place = 0
        for length, copies in sorted(_uses(filling).items(), reverse=True):
            table.setdefault(length, []).append((done.get(length, 0), sequence, copies, place))
            done[length] = done.get(length, 0) + copies * times
            place += copies * length
        sequence += times
    return {length: tuple(np.array(c) for c in zip(*rows)) for length, rows in table.items()}


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length).tolist():
                first, begins, copies, place = table[value]
                here = np.flatnonzero(length == value)
                run_of = np.searchsorted(first, number[here], side="right") - 1
                step = number[here] - first[run_of]
                sequence[here] = begins[run_of] + step // copies[run_of]
                offset[here] = place[run_of] + step % copies[run_of] * value
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
         path: str | None = None, end: int = 2, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``: one row per piece.

    A document is its ids and the end id; NULL and empty texts are the end id alone. A document longer than ``size`` is
    cut into whole pieces of ``size`` with the remainder first. Documents without an id or with a repeated one are packed
    like any other. Pieces of whole sequences are never combined, so each is a sequence. An empty table gives none.
    The pieces are stored once; numbers inside a length come from the task that wrote them, so no length is one task's work.
    """
    spark = df.sparkSession
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    pieces = written(slim.mapInArrow(
        _pieces(tokenizer, path, end, size),
        "id bigint, piece bigint, start bigint, length bigint, ids_crc32 bigint, part bigint, k bigint"), "pieces")
    cells = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "cells")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_placements(plan(counts, size)))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = written(cells.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "ahead")
    numbered = pieces.join(first, ["length", "part"]).withColumn("number", F.col("ahead") + F.col("k"))
    return numbered.mapInArrow(_placed(shared), "id bigint, piece bigint, start bigint, length bigint, ids_crc32 bigint, "
                                                "sequence_id bigint, offset bigint")
