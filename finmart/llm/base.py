"""Words, hashes and sorted groups: the small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.session import fits_broadcast

# Separators become a blank and A-Z become a-z, byte by byte; bytes of longer UTF-8 characters stay.
_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_WORD_TABLE = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# Distinct words remembered by one task before it forgets them all; results do not depend on it.
MEMO_WORDS = 400_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever else the frame carries."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def small_side(df: DataFrame) -> DataFrame:
    """A stored side of a join: broadcast when it was measured to be small, else the join shuffles."""
    return F.broadcast(df) if fits_broadcast(df) else df


def dealt(files: DataFrame, name: str, most: int = 100_000) -> DataFrame:
    """A stored table of file names, one file to a task: a count given by hand is not joined into fewer tasks by size."""
    return files.repartitionByRange(max(1, min(files.count(), most)), name)


def alnum_words(raw: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and all non-ASCII characters."""
    return raw.translate(_WORD_TABLE).split() if raw else []


def blank_words(raw: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of anything but blanks."""
    return raw.lower().split() if raw else []


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def sliced(batches: Iterable[pa.RecordBatch], name: str = "text", most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in runs of about ``most`` bytes of text, so that what is made of a run stays small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


class WordHashes(dict):
    """A word's 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if len(self) > MEMO_WORDS:
            self.clear()
        return out


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that looks random."""
    x = values.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) | np.uint64(1)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` word hashes, in order; another ``n`` gives unrelated hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for k, factor in enumerate(_factors(n)):
        total += words[k:k + count] * factor
    return mixed(total)


def sorted_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of equal ``key`` (a long, sorted) as one table each, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(edges, edges[1:]):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)


class Union:
    """Union-find over 0..n-1 inside one task; the smaller place becomes the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
