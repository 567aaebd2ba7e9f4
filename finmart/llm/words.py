"""Words of many texts at once: a block of texts is cut by array operations, and each distinct word is told once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from finmart.llm.base import texts


class Words(NamedTuple):
    codes: np.ndarray  # a word's place in the dictionary
    dictionary: pa.BinaryArray  # the distinct words
    doc: np.ndarray  # the text a word stands in
    piece: np.ndarray  # words with equal numbers stand in one piece


class Splitter:
    """Cuts UTF-8 texts at single-byte separators and lower-cases A-Z; a byte of ``breaks`` also ends a piece."""

    def __init__(self, separators: Iterable[int], breaks: Iterable[int] = ()):
        breaks = {10, *breaks}
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        table[[*separators]] = 32
        table[[*breaks]] = 10
        self.table = table.tobytes()
        self.inner = ~np.isin(table, [10, 32])

    def split(self, block: list[bytes]) -> Words:
        raw = np.frombuffer(b"\n".join(block).translate(self.table), np.uint8)
        inner = np.zeros(len(raw) + 2, np.int8)
        inner[1:-1] = self.inner[raw]
        edges = np.flatnonzero(np.diff(inner))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        values = raw[inner[1:-1].view(bool)]
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
        coded = words.dictionary_encode()
        last = np.cumsum(np.fromiter(map(len, block), np.int64, len(block)) + 1)
        breaks = np.flatnonzero(raw == 10)
        return Words(coded.indices.to_numpy(), coded.dictionary, np.searchsorted(last, starts, "right"),
                     np.searchsorted(breaks, starts))


def blocks(batches: Iterable[pa.RecordBatch], key: str, extra: str | None = None, most: int = 1 << 24,
           ) -> Iterator[tuple[str, list[bytes], list]]:
    """(key, texts, extras) of about ``most`` bytes of text in all, whole texts only; columns ``key``, ``text``, ``extra``."""
    held: dict[str, tuple[list, list]] = {}
    size = 0
    for batch in batches:
        names = batch.column(batch.schema.get_field_index(key)).to_pylist()
        more = batch.column(batch.schema.get_field_index(extra)).to_pylist() if extra else [None] * len(names)
        for name, raw, other in zip(names, texts(batch), more):
            raw = raw or b""
            block, extras = held.setdefault(name, ([], []))
            block.append(raw)
            extras.append(other)
            size += len(raw)
            if size >= most:
                yield from ((k, *v) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, *v) for k, v in held.items())
