"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of hashed byte trigrams and of binned shares (capitals, signs, digits, repeated words and lines). A
truncated singular value decomposition of labelled texts gives the latent space. Every document meets all labelled
vectors in blocked exact cosine products, and its nearest ones vote with weights that grow with similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import texts

# Labelled texts the model is fitted on, and broadcast as vectors of RANK numbers.
SAMPLE_ROWS = 4000
RANK = 48
TRIGRAM_BITS = 12
NEIGHBOURS = 15
_BINS = 16
_SHARES = 7
DIM = (1 << TRIGRAM_BITS) + _SHARES * _BINS
# Documents compared with all labelled vectors at a time.
BLOCK = 512
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def features(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): log-scaled trigram counts, and one bin per share with a weight of its own."""
    raw = raw or b""
    data = np.frombuffer(raw, np.uint8)
    if len(data) >= 3:
        wide = data.astype(np.uint32)
        codes = (wide[:-2] * np.uint32(65_536) + wide[1:-1] * np.uint32(256) + wide[2:]) * np.uint32(2_654_435_761)
        counts = np.bincount(codes >> np.uint32(32 - TRIGRAM_BITS), minlength=1 << TRIGRAM_BITS)
    else:
        counts = np.zeros(1 << TRIGRAM_BITS, np.int64)
    places = np.flatnonzero(counts)
    values = np.log1p(counts[places])
    length = max(1.0, math.sqrt(float(values @ values)))
    words, lines = raw.split(), raw.splitlines()
    bytes_of = np.bincount(data, minlength=256)
    n = max(1, len(data))
    letters = max(1, int(bytes_of[_LETTER].sum()))
    shares = [
        bytes_of[_CAPITAL].sum() / letters,
        bytes_of[_DIGIT].sum() / n,
        1 - (bytes_of[_LETTER].sum() + bytes_of[_DIGIT].sum() + bytes_of[_BLANK].sum()) / n,
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / max(1, len(lines)),
        min(1.0, len(data) / max(1, len(words)) / 24),
        min(1.0, math.log2(1 + len(words)) / 16),
    ]
    # a share lies between two bins and counts for both
    at = np.clip(np.array(shares, float), 0, 1) * (_BINS - 1)
    low = np.minimum(at.astype(int), _BINS - 2)
    base = (1 << TRIGRAM_BITS) + _BINS * np.arange(_SHARES)
    part = at - low
    return (np.concatenate([places, base + low, base + low + 1]),
            np.concatenate([values / length, 0.35 * (1 - part), 0.35 * part]))


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK, seed: int = 3):
        matrix = np.zeros((len(rows), DIM), np.float32)
        for i, (places, values) in enumerate(rows):
            matrix[i, places] = values
        held = (matrix > 0).sum(0)
        self.weight = np.log((1 + len(rows)) / (1 + held)).astype(np.float32) + np.float32(0.1)
        matrix *= self.weight
        rank = min(rank, *matrix.shape) if len(rows) else 0
        # randomized range finder with power steps
        probe = np.random.default_rng(seed).standard_normal((DIM, min(DIM, rank + 16))).astype(np.float32)
        for _ in range(4 if rank else 0):
            probe, _ = np.linalg.qr(matrix.T @ (matrix @ probe))
        if rank:
            _, _, right = np.linalg.svd(matrix @ probe, full_matrices=False)
            self.basis = np.ascontiguousarray((probe @ right[:rank].T) * self.weight[:, None]).astype(np.float32)
        else:
            self.basis = np.zeros((DIM, 1), np.float32)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.known = self.unit(rows)

    def unit(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(rows), self.basis.shape[1]), np.float32)
        for i, (places, values) in enumerate(rows):
            out[i] = values.astype(np.float32) @ self.basis[places]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def votes(self, rows: list[tuple[np.ndarray, np.ndarray]], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; the prior counts a little."""
        if not len(self.known):
            return np.full(len(rows), self.prior)
        near = self.unit(rows) @ self.known.T
        k = min(neighbours, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        similar = np.maximum(np.take_along_axis(near, best, 1), 0.0).astype(np.float64) ** 8
        scores = (similar * self.labels[best]).sum(1) + 1e-3 * self.prior
        return np.clip(scores / (similar.sum(1) + 1e-3), 0.0, 1.0)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(raw) for raw in texts(batch)]
        yield pa.RecordBatch.from_arrays([
            batch.column(batch.schema.get_field_index("label")),
            pa.array([p.astype(np.int32).tobytes() for p, _ in rows], pa.binary()),
            pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())], names=["label", "places", "values"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fold: int = 5, sample_rows: int = SAMPLE_ROWS) -> Space:
    """The space of at most ``sample_rows`` labelled documents whose crc32(id) mod ``fold`` is not 0.

    The labelled ids are drawn by the hash of the id; rows without id or label are left out, and several labels of one
    id count by their mean, a half as 1. Without labelled documents every score is the prior of one half.
    """
    own = F.col(f"`{id_col}`")
    usable = labels.select(own.alias("id"), F.col(f"`{label_col}`").alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL").where(F.crc32(F.col("id").cast("string").cast("binary")) % fold != 0)
    drawn = usable.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label")).orderBy(
        F.xxhash64("id"), "id").limit(sample_rows)
    slim = docs.select(own.alias("id"), F.col(f"`{text_col}`").alias("text"))
    # the drawn ids are at most sample_rows
    rows = slim.join(F.broadcast(drawn), "id").select("id", "label", "text").mapInArrow(
        _sampled, "label int, places binary, values binary")
    held = rows.orderBy("places", "values", "label").limit(2 * sample_rows).collect()
    return Space([(np.frombuffer(r["places"], np.int32), np.frombuffer(r["values"], np.float32)) for r in held],
                 np.array([r["label"] for r in held], np.float32))


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            raws, out = texts(batch), []
            for i in range(0, len(raws), BLOCK):
                out.append(space.votes([features(raw) for raw in raws[i:i + BLOCK]]))
            score = pa.array(np.concatenate([np.zeros(0), *out]))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])
    return run


def score(docs: DataFrame, space: Space, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
          name: str = "score") -> DataFrame:
    """The carried columns and the score of every text; NULL and empty texts are scored like any other.

    Only the texts of the labelled sample decide; ids, languages and sources are never looked at. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    kept = [c for c in carry if c != text_col]
    slim = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").alias("text"))
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields), "score double"])
    scored = slim.mapInArrow(_scores(shared), shape)
    return scored.select(*(F.col(f"`{c}`") for c in kept), *([F.col("text").alias(text_col)] if text_col in carry else []),
                         F.col("score").alias(name))
