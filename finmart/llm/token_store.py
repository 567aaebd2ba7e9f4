"""Token ids in binary files: documents compressed one by one under a shared zstandard dictionary.

Layout of a file: magic, length of the header, header (JSON: sha256 of the dictionary, bytes per id, documents, ids),
an index of three 64-bit columns (doc id, number of ids, end of the document's frame), then one zstandard frame per
document. A reader seeks one frame, so a short document costs a short read. The dictionary lies beside the files under
its sha256. A manifest has one row per file, in order, with the ids of all files before it.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.base import dealt, sliced, texts
from finmart.llm.tokens import Encoder
from finmart.session import new_folder, written

MAGIC = b"FMTOKEN1"
# Compressed bytes after which a task begins another file.
FILE_BYTES = 64 * 1024 * 1024
# The dictionary's training sample: so many documents of so many ids at most.
SAMPLE_DOCUMENTS, SAMPLE_IDS = 2000, 8192
DICTIONARY_BYTES = 64 * 1024
# Stands for a missing document id in the index.
NO_ID = -(1 << 63)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _encoded(tokenizer: str, path: str | None, end: int, width: int):
    """Serialized ids of each document: little-endian, ``width`` bytes per id, the end id last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, path)
        for batch in sliced(batches):
            arrays = [np.append(np.frombuffer(raw, "<u4"), np.uint32(end))
                      for raw in encoder.encode([t or b"" for t in texts(batch)])]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([a.astype(f"<u{width}").tobytes() for a in arrays], pa.binary())], names=["id", "n", "ids"])
    return run


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of ``size`` bytes at most; too few samples serve as they are, none give an empty dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _file_bytes(rows: list[tuple[int, int, bytes]], sha: str, width: int) -> bytes:
    head = json.dumps({"dictionary": sha, "width": width, "documents": len(rows),
                       "ids": sum(n for _, n, _ in rows)}).encode()
    ends = np.cumsum([len(frame) for _, _, frame in rows])
    index = [np.array(column, "<i8").tobytes() for column in ([r[0] for r in rows], [r[1] for r in rows], ends)]
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *index, *(r[2] for r in rows)])


class TokenFile:
    """One file, opened for reading; frames are read one at a time."""

    def __init__(self, folder: str, name: str):
        self.fs, base = _open(folder)
        self.file = self.fs.open_input_file(f"{base}/{name}")
        if self.file.read(8) != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.header = json.loads(self.file.read(struct.unpack("<I", self.file.read(4))[0]))
        n = self.header["documents"]
        self.doc_ids, self.counts, self.ends = (np.frombuffer(self.file.read(8 * n), "<i8") for _ in range(3))
        self.base, self.width = self.file.tell(), self.header["width"]
        with self.fs.open_input_file(f"{base}/{self.header['dictionary']}.dict") as f:
            raw = f.read()
        if hashlib.sha256(raw).hexdigest() != self.header["dictionary"]:
            raise ValueError("the dictionary is not the one the file was written with")
        self.plain = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))

    def document(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the index."""
        start = int(self.ends[place - 1]) if place else 0
        self.file.seek(self.base + start)
        frame = self.file.read(int(self.ends[place]) - start)
        return np.frombuffer(self.plain.decompress(frame), f"<u{self.width}").astype("<u4")


def _write_files(folder: str, shared, sha: str, width: int, level: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, base = _open(folder)
        press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(shared.value))
        rows, size, made = [], 0, []

        def put() -> None:
            # named by the attempt: a task that runs again meets no file of its own, and only listed files are read
            name = f"part-{context.partitionId():06d}-{len(made):05d}-{context.taskAttemptId()}.tok"
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(_file_bytes(rows, sha, width))
            made.append((name, len(rows), sum(n for _, n, _ in rows)))

        for batch in batches:
            for doc, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows.append((NO_ID if doc is None else doc, n, press.compress(raw)))
                size += len(rows[-1][2])
                if size >= file_bytes:
                    put()
                    rows, size = [], 0
        if rows:
            put()
        columns = list(zip(*made)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["file", "documents", "ids"])
    return run


def write_tokens(df: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = "word_bpe_49k.json", path: str | None = None, end: int = 1, level: int = 3,
                 file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """(folder, manifest) of files in ascending id order.

    NULL and empty texts are the end id alone; a missing id comes first; documents that repeat an id follow each other
    in the order of their ids' bytes. An empty table gives an empty manifest. ``folder`` must be reachable by every
    executor and by pyarrow. The ids are stored once, so only a lost executor's share is encoded again.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, "tokens")
    width = 2 if Encoder(tokenizer, path).plain.get_vocab_size() <= 1 << 16 else 4
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ids = written(slim.mapInArrow(_encoded(tokenizer, path, end, width), "id bigint, n bigint, ids binary"), "ids")
    # the documents of the smallest content hashes, whatever the partitioning; only hashes are compared over all
    short = ids.where(F.col("n") <= SAMPLE_IDS).select(F.xxhash64("ids").alias("h"), "ids")
    last = short.select("h").distinct().orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h").alias("h")).first()["h"]
    sample = short.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("ids").alias("ids")).orderBy("h")
    dictionary = train_dictionary([r["ids"] for r in sample.select("ids").collect()])
    sha = hashlib.sha256(dictionary).hexdigest()
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{sha}.dict") as out:
        out.write(dictionary)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    placed = ids.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    files = written(placed.mapInArrow(
        _write_files(folder, spark.sparkContext.broadcast(dictionary), sha, width, level, file_bytes),
        "file string, documents bigint, ids bigint"), "files")
    # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return folder, spark.read.parquet(f"{folder}/manifest")


def _read_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(folder, name)
                crcs = [zlib.crc32(file.document(i).tobytes()) for i in range(len(file.counts))]
                starts = start + np.cumsum(file.counts) - file.counts
                doc = pa.array(file.doc_ids, mask=file.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(starts), pa.array(file.counts), pa.array(crcs, pa.int64())],
                    names=["id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(folder: str, manifest: DataFrame) -> DataFrame:
    """``id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, decoded from the files."""
    return dealt(manifest.select("file", "start"), "file").mapInArrow(_read_files(folder), "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_document(spark, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with an id: the index of each file is read, and only their frames."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                file = TokenFile(folder, name)
                ids = [file.document(int(i)).tolist() for i in np.flatnonzero(file.doc_ids == doc_id)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int64()))], names=["ids"])
    files = spark.read.parquet(f"{folder}/manifest").select("file")
    return [r["ids"] for r in files.mapInArrow(find, "ids array<bigint>").collect()]
