"""Token ids in binary files: bit or byte planes of fixed-size blocks, with a chunk index.

*File.* The ids of consecutive documents form one sequence, cut into blocks of ``block_ids`` ids
wherever documents end. A block is transposed: plane i holds bit i (or byte i) of all its ids, so
that the slowly varying high planes become long runs; each plane is compressed with zstandard.
Only the planes that the vocabulary's largest id needs are stored. Behind the blocks follow
the compressed table of documents (id and length) and the footer: a JSON chunk index with the
place, number of ids and plane lengths of every block, its own length, and the mark. A reader
fetches any range of ids by reading the footer and the blocks that hold it.

*Job.* Texts are sorted by range of document id, ties by content and row number, so that rows
sharing one id spread over ranges as well; this is the only shuffle. Each task encodes its
range and writes it as files of at most ``ids_per_file`` ids (or one document, if that is longer)
under names of its own, holding a slice of texts and one block in memory, and returns rows of
the manifest. Spark commits the manifest, which alone says which files count: those of
lost or repeated attempts are not in it, and readers never see them. First ids of files are a
running sum over the manifest, one row per file.

Files are written and read through ``pyarrow.fs``, which knows file, s3, gs and hdfs addresses. The
folder must be reachable from all executors; the files are the operator's output and stay.

Null ids come first in the order, null texts count as empty, an empty text is a document with the
end id alone, and an empty table gives no file. Repeated rows are documents of their own.
Documents with one id are ordered by content. Further columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import whole_text, written
from adfacts.llm.encoding import WordEncoder, json_tokenizer, read_vocabulary

MARK = b"IDPLANE1"
BLOCK_IDS = 1 << 16
IDS_PER_FILE = 1 << 24
BYTES_PER_ID = 2.5  # of text, about; only the number of ranges depends on it

# planes


def to_planes(ids: np.ndarray, width: int, kind: str) -> list[bytes]:
    """``width`` planes of an array of unsigned 32-bit ids."""
    if kind == "byte":
        return [(ids >> (8 * i)).astype(np.uint8).tobytes() for i in range(width)]
    return [np.packbits((ids >> i).astype(np.uint8) & 1).tobytes() for i in range(width)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    ids = np.zeros(n, dtype=np.uint32)
    for i, plane in enumerate(planes):
        part = np.frombuffer(plane, dtype=np.uint8)
        if kind == "byte":
            ids |= part.astype(np.uint32) << np.uint32(8 * i)
        else:
            ids |= np.unpackbits(part, count=n).astype(np.uint32) << np.uint32(i)
    return ids


def plane_count(largest_id: int, kind: str) -> int:
    bits = max(1, int(largest_id).bit_length())
    return bits if kind == "bit" else -(-bits // 8)


# one file


class FileWriter:
    """Appends documents to one file; at most one block of ids waits in memory."""

    def __init__(self, path: str, largest_id: int, kind: str = "byte", block_ids: int = BLOCK_IDS):
        if kind not in ("bit", "byte"):
            raise ValueError("planes are of kind bit or byte")
        self.path, self.kind, self.block_ids = path, kind, block_ids
        self.width = plane_count(largest_id, kind)
        system, name = fs.FileSystem.from_uri(path)
        self.stream = system.open_output_stream(name)
        self.squeeze = zstandard.ZstdCompressor(level=3).compress
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.offset = 0
        self.blocks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.offset += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        while len(ids):
            part, ids = np.split(ids, [self.block_ids - self.n_waiting])
            self.waiting.append(part)
            self.n_waiting += len(part)
            if self.n_waiting == self.block_ids:
                self._block()

    def _block(self) -> None:
        ids = np.concatenate(self.waiting).astype(np.uint32)
        planes = [self.squeeze(plane) for plane in to_planes(ids, self.width, self.kind)]
        self.blocks.append([self.offset, len(ids), [len(plane) for plane in planes]])
        for plane in planes:
            self._put(plane)
        self.waiting, self.n_waiting = [], 0

    def close(self) -> None:
        if self.n_waiting:
            self._block()
        known = np.array([doc_id is not None for doc_id in self.doc_ids], dtype=np.uint8)
        numbers = np.array([doc_id or 0 for doc_id in self.doc_ids], dtype="<i8")
        table = numbers.tobytes() + np.array(self.lengths, dtype="<i8").tobytes() + known.tobytes()
        squeezed, place = self.squeeze(table), self.offset
        self._put(squeezed)
        footer = json.dumps(
            {
                "kind": self.kind, "block_ids": self.block_ids, "n_ids": self.n_ids,
                "n_docs": len(self.doc_ids), "docs": [place, len(squeezed)], "blocks": self.blocks,
            }
        ).encode()
        self._put(footer + struct.pack("<q", len(footer)) + MARK)
        self.stream.close()


class FileReader:
    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        tail = self._get(self.file.size() - 8 - len(MARK), 8 + len(MARK))
        if tail[8:] != MARK:
            raise ValueError(f"{path} is no file of token ids")
        (length,) = struct.unpack("<q", tail[:8])
        self.index = json.loads(self._get(self.file.size() - 8 - len(MARK) - length, length))
        self.expand = zstandard.ZstdDecompressor().decompress

    def _get(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def block(self, number: int) -> np.ndarray:
        place, n, lengths = self.index["blocks"][number]
        data, planes, at = self._get(place, sum(lengths)), [], 0
        for length in lengths:
            planes.append(self.expand(data[at : at + length]))
            at += length
        return from_planes(planes, n, self.index["kind"])

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """Ids start..stop-1 of the file, as parts of the blocks that hold them."""
        size = self.index["block_ids"]
        for number in range(start // size, -(-min(stop, self.index["n_ids"]) // size)):
            block = self.block(number)
            yield block[max(0, start - number * size) : stop - number * size]

    def documents(self) -> list[tuple[int | None, int]]:
        """Per document its id and number of ids, in the order of the file."""
        table, n = self.expand(self._get(*self.index["docs"])), self.index["n_docs"]
        numbers = np.frombuffer(table, dtype="<i8", count=2 * n).tolist()
        known = np.frombuffer(table, dtype=np.uint8, offset=16 * n).tolist()
        return [(numbers[i] if known[i] else None, numbers[n + i]) for i in range(n)]

    def close(self) -> None:
        self.file.close()


# the jobs


MANIFEST = "part int, number int, path string, n_docs bigint, n_ids bigint"


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary_path: str,
    end_id: int,
    kind: str = "byte",
    block_ids: int = BLOCK_IDS,
    ids_per_file: int = IDS_PER_FILE,
) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) to ``folder``, a URI; returns the manifest.

    The manifest has part, number, path, n_docs, n_ids and start (ids of all files before); files
    are ordered by part and number. It is kept as a table of its own in the shared folder.
    """
    vocabulary = read_vocabulary(vocabulary_path)
    largest = max(end_id, json_tokenizer(vocabulary, False).get_vocab_size() - 1)
    system, name = fs.FileSystem.from_uri(folder)
    system.create_dir(name, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, writer = TaskContext.get().partitionId(), [], None
        attempt, encoder = uuid.uuid4().hex, WordEncoder.of_worker(vocabulary)

        def close() -> None:
            writer.close()
            files.append((part, len(files), writer.path, len(writer.lengths), writer.n_ids))

        for batch in batches:
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for some_ids in encoder.encode(batch.column("text"), end_id):
                for ids, doc_id in zip(some_ids, doc_ids):
                    if writer and writer.n_ids + len(ids) > ids_per_file:
                        close()
                        writer = None
                    if writer is None:
                        path = f"{folder}/ids-{part:06d}-{len(files):04d}-{attempt}.planes"
                        writer = FileWriter(path, largest, kind, block_ids)
                    writer.add(doc_id, ids)
        if writer:
            close()
        rows = [dict(zip(schema.names, file)) for file in files]
        yield pa.RecordBatch.from_pylist(rows, schema)

    numbers = [("n_docs", pa.int64()), ("n_ids", pa.int64())]
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), *numbers])
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + int(n_bytes / (BYTES_PER_ID * ids_per_file))
    order = ["doc_id", "tie", "row"]
    keyed = texts.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    manifest = written(ranged.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-files")
    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, and the ids themselves as an array.

    With ``digest`` the ids are not returned but the unsigned crc32 of their little-endian 32-bit
    bytes as ``ids_crc32``; then no more than a block of ids is held at a time.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                reader = FileReader(path)
                yield from _documents(reader, int(start), digest)
                reader.close()

    # as many tasks as files: adaptive execution would put these short rows into one
    files = manifest.select("path", "start").repartition(max(1, manifest.count()))
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return files.mapInPandas(read, f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def _documents(reader: FileReader, start: int, digest: bool) -> Iterator[pd.DataFrame]:
    parts, have = reader.ids(0, reader.index["n_ids"]), np.zeros(0, dtype=np.uint32)
    rows, at, columns = [], start, ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    held = 0
    for doc_id, length in reader.documents():
        missing, crc, kept = length, 0, []
        while missing:
            if not len(have):
                have = next(parts)
            piece, have = have[:missing], have[missing:]
            missing -= len(piece)
            if digest:
                crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
            else:
                kept.append(piece)
        value = crc if digest else np.concatenate(kept).astype(np.int64) if kept else []
        rows.append((doc_id, at, length, value))
        at, held = at + length, held + (1 if digest else length)
        if held >= BLOCK_IDS:
            yield _frame(rows, columns)
            rows, held = [], 0
    if rows:
        yield _frame(rows, columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    frame["doc_id"] = pd.array([row[0] for row in rows], dtype="Int64")
    return frame
