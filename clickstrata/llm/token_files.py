"""Token ids in files of fixed-width bits, written and read by Spark.

Documents are sorted by id, each task encodes its run of them, and every file holds
consecutive documents. A file is

* a header of eight little-endian numbers (:data:`HEADER`): the mark, bits per id, ids
  per block, documents, ids, blocks, and the file's place: the task and its file there;
* the document ids (64 bits each) and a byte for each that says whether it is null;
* for each document the number of ids up to its end (64 bits);
* for each block the byte at which it begins, and the end of the last (64 bits);
* the blocks. Each packs its ids lowest bit first into whole bytes, ``bits`` bits an id,
  which is the least number that holds every id of the vocabulary.

Block offsets are counted from the first block. Any range of ids is read from the
blocks that hold it, which are unpacked as arrays. Spark's text writer stores a file
for each row with a line feed behind it, which is not part of the format, so its
committers decide which attempt of a task counts and any store it can write will do.

Rows: null and empty texts have the end id alone. Null ids come first. Rows with
equal ids keep no order of their own but a repeatable one (by a hash of the text,
then the text); equal rows are each kept. An empty table gives no files.
Columns besides id and text are not looked at.
"""

from __future__ import annotations

import io
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import clear_scratch, scratch_path, stage
from .tokens import ByteTokenizer, id_cache

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 4096
FILE_IDS = 1 << 23
READ_IDS = 1 << 20
HEADER = struct.Struct("<8q")
MARK = int.from_bytes(b"TOKBITS1", "little")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def bits_for(size: int) -> int:
    """The least bits that hold every id below ``size``."""
    return max(1, (size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after the other, lowest bit first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of :func:`pack_bits`, as unsigned 32-bit numbers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


class TokenFileBuilder:
    """Takes documents one by one; :meth:`build` gives the file of those taken since the last."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS, place: int = 0) -> None:
        self.bits, self.block_ids, self.place, self.files = bits, block_ids, place, 0
        self._clear()

    def _clear(self) -> None:
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.n_ids = 0
        self.waiting: list[bytes] = []  # ids as 32-bit numbers that are not yet packed
        self.n_waiting = 0
        self.blocks: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document's ids as unsigned 32-bit numbers."""
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids) // 4
        self.ends.append(self.n_ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= 64 * self.block_ids:
            self._pack(self.n_waiting // self.block_ids * self.block_ids)

    def _pack(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        self.blocks += [pack_bits(ids[k : min(k + self.block_ids, n)], self.bits) for k in range(0, n, self.block_ids)]
        self.waiting, self.n_waiting = [ids[n:].tobytes()], len(ids) - n

    def build(self) -> bytes:
        if self.n_waiting:
            self._pack(self.n_waiting)
        nulls = np.array([k is None for k in self.doc_ids], np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in self.blocks], dtype=np.int64)])
        header = HEADER.pack(MARK, self.bits, self.block_ids, len(self.doc_ids), self.n_ids, len(self.blocks), self.place, self.files)
        parts = [header, np.array([k or 0 for k in self.doc_ids], "<i8").tobytes(), nulls.tobytes(), np.array(self.ends, "<i8").tobytes(), offsets.astype("<i8").tobytes(), *self.blocks]
        self.files += 1
        self._clear()
        return b"".join(parts)


@dataclass
class TokenFile:
    """A file opened for reading: its index is read at once, ids when they are asked for."""

    file: BinaryIO

    def __post_init__(self) -> None:
        mark, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks, self.place, self.number = HEADER.unpack(self.file.read(HEADER.size))
        if mark != MARK:
            raise ValueError("not a token file")

        def numbers(n: int) -> np.ndarray:
            return np.frombuffer(self.file.read(8 * n), "<i8")

        self.doc_ids = numbers(n_docs)
        self.nulls = np.frombuffer(self.file.read(n_docs), np.uint8).astype(bool)
        self.ends = numbers(n_docs)
        self.offsets = numbers(n_blocks + 1)
        self.first_block = self.file.tell()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError(f"{start} to {stop} of {self.n_ids} ids")
        if start == stop:
            return np.empty(0, np.uint32)
        low, high = start // self.block_ids, (stop - 1) // self.block_ids + 1
        begin, end = int(self.offsets[low]), int(self.offsets[high])
        self.file.seek(self.first_block + begin)
        data, held = self.file.read(end - begin), min(high * self.block_ids, self.n_ids) - low * self.block_ids
        if self.block_ids * self.bits % 8 == 0:  # blocks but the last have no filling, so they are one run of bits
            found = unpack_bits(data, self.bits, held)
        else:
            cuts = (self.offsets[low : high + 1] - begin).tolist()
            sizes = [min(self.block_ids, self.n_ids - k * self.block_ids) for k in range(low, high)]
            found = np.concatenate([unpack_bits(data[a:b], self.bits, n) for a, b, n in zip(cuts[:-1], cuts[1:], sizes, strict=True)])
        return found[start - low * self.block_ids : stop - low * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document number ``k``."""
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_token_files(
    documents: DataFrame,
    path: str,
    *,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes the ids of all documents, each with ``end_id`` behind it, to files below ``path``, in ascending order of the ids.

    The texts are dealt out by ranges of (id, hash of the text, a random number), so neither an
    id nor a text that many rows share meets in one task. A file ends with the document that
    brings it to ``file_ids`` ids.
    """
    source = vocabulary or vocabulary_path()
    size = ByteTokenizer(source).size
    if not 0 <= end_id < size:
        raise ValueError("the end id is not in the vocabulary")
    bits = bits_for(size)
    keyed = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"), F.rand(0).alias("spread")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, end = id_cache(source), array("I", [end_id]).tobytes()
        builder = TokenFileBuilder(bits, block_ids, TaskContext.get().partitionId())
        for batch in batches:
            texts = batch.column("text")
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                builder.add(doc_id, cache.encode(texts[k].as_py()) + end)
                if builder.n_ids >= file_ids:
                    yield pa.RecordBatch.from_arrays([pa.array([builder.build()], pa.binary())], ["file"])
        if builder.doc_ids:
            yield pa.RecordBatch.from_arrays([pa.array([builder.build()], pa.binary())], ["file"])

    ranged = keyed.repartitionByRange("doc_id", "tie", "spread").sortWithinPartitions("doc_id", "tie", "text")
    files = ranged.select("doc_id", "text").mapInArrow(run, "file binary")
    # The bytes as they are: the cast does not look at them, and the writer copies them.
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


READ = "place long, number long, doc_id long, stop long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row for each document of the files below ``path``: the file's place and number, doc_id, the ids of the file up
    to the document's end, its ids, their crc32 as little-endian unsigned 32-bit numbers; ``with_ids`` adds the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(io.BytesIO(content.as_buffer()))
                low = 0
                while low < len(file.doc_ids):
                    # Documents of about so many ids together, one at least.
                    before = int(file.ends[low - 1]) if low else 0
                    high = max(low + 1, int(np.searchsorted(file.ends, before + READ_IDS, side="right")))
                    yield _documents(file, low, high, with_ids)
                    low = high

    # A writer without rows leaves a file without bytes.
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, READ + (", ids array<int>" if with_ids else ""))


def _documents(file: TokenFile, low: int, high: int, with_ids: bool) -> pa.RecordBatch:
    ends = file.ends[low:high]
    begins = np.concatenate([[file.ends[low - 1] if low else 0], ends[:-1]])
    every = file.ids(int(begins[0]), int(ends[-1]))
    ids = [every[a:b] for a, b in zip((begins - begins[0]).tolist(), (ends - begins[0]).tolist(), strict=True)]
    columns = [
        pa.array(np.full(len(ends), file.place)),
        pa.array(np.full(len(ends), file.number)),
        pa.array(file.doc_ids[low:high], mask=file.nulls[low:high]),
        pa.array(ends),
        pa.array(ends - begins),
        pa.array([zlib.crc32(own) for own in ids], pa.int64()),
    ]
    names = [field.split()[0] for field in READ.split(", ")]
    if with_ids:
        columns.append(pa.array([own.view(np.int32) for own in ids], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)


def with_starts(found: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ...) with ``start`` counted over all files in their order. ``found`` is stored.

    The window runs over one row for each file.
    """
    before = Window.orderBy("place", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = found.groupBy("place", "number").agg(F.max("stop").alias("n"))
    offsets = files.select("place", "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("stop") - F.col("n_tokens")).alias("start")
    others = [c for c in found.columns if c not in ("place", "number", "doc_id", "stop")]
    return found.join(offsets, ["place", "number"]).select("doc_id", start, *others)


def round_trip(documents: DataFrame, **settings) -> DataFrame:
    """Writes the files, reads them back and gives (doc_id, start, n_tokens, ids_crc32) of each document from them."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token_files")
    write_token_files(documents, path, **settings)
    found = stage(read_token_files(spark, path), "token_rows")
    clear_scratch(spark, path)
    return with_starts(found)
