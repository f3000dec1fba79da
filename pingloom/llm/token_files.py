"""Token-id files: independent zstandard frames, one per document, with a trailing seek table.

A file is a run of records, each one zstandard frame followed by a one-byte skippable frame, then a skippable frame
that holds the seek table. The whole file is valid zstandard. A frame holds the ids of one document as little-endian
unsigned 32-bit integers and carries its own content checksum. The table has an entry per document (document, number
of ids, stored bytes, crc32 of the ids, in ``ENTRY``) and a tail (``TAIL``: number of entries, magic) at a fixed place
from the end, so that a reader finds a document's frame and decompresses nothing else.

Files are written by Spark's text writer, which commits tasks whole and reaches every file system: a record is a row,
and the line break the writer puts after it is the payload byte of the skippable frame.

Defined cases: a null or empty text holds only the end id; a null ``doc_id`` comes first and is stored as flag 1 in its
entry; rows of equal id are ordered by text and all kept; no rows give no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.frames import block_count, prepare, tidied
from pingloom.llm.pretokens import encoder
from pingloom.session import scratch_path

# Fixed values of the zstandard format.
SKIPPABLE = 0x184D2A50
# A skippable frame whose one byte of content is the line break of the text writer.
_PAD = struct.pack("<II", SKIPPABLE, 1)
MAGIC = b"TOKS"
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "<u4"), ("crc32", "<u4"), ("n_tokens", "<u8"), ("stored", "<u8")])
TAIL = struct.Struct("<Q4s")
END_ID = 0
LEVEL = 3
FILE_BYTES = 16 << 20


def _record(frame: bytes) -> bytes:
    return frame + _PAD


def _table(entries: np.ndarray) -> bytes:
    """The last record: a skippable frame that ends with the tail and the line break."""
    content = entries.tobytes() + TAIL.pack(len(entries), MAGIC)
    return struct.pack("<II", SKIPPABLE, len(content) + 1) + content


def write(
    documents: DataFrame, tokenizer: str, path: str, order: tuple[str, ...] = ("doc_id", "text"), file_bytes: int = FILE_BYTES
) -> None:
    """Encode all texts and write them in the order of some columns; ``tokenizer`` is a path that executors have.

    Rows are dealt to files by all but the last of these columns, so rows that differ in the last alone share a file.
    """
    prepare(documents.sparkSession)

    @tidied
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        tables = []
        for batch in batches:
            for piece in T.pieces(batch):
                ids, at = encoder(tokenizer).encode(piece.column("text"))
                entries = np.zeros(piece.num_rows, ENTRY)
                known = piece.column("doc_id")
                entries["doc_id"] = known.fill_null(0).to_numpy(zero_copy_only=False)
                entries["null"] = known.is_null().to_numpy(zero_copy_only=False)
                entries["n_tokens"] = np.diff(at) + 1
                records = []
                for t in range(piece.num_rows):
                    content = np.append(ids[at[t] : at[t + 1]], END_ID).astype("<u4").tobytes()
                    records.append(_record(pack.compress(content)))
                    entries[t]["crc32"] = zlib.crc32(content)
                    entries[t]["stored"] = len(records[-1]) + 1
                tables.append(entries)
                yield pa.RecordBatch.from_pydict({"record": pa.array(records, pa.binary())})
        if tables:
            yield pa.RecordBatch.from_pydict({"record": pa.array([_table(np.concatenate(tables))], pa.binary())})

    more = [c for c in order if c not in ("doc_id", "text")]
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)
    ordered = rows.repartitionByRange(block_count(rows, file_bytes), *order[:-1]).sortWithinPartitions(*order)
    ordered.select("doc_id", "text").mapInArrow(encode, "record binary").select(F.col("record").cast("string")).write.text(path)


def read_table(content: bytes) -> np.ndarray:
    """The seek table of a file."""
    end = len(content) - 1
    n, magic = TAIL.unpack_from(content, end - TAIL.size)
    if magic != MAGIC:
        raise ValueError("not a token file")
    return np.frombuffer(content, ENTRY, n, end - TAIL.size - n * ENTRY.itemsize)


def read_document(content: bytes, entries: np.ndarray, offsets: np.ndarray, number: int) -> np.ndarray:
    """The ids of one document; raises if they do not match their checksums."""
    frame = memoryview(content)[offsets[number] : offsets[number + 1]]
    ids = zstandard.ZstdDecompressor().decompress(frame, int(entries["n_tokens"][number]) * 4)
    if zlib.crc32(ids) != entries["crc32"][number]:
        raise ValueError(f"document {entries['doc_id'][number]} is damaged")
    return np.frombuffer(ids, "<u4")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Number and content of each file; the number in a file's name is its place in the order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content")


def read(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` of all documents, or of those wanted; only their frames are decompressed.

    Rows come with the file and place they were read from; ``start`` counts the ids before the document in its file.
    """
    prepare(spark)
    chosen = None if wanted is None else np.array(sorted(wanted), np.int64)

    @tidied
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, cell in zip(batch.column("file").to_pylist(), batch.column("content")):
                content = cell.as_buffer().to_pybytes()
                entries = read_table(content)
                offsets = np.concatenate(([0], np.cumsum(entries["stored"]))).astype(np.int64)
                before = np.concatenate(([0], np.cumsum(entries["n_tokens"]))).astype(np.int64)
                numbers = np.arange(len(entries))
                if chosen is not None:
                    numbers = numbers[np.isin(entries["doc_id"], chosen) & (entries["null"] == 0)]
                for lo in range(0, len(numbers), 512):
                    part = numbers[lo : lo + 512]
                    ids = [read_document(content, entries, offsets, k) for k in part]
                    yield pa.RecordBatch.from_pydict({
                        "file": np.full(len(part), file), "place": part,
                        "doc_id": pa.array(entries["doc_id"][part], mask=entries["null"][part] > 0),
                        "start": before[part], "n_tokens": entries["n_tokens"][part].astype(np.int64),
                        "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                    })

    return _files(spark, path).mapInArrow(decode, "file long, place long, doc_id long, start long, n_tokens long, ids binary")


def with_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows that were read, ``start`` now counting all ids of the corpus before a document."""

    @tidied
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(read_table(c.as_buffer().to_pybytes())["n_tokens"].sum()) for c in batch.column("content")]
            yield pa.RecordBatch.from_pydict({"file": batch.column("file"), "n": pa.array(sums, pa.int64())})

    sizes = _files(spark, path).mapInArrow(totals, "file long, n long")
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(bases, "file").withColumn("start", F.col("start") + F.col("base")).drop("base")


def round_trip(
    documents: DataFrame, tokenizer: str, path: str | None = None, order: tuple[str, ...] = ("doc_id", "text")
) -> DataFrame:
    """Write the token files of a corpus and read them all back: ``doc_id``, ``start``, ``n_tokens`` and crc32 of the ids."""
    spark = documents.sparkSession
    path = path or scratch_path(spark, "tokens")
    write(documents, tokenizer, path, order)
    if not spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # The digest is taken before the starts are joined, so the ids are never shuffled.
    rows = read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
