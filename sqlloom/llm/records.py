"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record is framed as: length of the payload (4 bytes), masked checksum of those 4 bytes,
payload, masked checksum of the payload, line feed.  The payload is one byte (1 with a doc_id, 0
without), the doc_id (8 bytes), the bytes per id (1 byte: 2 or 4) and the ids.  All numbers are
little-endian; checksums are CRC-32, rotated by 15 bits and shifted by a constant, so that a checksum
of data that holds checksums stays sound.

Spark's text writer puts the frames into files byte by byte, so files work on every file system
that Spark reaches and a lost task leaves nothing behind.  Texts are dealt by ranges of doc_id
and sorted in a range, so files and the records in them ascend.  A file is cut to about
``SHARD_BYTES`` of text.  Files are read whole by the binary reader, one row a file.

Defined cases: a null text counts as empty and gives the end id only; rows without a doc_id come
first; rows with the same doc_id stay side by side, by text; an empty table gives no records;
other columns are not read; a broken frame raises.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sqlloom.functions.text import keyed_hash
from sqlloom.llm.common import saved
from sqlloom.llm.encoding import encoder
from sqlloom.session import run_folder

END_ID = 1
SHARD_BYTES = 32 << 20
MASK_SHIFT = 0xA282EAD8
KEY = "<BqB"
KEY_BYTES = struct.calcsize(KEY)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_SHIFT) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = struct.pack(KEY, doc_id is not None, doc_id or 0, width) + ids
    size = struct.pack("<I", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload)), b"\n"))


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, where the next frame starts) of the frame that starts at ``at``."""
    size, check = struct.unpack_from("<II", data, at)
    end = at + 8 + size
    if masked(bytes(data[at : at + 4])) != check or end + 5 > len(data):
        raise ValueError(f"broken record length at byte {at}")
    payload = data[at + 8 : end]
    if masked(payload) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError(f"broken record at byte {at}")
    has_id, doc_id, width = struct.unpack_from(KEY, payload)
    return doc_id if has_id else None, np.frombuffer(payload[KEY_BYTES:], f"<u{width}"), end + 5


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode docs and write the record files in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def task(batches):
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        width = encode.dtype.itemsize
        for batch in batches:
            made, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made.append(frame(doc_id, encode(text) + end, width))
                held += len(made[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["frame"])
                    made, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["frame"])

    framed = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(task, "frame binary")
    # The writer puts the line feed behind each frame, so a frame is handed over without its own.
    framed.select(F.expr("cast(substr(frame, 1, length(frame) - 1) as string)").alias("value")).write.option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def index_records(spark: SparkSession, path: str) -> DataFrame:
    """(shard, offset, bytes, doc_id, n_tokens, ids_crc32) of every record, all checksums tested."""

    def task(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, rows = memoryview(content.as_buffer()), 0, []
                while at < len(data):
                    doc_id, ids, after = unframe(data, at)
                    rows.append((shard, at, after - at, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at = after
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000])
                    kinds = [pa.int32(), *[pa.int64()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["shard", "offset", "bytes", "doc_id", "n_tokens", "ids_crc32"]
    return _files(spark, path).mapInArrow(task, "shard int, " + ", ".join(f"{n} bigint" for n in names[1:]))


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the number of ids in all records before.

    Sums run inside a file, and over one row for each file.
    """
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("shard"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    running = index.withColumn("in_shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return running.join(bases, "shard").withColumn("start", F.col("base") + F.col("in_shard")).drop("base", "in_shard")


def read_records(spark: SparkSession, path: str, index: DataFrame, seed: int | None = None) -> DataFrame:
    """(doc_id, ids) of the records in ``index``; with a seed in an order drawn from it."""
    wanted = index.groupBy("shard").agg(F.collect_list("offset").alias("offsets"))

    def task(batches):
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1).to_pylist()):
                data = memoryview(content.as_buffer())
                for k in range(0, len(offsets), 1000):
                    found = [unframe(data, at) for at in offsets[k : k + 1000]]
                    ids = pa.array([f[1].astype(np.int64).tolist() for f in found], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), ids], ["doc_id", "ids"])

    read = _files(spark, path).join(wanted, "shard").select("content", "offsets").mapInArrow(task, "doc_id bigint, ids array<bigint>")
    return read if seed is None else read.orderBy(keyed_hash(seed, "doc_id"))


def tokenized(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write docs as record files, index them, and return the index with starts."""
    spark = docs.sparkSession
    path = path or run_folder(spark, "records")
    write_records(docs, path, tokenizer, end_id)
    return with_starts(saved(index_records(spark, path), "records-index"))
