"""Best-fit-decreasing packing of token sequences, planned on lengths and placed in parallel.

Lengths are whole numbers up to the capacity, so best-fit decreasing over all documents is
decided by how many pieces there are of each length.  The driver gets that histogram (one row a
length at most, whatever the corpus) and runs best-fit decreasing on it: a segment tree over
remaining capacities finds the tightest open bins in logarithmic time, and equal
bins move together as ranges.  The outcome is a table of ranges of ranks to ranges of bins.  Every
piece then finds its place from its rank among the pieces of its length, which is its number in
its own written part plus a running sum over the parts: no group of pieces is ever gathered.

Defined cases: a null or empty text is one piece that holds the end id only; only documents longer than the
capacity are cut, into full pieces behind a first one that may be shorter; repeated rows are packed
each by itself; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.llm.common import saved
from sqlloom.llm.encoding import encoder

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary, ids_crc32 bigint, part int, nth bigint"


def piece_spans(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with so many ids."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document with their ids (32-bit little-endian), numbered by part and length."""

    def task(batches):
        encode = encoder(tokenizer)
        part, seen = TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate((np.frombuffer(encode(text), encode.dtype).astype("<u4"), end))
                for n, (start, length) in enumerate(piece_spans(len(ids), capacity)):
                    data = ids[start : start + length].tobytes()
                    rows.append((doc_id, n, start, length, data, zlib.crc32(data), part, seen[length]))
                    seen[length] += 1
                if len(rows) >= 1000:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))).mapInArrow(task, PIECES)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which of them have open bins."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)

    def change(self, remaining: int, bins: int) -> None:
        at = self.width + remaining
        while at:
            self.open[at] += bins
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of an open bin that is at least ``length``."""
        at = self.width + length
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.width
            at //= 2
        return None


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces, first bin, offset), sorted by length and rank."""
    tree = CapacityTree(capacity)
    ranges: dict[int, list[tuple[int, int]]] = {}
    rows, bins = [], 0

    def keep(remaining, first, n):
        if n and remaining:
            ranges.setdefault(remaining, []).append((first, n))
            tree.change(remaining, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            else:
                first, n = ranges[remaining].pop()
                tree.change(remaining, -n)
            # Best fit stays in the bin it has just used as long as the length fits.
            each = remaining // length
            full = min(n, left // each)
            more = min(left - full * each, each) if full < n else 0
            for count, at, fill in ((full, first, each), (1, first + full, more)):
                for k in range(fill if count else 0):
                    rows.append((length, rank, count, at, capacity - remaining + k * length))
                    rank += count
            left -= full * each + more
            keep(remaining - each * length, first, full)
            if more:
                keep(remaining - more * length, first + full, 1)
            keep(remaining, first + full + bool(more), n - full - bool(more))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of written pieces."""
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = saved(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
    ranked = cut.join(bases, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).select(
        "doc_id", "piece", "start", F.col("length").cast("bigint"), "ids_crc32", (F.col("_base") + F.col("nth")).alias("rank")
    )

    def task(batches):
        # Ranks of a length are below 2^51, so both fit into one number.
        keys = (plan[:, 0] << 51) + plan[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = np.searchsorted(keys, (length << 51) + rank, "right") - 1
            sequence = plan[row, 3] + rank - plan[row, 1]
            arrays = [*batch.columns[:5], pa.array(sequence), pa.array(plan[row, 4])]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(task, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Places of all pieces of docs."""
    return place(saved(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(cut: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids, for pieces whose (doc_id, piece) is unique."""
    ids = places.join(cut.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    # A sequence holds at most ``capacity`` ids, so these groups are small.
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return ids.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
