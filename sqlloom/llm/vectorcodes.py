"""Product quantization of vectors: integer codebooks, exact products in limbs.

A vector's components become whole numbers and are cut into parts; each part position has a codebook of
``ENTRIES`` entries, trained in ``ROUNDS`` passes over all vectors.  Squared distances are exact: numbers are split into limbs
so short that a float64 matrix product of limbs stays below 2^53, products are put together in 64-bit integers,
and the first smallest distance wins, so ties go to the lower index.  A task sends one row for each entry and position that
it has used, so a pass shuffles sums only; the driver holds the codebooks, whose size doesn't depend on the data.

Defined cases: vectors that are null or hold null, NaN or infinite components are dropped; repeated rows count and return one
by one; a null id comes after all others, and equal ids go by their components; fewer vectors than entries make shorter codebooks; vectors
of another length than the one with the smallest id have no code and a null error; an empty table gives no rows; other columns are not
read.  Numbers of 2^48 and more in size, errors beyond a long, or a length that the parts don't divide, are refused.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.llm.common import saved

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 1 << 48
SUM_BITS = 24
ROWS_AT_ONCE = 4096


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as sums of limb << (bits * place): lower limbs are not negative, the last has the sign."""
    found = []
    while len(x) and x.size and max(-int(x.min()), int(x.max())) >= 1 << bits:
        found.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*found, x.astype(np.float64)]


def dot_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact modulo 2^64."""
    width = a.shape[1]
    bits = (53 - max(width, 1).bit_length()) // 2
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            if bits * (i + j) < 64:
                total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``parts`` the index of the first nearest entry, and the squared distance."""
    width = parts.shape[1]
    most = max((int(abs(x).max()) for x in (parts, book) if x.size), default=0)
    if 4 * most * most * max(width, 1) < 1 << 63:
        squares = (book * book).sum(axis=1)
        distance = squares[None, :] - 2 * dot_products(parts, book)
        best = distance.argmin(axis=1)
        return best, distance[np.arange(len(parts)), best] + (parts * parts).sum(axis=1)
    best, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    whole = book.astype(object)
    for n, row in enumerate(parts.astype(object)):
        distance = ((whole - row) ** 2).sum(axis=1).tolist()
        best[n] = distance.index(min(distance))
        error[n] = min(distance)  # raises OverflowError where a long can't hold it
    return best, error


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, x): the vectors that are kept, as arrays of whole numbers."""
    fine = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    small = F.forall("x", lambda v: F.abs(v) < LARGEST)
    kept = vectors.where(F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label"),
        F.transform("embedding", lambda v: F.floor(v.cast("double") * scale)).cast("array<bigint>").alias("x"),
    )
    return kept.select("vec_id", "label", F.when(small, F.col("x")).otherwise(F.raise_error(F.lit("a component is too large"))).alias("x"))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(n, -1)


class Codebooks:
    """One codebook for each part position: int64 arrays of the same shape."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.length = sum(b.shape[1] for b in books)

    def sha256(self) -> str:
        """Of all entries' components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


def first_codebooks(numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; None without vectors."""
    rows = numbers.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not rows:
        return None
    length = len(rows[0].x)
    if length % parts:
        raise ValueError(f"{parts} parts don't divide vectors of {length} components")
    first = np.array([r.x for r in rows if len(r.x) == length], np.int64).reshape(-1, length)
    return Codebooks(np.split(first, parts, axis=1))


def _alike(numbers: DataFrame, length: int) -> DataFrame:
    return numbers.where(F.size("x") == length)


def part_sums(numbers: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, place, n, low, high): sums of the parts that each entry is nearest to, in two limbs."""
    held = books.books

    def task(batches):
        sums = [np.zeros((2, *b.shape), np.int64) for b in held]
        counts = [np.zeros(len(b), np.int64) for b in held]
        for batch in batches:
            x = _matrix(batch.column(0), batch.num_rows)
            for at in range(0, len(x), ROWS_AT_ONCE):
                for p, part in enumerate(np.split(x[at : at + ROWS_AT_ONCE], len(held), axis=1)):
                    code, _ = nearest(part, held[p])
                    order = np.argsort(code, kind="stable")
                    used, first, n = np.unique(code[order], return_index=True, return_counts=True)
                    counts[p][used] += n
                    if part.shape[1]:
                        sums[p][0, used] += np.add.reduceat(part[order] & ((1 << SUM_BITS) - 1), first, axis=0)
                        sums[p][1, used] += np.add.reduceat(part[order] >> SUM_BITS, first, axis=0)
        for p, n in enumerate(counts):
            used, width = np.flatnonzero(n), held[p].shape[1]
            if len(used) and width:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used) * width, p, np.int32)),
                        pa.array(np.repeat(used, width).astype(np.int32)),
                        pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                        pa.array(np.repeat(n[used], width)),
                        pa.array(sums[p][0, used].ravel()),
                        pa.array(sums[p][1, used].ravel()),
                    ],
                    ["part", "entry", "place", "n", "low", "high"],
                )

    found = _alike(numbers, books.length).select("x").mapInArrow(task, "part int, entry int, place int, n bigint, low bigint, high bigint")
    return found.groupBy("part", "entry", "place").agg(*[F.sum(c).alias(c) for c in ("n", "low", "high")])


def trained(numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after all rounds: entries become the rounded-down means of their parts, unused ones stay."""
    books = first_codebooks(numbers, parts, entries)
    for _ in range(rounds if books else 0):
        now = [b.copy() for b in books.books]
        # One row for each component of the codebooks, whatever the number of vectors.
        for r in part_sums(numbers, books).collect():
            now[r.part][r.entry, r.place] = ((r.high << SUM_BITS) + r.low) // r.n
        books = Codebooks(now)
    return books


def coded(numbers: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, codes, error): the nearest entry of each part and the squared distances' sum."""
    schema = "codes array<int>, error bigint"
    if books is None:
        return numbers.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("bigint").alias("error"))
    held = books.books
    label = numbers.schema["label"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            x = _matrix(batch.column(2), batch.num_rows)
            codes, error = np.empty((len(x), len(held)), np.int32), np.zeros(len(x), np.int64)
            for at in range(0, len(x), ROWS_AT_ONCE):
                for p, part in enumerate(np.split(x[at : at + ROWS_AT_ONCE], len(held), axis=1)):
                    codes[at : at + ROWS_AT_ONCE, p], e = nearest(part, held[p])
                    error[at : at + ROWS_AT_ONCE] += e
            if (error < 0).any():
                raise OverflowError("an error doesn't fit a long")
            ends = pa.array(np.arange(0, codes.size + 1, len(held), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(codes.ravel())), pa.array(error)],
                ["vec_id", "label", "codes", "error"],
            )

    done = _alike(numbers, books.length).mapInArrow(task, f"vec_id bigint, label {label}, {schema}")
    other = numbers.where(F.size("x") != books.length)
    return done.unionByName(other.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("bigint").alias("error")))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, codes, error, label_error) for every vector kept, and the codebooks.

    label_error is the sum of the errors of all rows with the same label, nulls together.
    """
    numbers = saved(whole_numbers(vectors, scale), "vector-numbers")
    books = trained(numbers, parts, entries, rounds)
    codes = saved(coded(numbers, books), "vector-codes")
    # Written, so that Spark sees its size: few labels are broadcast, many are joined with split hot labels.
    sums = saved(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "vector-label-errors")
    joined = codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "label", "codes", "error", "label_error")
    return joined, books
