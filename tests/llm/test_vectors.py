"""Vector codes against whole-number arithmetic in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlloom.llm import vectorcodes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def slow(rows, parts=4, entries=256, rounds=4):
    """(vec_id, codes, error, label_error) of every kept row, and the digest of the codebooks."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    books = [[r[1][p * width : (p + 1) * width] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    def assigned():
        return [[nearest(p, r[1][p * width : (p + 1) * width]) for p in range(parts)] for r in kept]

    for _ in range(rounds):
        near = assigned()
        for p in range(parts):
            for n in range(len(books[p])):
                own = [r[1][p * width : (p + 1) * width] for r, a in zip(kept, near) if a[p][1] == n]
                if own:
                    books[p][n] = [sum(c) // len(own) for c in zip(*own)]
    near = assigned()
    error = [sum(d for d, _ in a) for a in near]
    by_label = {}
    for r, e in zip(kept, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(r[0]), [n for _, n in a], e, by_label[r[2]]) for r, a, e in zip(kept, near, error)), sha


def check(spark, rows, entries=256):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"x": F.lit(7), "error": F.lit("x"), "_label": F.lit(1)})
    codes, books = V.compressed(df, entries=entries)
    expected, sha = slow(rows, entries=entries)
    assert sorted((str(r.vec_id), r.codes, r.error, r.label_error) for r in codes.collect()) == expected
    assert books.sha256() == sha


def vectors(n, seed=1, width=8):
    rng = random.Random(seed)
    return [(k * 3, [rng.gauss(0, 1) for _ in range(width)], k % 5 if k % 7 else None) for k in range(n)]


def test_codes_by_plain_arithmetic(spark):
    check(spark, vectors(300), entries=16)


def test_nulls_ties_repeated_rows_and_null_ids(spark):
    rows = vectors(40)
    rows += [(1, None, 1), (2, [1.0] * 7 + [None], 1), (4, [float("nan")] * 8, 2), (5, [float("inf")] + [0.0] * 7, 2), (7, [-float("inf")] * 8, None)]
    rows += [rows[0], rows[0], (9, rows[3][1], 4), (9, rows[4][1], 4), (None, rows[5][1], None), (None, [0.5] * 8, None), (11, [-1e-9] * 8, 3)]
    check(spark, rows, entries=8)
    check(spark, rows)


def test_a_third_of_all_rows_in_one_label_and_vector(spark):
    rows = vectors(120)
    check(spark, rows + [(1000 + n, rows[0][1], 3) for n in range(60)], entries=16)


def test_large_numbers_are_exact(spark):
    rng = random.Random(3)
    check(spark, [(n, [rng.choice([1e3, -4e5, 3e4]) * rng.random() for _ in range(8)], 0) for n in range(60)], entries=4)


@pytest.mark.parametrize("most", [1 << 10, 1 << 24, 1 << 30, 1 << 40])
def test_products_in_limbs(most):
    rng = np.random.default_rng(2)
    a, b = rng.integers(-most, most, (7, 33)), rng.integers(-most, most, (5, 33))
    exact = (a.astype(object) @ b.astype(object).T) % (1 << 64)
    assert (V.dot_products(a, b).astype(object) % (1 << 64) == exact).all()


def test_distances_beyond_a_product_of_limbs():
    a = np.array([[1 << 40, -(1 << 40)], [3, 4]])
    book = np.array([[(1 << 40) - 1, 2 - (1 << 40)], [0, 0], [0, 0]])
    best, error = V.nearest(a, book)
    assert best.tolist() == [0, 1] and error.tolist() == [5, 25]


def test_empty_table_other_lengths_and_refusals(spark):
    empty = spark.createDataFrame([], SCHEMA)
    codes, books = V.compressed(empty)
    assert codes.count() == 0 and books is None
    assert V.compressed(spark.createDataFrame([(1, None, 1)], SCHEMA))[0].count() == 0
    rows = [*vectors(10), (500, [1.0] * 4, 1), (501, [], None)]
    found = {r.vec_id: r for r in V.compressed(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    assert len(found) == 12 and found[500].codes is None and found[500].error is None and found[0].codes is not None
    with pytest.raises(ValueError):
        V.compressed(spark.createDataFrame([(1, [1.0] * 6, 1)], SCHEMA))


def test_the_query_writes_hex_digits(spark):
    from sqlloom.llm import queries
    from tests.llm.test_scores import SF_DIR

    df = queries.op11_vector_codes(spark, SF_DIR)
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert all(len(r.code) == 8 and int(r.code, 16) >= 0 for r in df.limit(20).collect())
