"""Mixing sources to target weights: capped water-filling and seeded repetitions (native).

Each source gets ``level * weight`` words, but at most ``max_epochs`` times its size; the level is
the one at which the targets add up to the wanted share of all words.  It is found in closed form
from running sums over the sources ordered by size / weight, which gives the same fixed point as
sharing the excess again and again.  A target is then met by whole repetitions of every
document plus a seeded part: documents in the order of a keyed hash as long as their words fit.

The hash order is dealt over 16 ** ``BIN_DIGITS`` bins for each source, so a source with a third of all rows
is ranked in thousands of groups, and the word sums combine before the shuffle.

Defined cases: a null text has size 0, takes 0 words and is repeated as often as its whole source; the null source is a source of its own and
comes last; sources without words have target 0; an empty table gives an empty result; equal rows
share a hash, any order among them gives the same sums; other columns are kept by ``mix`` and not
read by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.functions.text import keyed_hash
from sqlloom.llm.common import as_row, from_row, saved, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 7
BIN_DIGITS = 3  # hexadecimal digits of the hash: 4,096 bins a source


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size); sources are few next to rows."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    weighed = by_source.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(max_epochs)))
    # Sources fill up in the order of most / weight; nothing is left for one that is full below the level.
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    leveled = weighed.select(
        "*",
        (
            (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / F.sum("weight").over(onward)
        ).alias("own_level"),
    )
    # The first source that its own level doesn't fill has the common level; if all are full, any will do.
    level = F.min(F.when(F.col("own_level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("own_level").alias("level")))).over(everything)
    return leveled.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("most"), F.col("weight") * level["level"]), F.col("most")).alias("target"),
    )


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, keep: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs) and the columns in ``keep``, a row for each row of docs."""
    hashed = docs.select("doc_id", "source", word_count("text").alias("size"), keyed_hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("draw"), *keep)
    rows = saved(hashed, "mix-sizes")
    rows = rows.withColumn("bin", F.substring("draw", 1, BIN_DIGITS))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    targets = source_targets(bins.select("source", F.col("bin_size").alias("size")), weights, share, max_epochs)
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("words_before", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0))).drop("bin_size")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    offers = (
        bins.withColumnRenamed("source", "_source").join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select(F.col("_source"), F.col("bin").alias("_bin"), "words_before", "source_size", "target", whole.alias("whole"))
    )
    inside = Window.partitionBy("source", "bin").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("in_bin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = ranked.join(offers, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin"))).drop("_source", "_bin")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    drawn = (F.col("size") > 0) & (F.col("words_before") + F.col("in_bin") + F.col("size") / 2 <= rest)
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") + drawn.cast("bigint")).alias("epochs"), *keep)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs, all columns, each as often as the mix takes it.

    Rows with the same doc_id are told apart by their text and source.
    """
    mark = F.xxhash64("text", "source")
    taken = plan(docs.select("doc_id", "source", "text", mark.alias("mark")), keep=("mark",), **options).where("epochs > 0")
    copies = taken.groupBy("doc_id", "mark").agg(F.sum("epochs").alias("epochs"), F.count("*").alias("n"))
    rows = docs.select(as_row(docs))
    same = F.col("_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("_row.text", "_row.source") == F.col("mark"))
    # Rows with the same id, text and source share the epochs taken for them: the first of them stand in for all.
    turn = F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("n"))
    single = rows.join(copies.where("n = 1"), same).select("_row", F.col("epochs").alias("times"))
    several = rows.join(copies.where("n > 1"), same).select(
        "_row", (F.floor(F.col("epochs") / F.col("n")) + (turn <= F.col("epochs") % F.col("n")).cast("bigint")).alias("times")
    )
    times = single.union(several).where("times > 0")
    return from_row(times.select("_row", F.explode(F.sequence(F.lit(1), "times"))), docs.columns)
