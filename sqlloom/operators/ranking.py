"""Exact positions and first rows without sending a whole group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.functions.text import computed, keyed_hash
from sqlloom.session import run_folder, written


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` per key; ``order`` must be unique.

    A minimum combines before the shuffle, so a key that holds most of the rows costs
    one value per task.  Other columns come back through a join on the unique column.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias(order))
    if set(df.columns) == {*keys, order}:
        return first.select(*df.columns)
    return df.join(first.select(order), order, "left_semi").select(*df.columns)


def keyed_rank(
    df: DataFrame, groups: Sequence[str], key: str, seed, name: str = "rank", spread_digits: int = 3
) -> DataFrame:
    """1-based rank in each group by a seeded hash of a unique key.

    Each group is spread over 16 ** spread_digits ranges of the hash.  Ranks are counted
    inside a range and shifted by the sizes of the ranges before it, so that a task sees
    one range of a group only, however large the group is.
    """
    spread = computed(df, _hash=keyed_hash(seed, key)).withColumn("_part", F.substring("_hash", 1, spread_digits))
    where = [*groups, "_part"]
    sizes = spread.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*where, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*where).orderBy("_hash", key)
    return (
        spread.withColumn("_row", F.row_number().over(inside))
        .join(shifts, where)
        .select(*df.columns, (F.col("_row") + F.col("_shift")).cast("bigint").alias(name))
    )


def with_position(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """0-based position of every row in the order of a unique column.

    Rows are dealt by ranges and sorted in them; a row's id counts rows inside its
    partition, and the sizes of the partitions before it are added.  The number of
    partitions follows the data, and only one row for each of them is summed up.
    """
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    numbered = ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    stored = written(numbered, f"{run_folder(df.sparkSession, 'positions')}/rows")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(shifts, "_part").select(*df.columns, (inside + F.col("_shift")).cast("bigint").alias(name))


def slice_rows(df: DataFrame, order: str, start: int = 0, end: int = -1) -> DataFrame:
    """Rows at positions [start, end); a negative end means all, bounds beyond the data are cut."""
    ranked = with_position(df, order, "_position")
    keep = F.col("_position") >= start
    if end >= 0:
        keep = keep & (F.col("_position") < end)
    return ranked.where(keep).drop("_position")


def with_chunk(df: DataFrame, order: str, size: int, name: str = "chunk", first: int = 0) -> DataFrame:
    """Number of the run of ``size`` rows that a row falls into, counted from ``first``."""
    ranked = with_position(df, order, "_position")
    return ranked.withColumn(name, F.floor(F.col("_position") / size).cast("bigint") + first).drop("_position")


def shuffled(df: DataFrame, key: str, seed) -> DataFrame:
    """All rows in the order of a seeded hash of a unique key: a repeatable shuffle."""
    return df.orderBy(keyed_hash(seed, key), key)


def scattered(df: DataFrame, key: str, seed, partitions: int) -> DataFrame:
    """A cheaper shuffle for writing: rows go to files by hash and are ordered by hash in each."""
    where = keyed_hash(seed, key)
    return df.repartition(partitions, where).sortWithinPartitions(where, key)
