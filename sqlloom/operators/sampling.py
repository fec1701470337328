"""Distributions, quotas and keyed draws.  Nothing here uses an unseeded random source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.text import col, computed, keyed_bits, keyed_hash, keyed_uniform

# Cells of the lookup grid for weighted draws: a broadcast table holds one row per
# value and cell at most.
CELLS = 1024


def join_probability(j) -> Column:
    """Weight of a join count: 0.15, 0.20, then falling evenly to 0 at 10.  Sums to 0.95."""
    j = col(j)
    return (
        F.when(j == 0, F.lit(0.15))
        .when(j == 1, F.lit(0.2))
        .when(j.between(2, fv.MAX_JOINS), F.lit(0.60 / 36) * (fv.MAX_JOINS - j))
        .otherwise(F.lit(0.0))
    )


def draw_joins(seed, *keys) -> Column:
    """A join count drawn by its weight; the mass left over goes to the largest count."""
    u = keyed_uniform(seed, *keys)
    total, draw = 0.0, None
    for j in range(fv.MAX_JOINS + 1):
        total += 0.15 if j == 0 else 0.2 if j == 1 else 0.60 / 36 * (fv.MAX_JOINS - j)
        hit = u <= F.lit(total)
        draw = F.when(hit, F.lit(j)) if draw is None else draw.when(hit, F.lit(j))
    return draw.otherwise(F.lit(fv.MAX_JOINS))


def draw_flag(share: float, seed, *keys) -> Column:
    """True for about this share of the keys."""
    return keyed_uniform(seed, *keys) < F.lit(share)


def growth_step(current, target, seed, *keys) -> Column:
    """How many tables to ask for next: 15 to 25, but no more than are missing."""
    wanted = F.lit(15) + F.pmod(keyed_bits(seed, *keys), F.lit(11)).cast("int")
    return F.least(wanted, col(target) - col(current))


def table_count_density(spark: SparkSession, mode: int, max_tables: int, ramp_start: float) -> DataFrame:
    """Density of table counts 0..max_tables: (num_tables, density).

    A gamma shape with the given mode, scaled to 1 at its peak; below the peak it is
    replaced by a straight ramp from ``ramp_start`` to 1; then scaled to sum 1.  Growth
    starts the ramp at 0.5, fitting at 0.7.
    """
    theta = max_tables / 10
    shape = max(mode / theta + 1, 1.5)
    x = F.col("num_tables").cast("double")
    everything = Window.partitionBy(F.lit(0))  # max_tables + 1 rows
    return (
        spark.range(max_tables + 1)
        .select(F.col("id").cast("int").alias("num_tables"))
        .withColumn("y", F.pow(x, F.lit(shape - 1)) * F.exp(-x / theta))
        .withColumn("peak", F.max_by("num_tables", F.struct("y", -F.col("num_tables"))).over(everything))
        .withColumn("y", F.col("y") / F.max("y").over(everything))
        .withColumn(
            "y",
            F.when(
                F.col("num_tables") < F.col("peak"),
                F.lit(ramp_start) + F.lit(1 - ramp_start) * x / F.greatest(F.col("peak") - 1, F.lit(1)),
            ).otherwise(F.col("y")),
        )
        .select("num_tables", (F.col("y") / F.sum("y").over(everything)).alias("density"))
    )


def quotas(density: DataFrame, total) -> DataFrame:
    """Rows wanted per table count: density times total, rounded half to even."""
    return density.select("num_tables", F.bround(F.col("density") * total).cast("int").alias("target"))


def cumulative(weights: DataFrame, value: str, weight: str) -> DataFrame:
    """(value, low, high): the part of [0, 1) that belongs to each value, in value order."""
    upto = Window.partitionBy(F.lit(0)).orderBy(value)  # one row per value of a fixed domain
    high = F.sum(weight).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    bounds = weights.withColumn("high", F.round(high, 9))
    return bounds.select(value, F.lag("high", 1, 0.0).over(upto).alias("low"), "high")


def draw_weighted(df: DataFrame, bounds: DataFrame, value: str, seed, *keys: str) -> DataFrame:
    """Add a value drawn by its weight.

    The unit interval is cut into equal cells; a value is listed in each cell it
    overlaps, so the lookup is an equality join on the cell plus a range check.
    ``bounds`` comes from :func:`cumulative` over a fixed domain, hence the broadcast.
    """
    last = F.max(F.when(F.col("high") > F.col("low"), F.col(value))).over(Window.partitionBy(F.lit(0)))
    listed = (
        bounds.withColumn("_last", last)
        .where(F.col("high") > F.col("low"))
        # Rounding may leave a sliver below 1: it belongs to the last value with weight.
        .withColumn("high", F.when(F.col(value) == F.col("_last"), F.lit(1.0)).otherwise(F.col("high")))
        .withColumn("_cell", F.explode(F.sequence(
            F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
        .select(value, "low", "high", "_cell")
    )
    drawn = df.withColumn("_u", keyed_uniform(seed, *keys)).withColumn("_cell", F.floor(F.col("_u") * CELLS))
    hit = (F.col("_u") >= F.col("low")) & (F.col("_u") < F.col("high"))
    return drawn.join(F.broadcast(listed), "_cell").where(hit).drop("_u", "_cell", "low", "high")


def quota_sample(df: DataFrame, key: str, targets: DataFrame, seed) -> DataFrame:
    """Mark which rows to keep: (columns, action) with KEEP, SKIP or OVER_MAX.

    In each table count, the rows with the smallest seeded hashes are kept up to the
    target.  Table counts without a target are above the largest one wanted.

    Rows are counted once by table count and three hash digits, at most 4,096 rows a count.  Where a
    target is reached inside a range, the rows of that range alone are ranked to find the last hash
    kept; then every row is decided where it is, however large a bucket is.  Give a stored
    table when the counts are costly.
    """
    placed = computed(df, _hash=keyed_hash(seed, key)).withColumn("_part", F.substring("_hash", 1, 3))
    cells = placed.groupBy("num_tables", "_part").agg(F.count(F.lit(1)).alias("_n"))
    by_count = Window.partitionBy("num_tables").orderBy("_part")
    earlier = F.coalesce(F.sum("_n").over(by_count.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = cells.withColumn("_before", earlier).join(F.broadcast(targets.select("num_tables", "target")), "num_tables")
    here = (F.col("_before") < F.col("target")) & (F.col("_before") + F.col("_n") > F.col("target"))
    edges = ranges.where(here).select("num_tables", "_part", (F.col("target") - F.col("_before")).alias("_take"))
    # One row at most for each table count wanted.
    in_edge = placed.join(F.broadcast(edges), ["num_tables", "_part"])
    place = F.row_number().over(Window.partitionBy("num_tables").orderBy("_hash", key))
    last = in_edge.withColumn("_place", place).where("_place = _take").select("num_tables", F.struct("_hash", key).alias("_last"))
    # Without such a row the target ends at a range, or isn't reached.
    whole = ranges.where(F.col("_before") + F.col("_n") <= F.col("target")).groupBy("num_tables").agg(F.max("_part").alias("_full"))
    limits = targets.select("num_tables", "target").join(whole, "num_tables", "left").join(last, "num_tables", "left")
    kept = (F.col("_part") <= F.col("_full")) | (F.struct("_hash", key) <= F.col("_last"))
    action = F.when(F.col("target").isNull(), "OVER_MAX").when(F.coalesce(kept, F.lit(False)), "KEEP").otherwise("SKIP")
    decided = placed.join(F.broadcast(limits), "num_tables", "left")
    return decided.withColumn("action", action).select(*df.columns, "action")


def draw_positions(n, k: int, seed, *keys) -> Column:
    """k different positions out of 0..n-1, every k-subset equally likely; all of them if n <= k.

    Robert Floyd's method: for j = n-k .. n-1 draw t in 0..j and take t, or j if t is taken.
    """
    n = col(n)
    taken = F.array().cast("array<bigint>")
    for i in range(k):
        j = n - F.lit(k - i)
        t = F.floor(keyed_uniform(seed, *keys, F.lit(i)) * (j + 1)).cast("bigint")
        taken = F.array_append(taken, F.when(F.array_contains(taken, t), j.cast("bigint")).otherwise(t))
    every = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.when(n <= k, every).otherwise(taken)
