"""Example questions: label gate, buckets by join count, nearest bucket, draws per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.sqltext import join_count
from sqlloom.functions.text import col, strip
from sqlloom.operators.ranking import keyed_rank
from sqlloom.operators.sampling import draw_positions


def build_examples(*sources: DataFrame) -> DataFrame:
    """(nl_prompt, num_joins) from sources of (nl_prompt, sql_query), all rows of all sources."""
    labelled = [s.select("nl_prompt", join_count("sql_query").alias("num_joins")) for s in sources]
    result = labelled[0]
    for more in labelled[1:]:
        result = result.unionByName(more)
    return result


def distinct_examples(raw: DataFrame) -> DataFrame:
    """Trimmed, without empty questions, each (question, label) once."""
    return (
        raw.select(
            strip(F.coalesce("nl_prompt", F.lit(""))).alias("nl_prompt"),
            strip(F.coalesce("num_joins", F.lit(""))).alias("num_joins"),
        )
        .where(F.col("nl_prompt") != "")
        .distinct()
    )


def join_label(x) -> Column:
    """The label as an integer from 0 to 10, or null."""
    number = F.when(F.regexp_like(col(x), F.lit(r"\A[+-]?[0-9]+\z")), col(x).try_cast("int"))
    return F.when(number.between(0, fv.MAX_JOINS), number)


def valid_examples(raw: DataFrame) -> DataFrame:
    """Distinct examples whose label is a join count."""
    return distinct_examples(raw).withColumn("num_joins", join_label("num_joins")).where("num_joins is not null")


def example_buckets(examples: DataFrame) -> DataFrame:
    """(num_joins, n_examples) for every join count 0..10."""
    spark = examples.sparkSession
    every = spark.range(fv.MAX_JOINS + 1).select(F.col("id").cast("int").alias("num_joins"))
    counts = examples.groupBy("num_joins").agg(F.count(F.lit(1)).alias("n_examples"))
    return every.join(F.broadcast(counts), "num_joins", "left").select(  # at most eleven rows
        "num_joins", F.coalesce("n_examples", F.lit(0)).cast("bigint").alias("n_examples")
    )


def nearest_buckets(buckets: DataFrame) -> DataFrame:
    """(target_joins, used_joins, used_examples): the closest bucket with examples, the smaller one on a tie."""
    t = F.col("num_joins")
    filled = F.when(F.col("n_examples") > 0, F.struct(t.alias("j"), F.col("n_examples").alias("n")))
    order = Window.partitionBy(F.lit(0)).orderBy("num_joins")  # eleven rows
    below = F.last(filled, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(filled, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    nearer_above = F.col("above.j") - t < t - F.col("below.j")
    used = F.when(F.col("below").isNull() | nearer_above, F.col("above")).otherwise(F.col("below"))
    return buckets.withColumns({"below": below, "above": above}).withColumn("used", used).select(
        t.alias("target_joins"), F.col("used.j").alias("used_joins"),
        F.coalesce("used.n", F.lit(0)).cast("bigint").alias("used_examples"),
    )


def ranked_examples(examples: DataFrame, seed) -> DataFrame:
    """(num_joins, position, nl_prompt): positions 0.. in each bucket, in seeded order."""
    return keyed_rank(examples, ["num_joins"], "nl_prompt", seed, "_rank").select(
        "num_joins", (F.col("_rank") - 1).alias("position"), "nl_prompt"
    )


def draw_examples(requests: DataFrame, key: str, target: str, examples: DataFrame, k: int, seed) -> DataFrame:
    """Add (examples_joins, examples): up to k examples of the nearest bucket per request.

    A request draws k positions in its bucket and fetches those rows by an equality
    join, so requests and examples never meet in pairs.
    """
    nearest = nearest_buckets(example_buckets(examples)).withColumnRenamed("target_joins", target)
    placed = requests.join(F.broadcast(nearest), target)  # eleven rows
    wanted = placed.select(
        key, F.col("used_joins").alias("num_joins"),
        F.posexplode(draw_positions("used_examples", k, seed, key)).alias("_slot", "position"),
    )
    found = (
        wanted.join(ranked_examples(examples, seed), ["num_joins", "position"])
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("_slot", "nl_prompt"))).alias("_found"))  # k at most
    )
    none = F.array().cast("array<string>")
    return placed.join(found, key, "left").select(
        *requests.columns,
        F.coalesce("used_joins", target).alias("examples_joins"),
        F.coalesce(F.col("_found.nl_prompt"), none).alias("examples"),
    )
