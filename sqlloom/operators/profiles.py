"""Counts, shares and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions.ddl import has_foreign_key


def reason_counts(records: DataFrame) -> DataFrame:
    """(reason, n) over rows with a drop reason."""
    return records.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def foreign_key_flags(schemas: DataFrame, name: str = "schema_file", text: str = "schema_sql") -> DataFrame:
    """(file_name, foreign_key) for every schema text."""
    return schemas.select(F.col(name).alias("file_name"), has_foreign_key(text).alias("foreign_key"))


def foreign_key_share(flags: DataFrame) -> DataFrame:
    """One row: total, with_fk, without_fk, percent_without."""
    total, without = F.count(F.lit(1)), F.count_if(~F.col("foreign_key"))
    return flags.agg(
        total.alias("total"),
        F.count_if("foreign_key").alias("with_fk"),
        without.alias("without_fk"),
        F.try_divide(without * 100.0, total).alias("percent_without"),
    )


def table_histogram(counts: DataFrame, max_tables: int | None = None) -> DataFrame:
    """(num_tables, n) for 0..max, with zeros; max is the largest observed count by default."""
    spark = counts.sparkSession
    seen = counts.groupBy("num_tables").agg(F.count(F.lit(1)).alias("n"))
    if max_tables is None:
        top = seen.agg(F.coalesce(F.max("num_tables"), F.lit(0)).alias("top"))
        every = top.select(F.explode(F.sequence(F.lit(0), "top")).alias("num_tables"))
    else:
        every = spark.range(max_tables + 1).select(F.col("id").cast("int").alias("num_tables"))
    return every.join(seen, "num_tables", "left").select(
        "num_tables", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def action_histogram(decided: DataFrame) -> DataFrame:
    """(num_tables, observed, kept, skipped, over_max) from the decisions of a quota sample."""
    return decided.groupBy("num_tables").agg(
        F.count(F.lit(1)).alias("observed"),
        F.count_if(F.col("action") == "KEEP").alias("kept"),
        F.count_if(F.col("action") == "SKIP").alias("skipped"),
        F.count_if(F.col("action") == "OVER_MAX").alias("over_max"),
    )


def repeated_questions(records: DataFrame) -> DataFrame:
    """(question, n) of non-empty questions that occur more than once."""
    return (
        records.where(F.coalesce("question", F.lit("")) != "")
        .groupBy("question").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def empty_table_share(files: DataFrame) -> DataFrame:
    """One row: percent of files whose ``tables`` array is missing or empty; 0.0 without files."""
    empty = F.when(F.coalesce(F.size("tables"), F.lit(0)) > 0, 0.0).otherwise(100.0)
    return files.agg(F.coalesce(F.avg(empty), F.lit(0.0)).alias("empty_percent"))
