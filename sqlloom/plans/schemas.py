"""Schema jobs: render records, fit a table-count distribution, profile and strip foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.operators import sampling
from sqlloom.operators.gates import without_failed_names
from sqlloom.operators.lookups import with_marked_prefix
from sqlloom.operators.profiles import action_histogram, foreign_key_flags, foreign_key_share

FIT_RAMP, GROWTH_RAMP = 0.7, 0.5


def render_records(records: DataFrame, key: str) -> DataFrame:
    """(key, schema_sql, skipped): one schema text per nested record and its unrenderable tables.  Narrow."""
    return records.select(
        key, D.render_schema(F.col("TABLES")).alias("schema_sql"),
        F.filter("TABLES", lambda t: ~D.is_renderable(t)).alias("skipped"),
    )


def table_counts(schemas: DataFrame) -> DataFrame:
    """(schema_file, num_tables) of every schema that is not marked as failed; the texts stay behind."""
    return without_failed_names(schemas, "schema_file").select(
        "schema_file", D.table_count_uncommented("schema_sql").alias("num_tables")
    )


def fit_targets(counts: DataFrame, mode: int = 100, max_tables: int = 350) -> DataFrame:
    """(num_tables, target) for as many schemas as there are."""
    spark = counts.sparkSession
    density = sampling.table_count_density(spark, mode, max_tables, FIT_RAMP)
    observed = counts.groupBy("num_tables").agg(F.count(F.lit(1)).alias("n"))
    # One row per table count, so the sum over all of them is small work.
    total = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0))), F.lit(0))
    placed = density.join(observed, "num_tables", "full").withColumn("total", total).where("density is not null")
    return sampling.quotas(placed, F.col("total"))


def fit_distribution(counts: DataFrame, mode: int = 100, max_tables: int = 350, seed=42) -> DataFrame:
    """(schema_file, num_tables, action): KEEP, SKIP or OVER_MAX for every schema."""
    return sampling.quota_sample(counts, "schema_file", fit_targets(counts, mode, max_tables), seed)


def fit_report(decided: DataFrame, targets: DataFrame) -> DataFrame:
    """(num_tables, observed, target, kept, skipped) over all table counts that have rows or a target."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return action_histogram(decided).join(targets, "num_tables", "full").select(
        "num_tables", zero("observed"), zero("target"), zero("kept"), zero("skipped"), zero("over_max")
    )


def apply_decisions(schemas: DataFrame, decided: DataFrame) -> DataFrame:
    """The kept schemas with their texts."""
    return schemas.join(decided.where("action = 'KEEP'").select("schema_file"), "schema_file", "left_semi")


def foreign_key_profile(schemas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flags per schema, and the one-row summary."""
    flags = foreign_key_flags(schemas)
    return flags, foreign_key_share(flags)


def stripped_schemas(schemas: DataFrame, prefixes: DataFrame, exact: bool = False) -> DataFrame:
    """(schema_file, schema_sql, changed): marked schemas without their foreign keys."""
    marked = with_marked_prefix(schemas, prefixes, "schema_file", exact)
    new = D.strip_foreign_keys("schema_sql")
    return marked.select("schema_file", new.alias("schema_sql"), (new != F.col("schema_sql")).alias("changed"))


