"""SQL candidates of a work item: extraction, gates, dedup, fallback and the vote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.responses import with_sql
from sqlloom.functions.sqltext import is_single_statement, loose_form, normalize_sql, with_semicolon
from sqlloom.functions.text import computed

NO_SQL = "no SQL in the response"
NOT_SINGLE = "not a single statement"
NOT_EXECUTABLE = "not executable against the schema"
DUPLICATE = "duplicate of an earlier candidate"


def extracted_candidates(responses: DataFrame) -> DataFrame:
    """(item_id, round_no, sql, norm, reason) for every response (item_id, round_no, raw)."""
    read = with_sql(responses.select("item_id", "round_no", "raw"), "raw", "_sql")
    closed = computed(read, sql=with_semicolon("_sql"))
    gated = computed(
        closed,
        norm=normalize_sql("sql"),
        reason=F.when(F.col("sql").isNull(), NO_SQL).when(~is_single_statement("sql"), NOT_SINGLE),
    )
    return gated.select("item_id", "round_no", "sql", "norm", "reason")


def distinct_candidates(gated: DataFrame) -> DataFrame:
    """The earliest candidate per item and normal form among those that passed every gate."""
    return (
        gated.where("reason is null")
        .groupBy("item_id", "norm")
        .agg(F.min("round_no").alias("round_no"), F.min_by("sql", "round_no").alias("sql"))
        .select("item_id", "round_no", "sql", "norm")
    )


def quarantined_candidates(gated: DataFrame) -> DataFrame:
    """(item_id, round_no, sql, reason) of every candidate that is not used."""
    first = distinct_candidates(gated).select("item_id", "norm", "round_no", F.lit(True).alias("_first"))
    flagged = gated.join(first, ["item_id", "norm", "round_no"], "left")
    reason = F.coalesce("reason", F.when(F.col("_first").isNull(), DUPLICATE))
    return flagged.withColumn("reason", reason).where("reason is not null").select(
        "item_id", "round_no", "sql", "reason"
    )


def with_fallback(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates, plus one trivial statement for every item that has none."""
    missing = items.select("item_id").join(candidates.select("item_id").distinct(), "item_id", "left_anti")
    fallback = missing.select(
        "item_id", F.lit(0).cast(candidates.schema["round_no"].dataType).alias("round_no"),
        F.lit(fv.FALLBACK_SQL).alias("sql"), normalize_sql(F.lit(fv.FALLBACK_SQL)).alias("norm"),
    )
    return candidates.select("item_id", "round_no", "sql", "norm").unionByName(fallback)


def voted(items: DataFrame, candidates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(item_id, winner): the candidate the judge chose.

    ``verdicts`` is (item_id, raw).  The choice is matched by normal form (the last
    candidate with that form), else without closing semicolons and blanks (the first
    such candidate), else the first candidate wins; items without any get the fallback.

    The verdict joins its item's candidates once, both forms are compared in the row, and the
    winner is an aggregate on the same key: one shuffle, and an item with very many
    candidates combines before it is split.
    """
    choice = with_sql(verdicts.select("item_id", "raw"), "raw", "_choice")
    choice = computed(choice.drop("raw"), _norm=normalize_sql("_choice"), _loose=loose_form("_choice")).select("item_id", "_norm", "_loose")
    matched = candidates.select("item_id", "round_no", "sql", "norm").join(choice, "item_id", "left")
    winners = matched.groupBy("item_id").agg(
        F.coalesce(
            F.max_by("sql", F.when(F.col("norm") == F.col("_norm"), F.col("round_no"))),
            F.min_by("sql", F.when(loose_form("sql") == F.col("_loose"), F.col("round_no"))),
            F.min_by("sql", "round_no"),
        ).alias("_won")
    )
    return items.select("item_id").join(winners, "item_id", "left").select(
        "item_id", with_semicolon(F.coalesce("_won", F.lit(fv.FALLBACK_SQL))).alias("winner")
    )
