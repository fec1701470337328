"""Retry rounds: aligning answers with requests, first valid attempt, and what is still open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions.responses import has_template_text, question_lines
from sqlloom.functions.text import computed


def aligned(requests: DataFrame, responses: DataFrame, keys=("item_id", "attempt")) -> DataFrame:
    """Requests with their responses, matched by key instead of by position."""
    return requests.join(responses, list(keys))


def parsed_questions(responses: DataFrame) -> DataFrame:
    """(item_id, attempt, lines, valid): valid means lines, none of them a placeholder."""
    read = responses.select("item_id", "attempt", "raw")
    return computed(read, lines=question_lines("raw")).select(
        "item_id", "attempt", "lines", ((F.size("lines") > 0) & ~has_template_text("lines")).alias("valid")
    )


def first_valid(parsed: DataFrame, retries: int) -> DataFrame:
    """(item_id, attempt, lines) of the earliest valid attempt among the first one and its retries."""
    usable = parsed.where(F.col("valid") & (F.col("attempt") <= retries))
    return usable.groupBy("item_id").agg(
        F.min("attempt").alias("attempt"), F.min_by("lines", "attempt").alias("lines")
    )


def pending(items: DataFrame, accepted: DataFrame, key: str = "item_id") -> DataFrame:
    """Items without an accepted answer."""
    return items.join(accepted.select(key).distinct(), key, "left_anti")


def numbered_lines(accepted: DataFrame, n: int) -> DataFrame:
    """(item_id, attempt, line_no, question): the first n lines of every accepted answer."""
    return accepted.select("item_id", "attempt", F.posexplode(F.slice("lines", 1, n)).alias("line_no", "question"))
