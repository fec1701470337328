"""Reports on a corpus: questions and their repeats, table counts, empty schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.operators.profiles import empty_table_share, repeated_questions, table_histogram


def question_report(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(question) of every record, and (question, n) of those that occur more than once."""
    return records.select(F.coalesce("question", F.lit("")).alias("question")), repeated_questions(records)


def corpus_profile(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Percent of files without tables, and (num_tables, n) over all files; files are (tables array)."""
    counts = files.select(F.coalesce(F.size("tables"), F.lit(0)).alias("num_tables"))
    filled = counts.withColumn("num_tables", F.greatest("num_tables", F.lit(0)))
    return empty_table_share(files), table_histogram(filled)
