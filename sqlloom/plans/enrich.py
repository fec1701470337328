"""Enrichment: unify fields, clean and classify queries, count, keep good questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.functions import fixed_values as fv
from sqlloom.functions import sqltext as S
from sqlloom.functions.text import computed, token_count
from sqlloom.operators.gates import drop_reason, good_question_length, unify_fields
from sqlloom.operators.ranking import scattered
from sqlloom.sources.sinks import watched


def classified(records: DataFrame) -> DataFrame:
    """Unified records with a cleaned query and ``reason``: null for records worth keeping."""
    cleaned = computed(unify_fields(records), query=S.clean_flat_comments("query"))
    return cleaned.withColumn("reason", drop_reason("query"))


def with_counts(records: DataFrame, with_commands: bool = False) -> DataFrame:
    """Add token_count, num_joins, num_tables and number_of_columns, all in one projection."""
    tokens = {name: token_count(name) for name in ("question", "query", "schema")}
    counts = {
        "token_count": F.struct(
            *[c.alias(n) for n, c in tokens.items()],
            (tokens["question"] + tokens["query"] + tokens["schema"]).alias("total"),
        ),
        "num_joins": S.join_count("query"),
        "num_tables": D.table_count_with_temporary("schema"),
        "number_of_columns": D.column_count("schema"),
    }
    if with_commands:
        counts["commands"] = S.commands("query")
    return records.withColumns(counts)


def enrich(records: DataFrame, with_commands: bool = False) -> DataFrame:
    """Kept and annotated records.  Narrow: no shuffle."""
    kept = classified(records).where(F.col("reason").isNull() & good_question_length("question")).drop("reason")
    return with_counts(kept, with_commands)


QUESTION_LENGTH = "Question length"
REASONS = (fv.REASON_NO_SQL, fv.REASON_ONLY_COMMENTS, QUESTION_LENGTH)


def judged(records: DataFrame) -> DataFrame:
    """All records with ``reason``: null for those that stay, question length counted after the other reasons."""
    return classified(records).withColumn(
        "reason", F.coalesce("reason", F.when(~good_question_length("question"), QUESTION_LENGTH))
    )


def skip_counts(records: DataFrame) -> DataFrame:
    """(reason, n): rows dropped by reason."""
    return judged(records).select("reason").where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def write_enriched(records: DataFrame, path: str, key: str, seed, files: int) -> dict:
    """Enrich, shuffle by a seeded hash of ``key`` and write JSON lines: one shuffle in all.

    Returns the numbers of processed and written records and of those dropped, by reason.  They come from the pass
    that writes: dropped records travel as key and reason only, and are counted and left out in the tasks that write, where
    a task that is run again counts once.
    """
    rows = judged(records)
    done = with_counts(rows.drop("reason"))
    payload = F.when(F.col("reason").isNull(), F.struct(*[F.col(f"`{c}`") for c in done.columns])).alias("_record")
    dealt = scattered(with_counts(rows).select(F.col(key).alias("_key"), "reason", payload), "_key", seed, files)
    counts = {f"reason_{n}": F.count_if(F.col("reason") == r) for n, r in enumerate(REASONS)}
    out, seen = watched(dealt, written=F.count("_record"), **counts)
    out.where("_record is not null").select("_record.*").write.option("ignoreNullFields", False).json(path)
    found = seen.get
    return {"processed": found["rows"], "written": found["written"], "dropped": {r: found[f"reason_{n}"] for n, r in enumerate(REASONS)}}
