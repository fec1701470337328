"""SQL for questions: candidates, gates, a judge, one winner per question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import prompts
from sqlloom.functions.sqltext import statement_kind
from sqlloom.functions.text import flatten
from sqlloom.operators import candidates as C
from sqlloom.operators.catalog import catalog_from_ddl, compressed_schemas
from sqlloom.operators.inference import answered
from sqlloom.session import Steps, opened_run


def generation_prompts(items: DataFrame, compressed: DataFrame) -> DataFrame:
    """(item_id, prompt) for items (item_id, schema_file, question); a schema without tables compresses to nothing."""
    return items.join(compressed, "schema_file", "left").select(
        "item_id", prompts.sql_prompt("question", F.coalesce("compressed", F.lit(""))).alias("prompt")
    )


def vote_prompts(items: DataFrame, compressed: DataFrame, candidates: DataFrame) -> DataFrame:
    """(item_id, prompt): each item with all its candidates in order; they must fit into one prompt."""
    listed = candidates.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("round_no", "sql"))).alias("_listed")
    )
    return (
        items.join(compressed, "schema_file", "left").join(listed, "item_id")
        .select("item_id", prompts.judge_prompt(
            "question", F.coalesce("compressed", F.lit("")), F.col("_listed.sql")).alias("prompt"))
    )


def gated_candidates(extracted: DataFrame, items: DataFrame, schemas: DataFrame, check=None) -> DataFrame:
    """Extracted candidates; with a ``check``, ``reason`` also tells which ones don't run on their schema.

    ``check`` gets (schema_file, item_id, round_no, sql) and the schemas and returns the
    (item_id, round_no) of the candidates that fail.  The library brings no SQL engine for that.
    """
    if check is None:
        return extracted
    runnable = extracted.where("reason is null").join(items.select("item_id", "schema_file"), "item_id")
    failed = check(runnable.select("schema_file", "item_id", "round_no", "sql"), schemas).select(
        "item_id", "round_no", F.lit(C.NOT_EXECUTABLE).alias("_failed")
    )
    return extracted.join(failed, ["item_id", "round_no"], "left").withColumn("reason", F.coalesce("reason", "_failed")).drop("_failed")


def make_sql(
    items: DataFrame, schemas: DataFrame, make_model, candidates_per_item: int = 2, batch_size: int = 16,
    generate_options: dict | None = None, vote_options: dict | None = None, make_judge=None, partitions: int | None = None,
    folder: str | None = None, slices: int = 1, check=None, tell_rounds: bool = False,
) -> DataFrame:
    """Triplets (item_id, prompt, sql_statement, schema_file, cmd_type).

    All candidate rounds are one model pass over items times rounds; the judge is a
    second pass.  Answers are committed to ``folder`` in slices, and finished steps beside them; given the
    folder of an earlier run, the model is asked for what is missing there, and with the same input no finished step is done
    again.  With ``tell_rounds`` the generating model
    finds each prompt's round in ``options["rows"]["round_no"]``.
    """
    spark = items.sparkSession
    rounds = max(1, candidates_per_item)
    parameters = {"job": "sql", "generate": generate_options or {}, "vote": vote_options or {}, "templates": prompts.templates_digest()}
    folder = opened_run(spark, "sql", folder, parameters)
    steps = Steps(spark, folder, items, schemas, rounds=rounds, check=getattr(check, "__qualname__", None))
    compressed = steps.table(
        "compressed", lambda: compressed_schemas(catalog_from_ddl(schemas, "schema_file", "schema_sql"), "schema_file")
    )
    asked = steps.table("asked", lambda: generation_prompts(items, compressed).withColumn(
        "round_no", F.explode(F.array(*[F.lit(r) for r in range(rounds)]))
    ))

    def candidates():
        answers = answered(
            asked, make_model, ["item_id", "round_no"], f"{folder}/answers", batch_size, generate_options, partitions, slices,
            told=["round_no"] if tell_rounds else [],
        )
        return C.extracted_candidates(answers.select("item_id", "round_no", F.col("response").alias("raw")))

    extracted = steps.table("extracted", candidates)
    usable = steps.table("usable", lambda: C.with_fallback(items, C.distinct_candidates(gated_candidates(extracted, items, schemas, check))))
    judged = steps.table("judged", lambda: vote_prompts(items, compressed, usable))
    verdicts = steps.table("verdicts", lambda: answered(
        judged, make_judge or make_model, ["item_id"], f"{folder}/verdicts", batch_size, vote_options, partitions, slices
    ))
    winners = C.voted(items, usable, verdicts.select("item_id", F.col("response").alias("raw")))
    return items.join(winners, "item_id").select(
        "item_id", flatten("question").alias("prompt"), flatten("winner").alias("sql_statement"),
        "schema_file", statement_kind("winner").alias("cmd_type"),
    )


def with_flat_schema(triplets: DataFrame, schemas: DataFrame) -> DataFrame:
    """Attach the flattened schema text by key, as the last step before writing."""
    return triplets.join(schemas.select("schema_file", flatten("schema_sql").alias("schema")), "schema_file")
