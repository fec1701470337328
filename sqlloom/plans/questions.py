"""Question writing: draw a join count, pick samples, ask, parse, retry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions import prompts
from sqlloom.operators import sampling
from sqlloom.operators.attempts import first_valid, numbered_lines, parsed_questions
from sqlloom.operators.examples import draw_examples
from sqlloom.operators.inference import answered
from sqlloom.session import Steps, opened_run

SPECIFIC_SHARE = 0.3
SHOWN_EXAMPLES = 4


def question_requests(schemas: DataFrame, examples: DataFrame, seed, key: str = "schema_file") -> DataFrame:
    """(key, required_num_joins, examples_num_joins, examples, specific) without the schema texts."""
    drawn = schemas.select(
        key,
        sampling.draw_joins(seed, key).alias("required_num_joins"),
        sampling.draw_flag(SPECIFIC_SHARE, seed, key, F.lit("tone")).alias("specific"),
    )
    return draw_examples(drawn, key, "required_num_joins", examples, SHOWN_EXAMPLES, seed).withColumnRenamed(
        "examples_joins", "examples_num_joins"
    )


def question_prompts(schemas: DataFrame, requests: DataFrame, count: int) -> DataFrame:
    """(schema_file, prompt): schema texts join their requests by key only here."""
    return schemas.join(requests, "schema_file").select(
        "schema_file",
        prompts.question_prompt(
            F.col("schema_sql"), F.col("examples"), "examples_num_joins", "required_num_joins", "specific", count
        ).alias("prompt"),
    )


def make_questions(
    schemas: DataFrame, examples: DataFrame, make_model, model_name: str, per_schema: int = 10, retries: int = 3,
    batch_size: int = 32, seed=42, options: dict | None = None, partitions: int | None = None,
    folder: str | None = None, slices: int = 1,
) -> DataFrame:
    """Question records.  At most ``retries`` + 1 rounds; a round asks for the open schemas only.

    Answers are committed to ``folder`` in slices, and finished steps beside them; given the folder of an earlier run, the
    model is asked for what is missing there, and with the same input no finished step is done again.
    """
    spark = schemas.sparkSession
    parameters = {"job": "questions", "model": model_name, "seed": seed, "options": options or {}, "templates": prompts.templates_digest()}
    folder = opened_run(spark, "questions", folder, parameters)
    steps = Steps(spark, folder, schemas, examples, per_schema=per_schema, retries=retries)
    requests = steps.table("requests", lambda: question_requests(schemas, examples, seed))
    base = steps.table("prompts", lambda: question_prompts(schemas, requests, per_schema))
    asked, rounds = base, []
    for attempt in range(retries + 1):

        def stamped():
            got = answered(asked, make_model, ["schema_file"], f"{folder}/answers", batch_size, options, partitions, slices)
            return got.select(
                F.col("schema_file").alias("item_id"), F.lit(attempt).alias("attempt"),
                F.col("response").alias("raw"), "error", F.current_timestamp().alias("timestamp"),
            )

        rounds.append(steps.table(f"answers/{attempt}", stamped))
        parsed = parsed_questions(rounds[-1])
        still = parsed.where("not valid").select(F.col("item_id").alias("schema_file"))
        if attempt == retries or still.isEmpty():
            break
        # Only the keys of what is open meet the stored prompts.
        open_keys = steps.table(f"open/{attempt}", lambda: still)
        asked = steps.table(
            f"asked/{attempt + 1}",
            lambda: base.join(open_keys, "schema_file", "left_semi").withColumn("prompt", prompts.question_retry("prompt", attempt + 1)),
        )
    answers = reduce(DataFrame.union, rounds)
    lines = numbered_lines(first_valid(parsed_questions(answers), retries), per_schema)
    stamps = answers.select("item_id", "attempt", "timestamp")
    return (
        lines.join(stamps, ["item_id", "attempt"])
        .withColumnRenamed("item_id", "schema_file")
        .join(requests.select("schema_file", "required_num_joins", "examples_num_joins"), "schema_file")
        .select(
            "schema_file", "line_no", "question", "required_num_joins", "examples_num_joins",
            F.lit(fv.QUESTION_SOURCE).alias("source"), F.lit(model_name).alias("generation_model"), "timestamp",
        )
    )


def with_schema_text(questions: DataFrame, schemas: DataFrame) -> DataFrame:
    """Attach schema texts by key, as the last step before writing."""
    return questions.join(schemas.select("schema_file", "schema_sql"), "schema_file")
