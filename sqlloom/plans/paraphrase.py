"""Paraphrases: ask for other wordings of kept questions and append them as new records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions import prompts
from sqlloom.functions.responses import paraphrase_lines, with_new_wordings, without_self_reference
from sqlloom.functions.text import computed, token_count
from sqlloom.operators.inference import answered
from sqlloom.session import Steps, opened_run


def paraphrase_prompts(records: DataFrame, count: int, key: str) -> DataFrame:
    """(key, prompt) of records with a question and a query; the other records get none but stay."""
    asked = records.where((F.coalesce("question", F.lit("")) != "") & (F.coalesce("query", F.lit("")) != ""))
    return asked.select(key, prompts.paraphrase_prompt("question", "query", count).alias("prompt"))


def usable_lines(responses: DataFrame, key: str) -> DataFrame:
    """(key, attempt, lines) of every response, without lines that mention paraphrasing."""
    told = computed(responses.select(key, "attempt", "raw"), lines=without_self_reference(paraphrase_lines("raw")))
    return told.drop("raw")


def first_usable(parsed: DataFrame, key: str) -> DataFrame:
    """(key, lines) of the earliest response with any line left."""
    return parsed.where(F.size("lines") > 0).groupBy(key).agg(F.min_by("lines", "attempt").alias("lines"))


def paraphrased(records: DataFrame, lines: DataFrame, key: str, n: int, model_name: str) -> DataFrame:
    """New records: up to n new wordings per record, token counts refreshed, origin noted."""
    def count(name: str):
        have = "token_count" in records.columns
        return F.coalesce(F.col(f"token_count.{name}"), token_count(name)) if have else token_count(name)

    own = token_count("_new")
    query, schema = count("query"), count("schema")
    counts = F.struct(
        own.alias("question"), query.alias("query"), schema.alias("schema"), (own + query + schema).alias("total")
    )
    return (
        with_new_wordings(records.join(lines, key), "lines", "question", n, "_new")
        .withColumn("_new", F.explode("_new"))
        .drop("lines")
        .withColumns(
            {
                "token_count": counts, "augmentation_type": F.lit(fv.PARAPHRASE_TYPE),
                "augmentation_of": F.col("question"), "paraphrase_model": F.lit(model_name),
                "paraphrased_at": F.date_format(F.current_timestamp(), fv.TIME_FORMAT),
            }
        )
        .withColumn("question", F.col("_new")).drop("_new")
    )


def with_originals(records: DataFrame, new: DataFrame, skip_original: bool = False) -> DataFrame:
    """Originals and paraphrases; columns that only the paraphrases have are null in originals."""
    return new if skip_original else records.unionByName(new, allowMissingColumns=True)


def make_paraphrases(
    records: DataFrame, key: str, make_model, model_name: str, n: int = 2, retries: int = 3, batch_size: int = 12,
    skip_original: bool = False, options: dict | None = None, partitions: int | None = None,
    folder: str | None = None, slices: int = 1,
) -> DataFrame:
    """Records with their paraphrases; rounds, folder and slices as in :func:`make_questions`."""
    spark = records.sparkSession
    parameters = {"job": "paraphrase", "model": model_name, "n": n, "options": options or {}, "templates": prompts.templates_digest()}
    folder = opened_run(spark, "paraphrase", folder, parameters)
    steps = Steps(spark, folder, records.select(key, "question", "query"), retries=retries)
    base = steps.table("prompts", lambda: paraphrase_prompts(records, n, key))
    asked, rounds = base, []
    for attempt in range(retries + 1):

        def usable():
            got = answered(asked, make_model, [key], f"{folder}/answers", batch_size, options, partitions, slices)
            return usable_lines(got.select(key, F.lit(attempt).alias("attempt"), F.col("response").alias("raw")), key)

        rounds.append(steps.table(f"lines/{attempt}", usable))
        still = rounds[-1].where(F.size("lines") <= 0).select(key)
        if attempt == retries or still.isEmpty():
            break
        asked = steps.table(
            f"asked/{attempt + 1}",
            lambda: base.join(still, key, "left_semi").withColumn("prompt", prompts.paraphrase_retry("prompt", attempt + 1)),
        )
    lines = first_usable(reduce(DataFrame.union, rounds), key)
    return with_originals(records, paraphrased(records, lines, key, n, model_name), skip_original)
