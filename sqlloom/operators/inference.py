"""Model calls as one Arrow-batched pass over a DataFrame of prompts.

The library serves no model.  The user gives ``make_model``: a function without
arguments that is called once per task and returns ``model(prompts, options)``, which
maps a list of prompts to a list of answers (texts, or lists of texts of which the
first counts).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlloom.session import committed_folders

# Tasks per core for model calls, enough to even out; and prompts per task, so that a lost task loses little.
TASKS_PER_CORE = 2
PROMPTS_PER_TASK = 2_000

Model = Callable[[list[str], dict], Sequence]


def infer(
    df: DataFrame,
    make_model: Callable[[], Model],
    prompt: str = "prompt",
    batch_size: int = 32,
    options: dict | None = None,
    partitions: int | None = None,
    key: str | None = None,
    told: Sequence[str] = (),
) -> DataFrame:
    """Add (response, error).

    A failing call costs its batch one attempt: the rows come back with a null response
    and the error text.  With a ``key`` the prompts are first spread over ``partitions``
    tasks by that key, which is repeatable when a task is run again; the number is fixed
    because prompts are short and answers are not, so sizes say nothing about the work.
    With ``told`` the model also finds these columns' values, a list for each, under ``options["rows"]``.
    Write the result before reading it twice, or the model is called twice.
    """
    if key:
        cores = df.sparkSession.sparkContext.defaultParallelism
        df = df.repartition(partitions or TASKS_PER_CORE * cores, key)
    options = dict(options or {})
    schema = T.StructType(
        [f for f in df.schema.fields if f.name != prompt]
        + [T.StructField("response", T.StringType()), T.StructField("error", T.StringType())]
    )
    kept = [f.name for f in schema.fields[:-2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            prompts = batch.column(prompt).to_pylist()
            values = {c: batch.column(c).to_pylist() for c in told}
            answers, errors = [], []
            for start in range(0, len(prompts), batch_size):
                part = prompts[start : start + batch_size]
                rows = {"rows": {c: v[start : start + batch_size] for c, v in values.items()}} if told else {}
                try:
                    texts = [_one_text(a) for a in model(part, {**options, **rows})]
                    if len(texts) != len(part):
                        raise ValueError(f"{len(texts)} answers to {len(part)} prompts")
                    error = None
                except Exception as e:  # noqa: BLE001 - any failure of the user's model
                    texts, error = [None] * len(part), f"{type(e).__name__}: {e}"
                answers += texts
                errors += [error] * len(part)
            columns = [batch.column(c) for c in kept] + [pa.array(answers, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "response", "error"])

    return df.mapInArrow(run, schema)


def _one_text(answer) -> str:
    if isinstance(answer, (list, tuple)):
        return answer[0] if answer else ""
    return "" if answer is None else answer


PROMPT_HASH = "prompt_hash"


def stored_answers(spark: SparkSession, folder: str) -> DataFrame | None:
    """All answers that were committed to ``folder``, or None."""
    folders = committed_folders(spark, folder)
    return spark.read.parquet(*folders) if folders else None


def answered(
    asked: DataFrame, make_model: Callable[[], Model], keys: Sequence[str], folder: str, batch_size: int = 32,
    options: dict | None = None, partitions: int | None = None, slices: int = 1, told: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``asked`` without ``prompt``, with (prompt_hash, response, error).

    Answers are committed to ``folder`` in hash slices, one after the other, and found again by
    ``keys`` and the hash of the prompt.  A run that gets the folder of a broken one asks for
    what is missing only, whether the input has grown, a prompt has changed or some slices were lost.
    Give a written table: it is read once for each slice.
    """
    spark, same = asked.sparkSession, [*keys, PROMPT_HASH]
    marked = asked.withColumn(PROMPT_HASH, F.sha2("prompt", 256))
    before = stored_answers(spark, folder)
    pending = marked if before is None else marked.join(before.select(same), same, "left_anti")
    for number in range(slices):
        part = pending if slices == 1 else pending.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) == number)
        tasks = partitions or max(
            TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-part.count() // PROMPTS_PER_TASK)
        )
        spread = part.repartition(tasks, *keys)
        infer(spread, make_model, batch_size=batch_size, options=options, told=told).write.parquet(f"{folder}/batch-{uuid.uuid4().hex}")
    everything = stored_answers(spark, folder)
    return everything if before is None else everything.join(marked.select(same), same, "left_semi")
