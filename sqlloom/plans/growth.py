"""Schema growth: rounds of model calls that add tables until each schema reaches its target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.functions import prompts
from sqlloom.functions.responses import create_table_span, ddl_from_response
from sqlloom.functions.text import computed, rstrip, strip
from sqlloom.operators import sampling
from sqlloom.operators.gates import additions_to_names, index_names
from sqlloom.operators.inference import answered
from sqlloom.plans.schemas import GROWTH_RAMP
from sqlloom.session import Steps, opened_run
from sqlloom.sources.sinks import quarantine_text, write_growth_steps

NO_SQL = "the response holds no SQL"
NO_GAIN = "no new table could be added"


def start_states(schemas: DataFrame, mode: int, max_tables: int, seed) -> DataFrame:
    """The log's first round: text, names, table count and drawn target of every schema; those at their target are done."""
    spark = schemas.sparkSession
    density = sampling.table_count_density(spark, mode, max_tables, GROWTH_RAMP)
    bounds = sampling.cumulative(density, "num_tables", "density").withColumnRenamed("num_tables", "target")
    counted = schemas.select(
        "schema_file", strip("schema_sql").alias("added"), D.table_count("schema_sql").alias("num_tables")
    )
    drawn = computed(
        sampling.draw_weighted(counted, bounds, "target", seed, "schema_file"),
        names=F.transform(D.table_names("added"), F.lower), indexes=index_names("added"),
    )
    return drawn.select(
        F.lit(0).alias("round_no"), "schema_file", "added", "names", "indexes", "num_tables", F.col("target").cast("int").alias("target"),
        F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("last_error"),
        F.lit("").alias("rejected"),
        F.when(F.col("num_tables") >= F.col("target"), "done").otherwise("open").alias("status"),
    )


def _text(parts: Column) -> Column:
    """A schema's text from its first text and the statements added to it, in order."""
    return F.concat(F.array_join(parts, "\n\n"), F.when(F.size(parts) > 1, F.lit("\n")).otherwise(F.lit("")))


def versions(log: DataFrame) -> DataFrame:
    """The log's rows with ``schema_sql``, the whole text of a schema after each round, instead of what was added."""
    so_far = Window.partitionBy("schema_file").orderBy("round_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = F.collect_list(F.when((F.col("round_no") == 0) | (F.col("added") != ""), F.col("added"))).over(so_far)
    have = [c for c in log.columns if c not in ("added", "names", "indexes")]
    return log.select(*have, _text(parts).alias("schema_sql"))


def texts_of(log: DataFrame, keys: DataFrame) -> DataFrame:
    """(schema_file, schema_sql): the last text of the schemas in ``keys``."""
    own = log.where("round_no = 0 or added <> ''").join(keys.select("schema_file"), "schema_file", "left_semi")
    parts = F.array_sort(F.collect_list(F.struct("round_no", "added")))
    return own.groupBy("schema_file").agg(parts.alias("_parts")).select("schema_file", _text(F.col("_parts.added")).alias("schema_sql"))


def names_of(log: DataFrame, keys: DataFrame) -> DataFrame:
    """(schema_file, names, indexes): all tables and indexes of the schemas in ``keys``."""
    own = log.where("round_no = 0 or added <> ''").join(keys.select("schema_file"), "schema_file", "left_semi")
    return own.groupBy("schema_file").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("names", "indexes")])


def prompts_for(states: DataFrame, texts: DataFrame, seed, round_no: int) -> DataFrame:
    """(schema_file, prompt) of open states: an extension, or a repair after a failure."""
    n_new = sampling.growth_step("num_tables", "target", seed, "schema_file", F.lit(round_no))
    prompt = F.when(F.col("attempt") == 1, prompts.growth_prompt("schema_sql", n_new)).otherwise(
        prompts.repair_prompt("schema_sql", n_new, "last_error")
    )
    return states.join(texts, "schema_file").select("schema_file", prompt.alias("prompt"))


def next_states(answers: DataFrame, retries: int, gate=None) -> DataFrame:
    """The log's next round, from open states with a response and names; a round without a new table is a failed attempt.

    So a schema either gains a table or uses up an attempt in every round, and the rounds end by themselves.  Only what
    is added is parsed.  A caller's ``gate`` finds the text in ``schema_sql``.
    """
    read = computed(answers, ddl=F.coalesce(ddl_from_response("response"), F.lit("")))
    if gate:
        merged = gate(computed(read, base=rstrip("schema_sql")), "base", "ddl")
    else:
        merged = additions_to_names(read, "names", "indexes", "ddl")
    refused = [F.col("old_error")] if "old_error" in merged.columns else []
    failure = F.coalesce("error", *refused, F.when(F.col("ddl") == "", NO_SQL), F.lit(NO_GAIN))
    merged = computed(merged, _added=F.when(F.col("n_new") > 0, strip("kept")).otherwise(F.lit("")))
    merged = computed(merged, _more=D.table_count("_added"), _names=F.transform(D.table_names("_added"), F.lower), _indexes=index_names("_added"))
    gained = F.col("_more") > 0
    tables = F.col("num_tables") + F.col("_more")
    nothing = F.array().cast("array<string>")
    return merged.select(
        (F.col("round_no") + 1).alias("round_no"), "schema_file",
        *[F.when(gained, F.col(f"_{c}")).otherwise(other).alias(c) for c, other in (("added", F.lit("")), ("names", nothing), ("indexes", nothing))],
        tables.alias("num_tables"), "target",
        F.when(gained, 1).otherwise(F.col("attempt") + 1).alias("attempt"),
        F.when(~gained, failure).alias("last_error"),
        F.when(gained, F.lit("")).otherwise(F.coalesce(create_table_span("ddl"), "ddl")).alias("rejected"),
        F.when(gained & (tables >= F.col("target")), "done")
        .when(gained, "open")
        .when(F.col("attempt") >= retries, "failed")
        .otherwise("open").alias("status"),
    )


def growth_log(
    schemas: DataFrame, make_model, mode: int = 100, max_tables: int = 350, retries: int = 3,
    batch_size: int = 64, seed=42, options: dict | None = None, partitions: int | None = None,
    folder: str | None = None, slices: int = 1, gate=None, steps_path: str | None = None,
) -> DataFrame:
    """What every round did to every open schema: added text and names, table count, target, status.

    A round writes what it adds, not the texts so far; prompts and names of open schemas are put together from
    the log by an ordered aggregation.  Answers are committed to ``folder``, and so are the rounds; given
    the folder of a broken run, the job goes on behind its last round and asks for what is missing there.  ``gate`` adds
    (kept, n_new), and old_error if it wants to, to states with a base text and new statements; without one, tables
    must be new by name.  With ``steps_path`` the log is also written there, in files by round.
    """
    spark = schemas.sparkSession
    parameters = {"job": "growth", "mode": mode, "max_tables": max_tables, "seed": seed, "options": options or {}, "templates": prompts.templates_digest()}
    folder = opened_run(spark, "growth", folder, parameters)
    steps = Steps(spark, folder, schemas, retries=retries, gate=getattr(gate, "__qualname__", None))
    states = steps.table("0", lambda: start_states(schemas, mode, max_tables, seed))
    log, names = states, ["0"]
    while not states.where("status = 'open'").isEmpty():
        n, now, so_far = len(names), states.where("status = 'open'"), log

        def grown():
            texts = texts_of(so_far, now)
            answers = answered(
                prompts_for(now, texts, seed, n), make_model, ["schema_file"], f"{folder}/answers", batch_size, options, partitions, slices
            ).select("schema_file", "response", "error")
            known = texts if gate else names_of(so_far, now)
            return next_states(now.drop("added", "names", "indexes").join(answers, "schema_file").join(known, "schema_file"), retries, gate)

        states = steps.table(str(n), grown)
        names.append(str(n))
        # One scan, however many rounds.
        log = spark.read.schema(states.schema).parquet(*[f"{steps.folder}/{k}" for k in names])
    if steps_path:
        write_growth_steps(log, steps_path)
    return log


def grow_schemas(schemas: DataFrame, make_model, *args, **options) -> DataFrame:
    """All versions of every schema, from :func:`growth_log`: (round_no, schema_file, schema_sql, num_tables, target, attempt, status, last_error, rejected)."""
    return versions(growth_log(schemas, make_model, *args, **options)).select(
        "round_no", "schema_file", "schema_sql", "num_tables", "target", "attempt", "status", "last_error", "rejected"
    )


def final_schemas(versions: DataFrame) -> DataFrame:
    """The last version of every schema: the one that is done or failed, so no texts are compared."""
    return versions.where("status <> 'open'")


def quarantined_schemas(versions: DataFrame) -> DataFrame:
    """(schema_file, num_tables, text): rejected DDL of failed schemas with the error in front."""
    return final_schemas(versions).where("status = 'failed'").select(
        "schema_file", "num_tables", quarantine_text("rejected", "last_error").alias("text")
    )
