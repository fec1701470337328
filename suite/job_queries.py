"""Whole jobs and Python-worker operators, run with small deterministic stand-ins for a model.

The stand-ins are functions of the prompt alone, so DuckDB can state the expected result.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sqlloom.operators import candidates as C
from sqlloom.operators import examples as X
from sqlloom.operators.gates import additions_without_conflicts, first_questions
from sqlloom.operators.inference import infer
from sqlloom.plans import enrich as E
from sqlloom.plans import growth as G
from sqlloom.plans import paraphrase as PP
from sqlloom.plans import questions as Q
from sqlloom.plans import synthesis as S
from sqlloom.session import run_folder, written
from sqlloom.sources.sinks import write_jsonl
from sqlloom.streaming.enrich_stream import stream_enrich
from suite.registry import query
from suite.rows import CLASSIFIED, JOINS, TOKENS
from suite.sampling_queries import COUNTS, PMF, UNIFORM, VALID, density_sql
from suite.schema_queries import assembled

GROWTH_MODE, GROWTH_MAX = 40, 150


def _echo():
    def model(prompts, options):
        if any("FOREIGN KEY" in p for p in prompts):
            raise ValueError("refused")
        return [[options["mark"] + p.upper()] for p in prompts]

    return model


@query("""SELECT table_no, CASE WHEN ddl NOT LIKE '%FOREIGN KEY%' THEN '> ' || upper(ddl) END AS response,
  CASE WHEN ddl LIKE '%FOREIGN KEY%' THEN 'ValueError: refused' END AS error FROM fx_tables""")
def infer_stub(fx):
    asked = fx.fx_tables.select("table_no", F.col("ddl").alias("prompt"))
    return infer(asked, _echo, batch_size=1, options={"mark": "> "})


@query("""SELECT table_no, concat_ws(chr(10) || chr(10), CASE WHEN table_no % 5 <> 0 THEN 'CREATE TABLE n1 (a INT);' END,
  CASE WHEN table_no % 7 <> 0 THEN 'CREATE INDEX i1 ON n1 (a);' END) AS kept,
  CASE WHEN table_no % 5 = 0 THEN 0 ELSE 1 END::INT AS n_new FROM fx_tables""")
def ddl_additions(fx):
    old = F.concat(
        F.when(F.col("table_no") % 5 == 0, F.lit("create table main.[N1] (x INT); ")).otherwise(F.lit("/* CREATE TABLE n1 (x INT); */ ")),
        F.when(F.col("table_no") % 7 == 0, F.lit("CREATE INDEX I1 ON t0 (id); ")).otherwise(F.lit("")), F.col("ddl"),
    )
    new = F.concat(F.col("ddl"), F.lit(" CREATE TABLE n1 (a INT); CREATE INDEX i1 ON n1 (a); CREATE TABLE N1 (b INT);"))
    states = fx.fx_tables.select("table_no", old.alias("old"), new.alias("new"))
    return additions_without_conflicts(states, "old", "new").select("table_no", "kept", "n_new")


def _grower():
    def one(prompt):
        n = int(re.search(r"exactly (\d+) new tables", prompt).group(1))
        have = len(re.findall(r"CREATE TABLE \w+ \(", prompt))
        made = [f"CREATE TABLE grown_{have}_{i} (id INTEGER PRIMARY KEY);" for i in range(n)]
        return "```sqlite\n" + "\n".join(made) + "\n```"

    return lambda prompts, options: [one(p) for p in prompts]


@query(COUNTS + "," + density_sql(GROWTH_MODE, GROWTH_MAX, 0.5) + f""",
bounds AS (SELECT num_tables, round(sum(density) OVER (ORDER BY num_tables), 9) AS high FROM density),
edges AS (SELECT num_tables AS target, coalesce(lag(high) OVER (ORDER BY num_tables), 0.0) AS low,
  CASE WHEN num_tables = {GROWTH_MAX} THEN 1.0 ELSE high END AS high FROM bounds),
draws AS (SELECT schema_file, num_tables, {UNIFORM.format("'42:' || schema_file")} AS u FROM counts)
SELECT schema_file, target, greatest(target, num_tables) AS num_tables, 'done' AS status FROM draws JOIN edges ON u >= low AND u < high""")
def grow_schemas(fx):
    schemas = assembled(fx).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "schema_sql")
    versions = G.grow_schemas(schemas, _grower, GROWTH_MODE, GROWTH_MAX, seed=42)
    return G.final_schemas(versions).select("schema_file", "target", "num_tables", "status")


def _asker():
    def one(prompt):
        joins = int(re.search(r"exactly (\d+) JOIN\(s\), unless", prompt).group(1))
        if joins % 2 and "could not be read" not in prompt:
            return "```plaintext\n<First Question>\n```"
        return f"```plaintext\n1. Needs {joins} joins\n2. Also needs {joins}\n3. One too many\n```"

    return lambda prompts, options: [one(p) for p in prompts]


@query(VALID + f""", {PMF},
files AS (SELECT DISTINCT 'schema_' || schema_id || '.sql' AS schema_file FROM fx_tables),
wants AS (SELECT schema_file, coalesce((SELECT min(j) FROM cdf WHERE {UNIFORM.format("'42:' || schema_file")} <= c), 10)::INT AS j FROM files)
SELECT schema_file, l.line_no, CASE l.line_no WHEN 0 THEN 'Needs ' || j || ' joins' ELSE 'Also needs ' || j END AS question,
  j AS required_num_joins, used_joins AS examples_num_joins
FROM wants JOIN nearest ON target_joins = j, (SELECT unnest([0, 1])::INT AS line_no) l""")
def make_questions(fx):
    schemas = assembled(fx).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "schema_sql")
    made = Q.make_questions(schemas, X.valid_examples(fx.fx_examples), _asker, "stub", per_schema=2, retries=1)
    return made.select("schema_file", "line_no", "question", "required_num_joins", "examples_num_joins")


def _sql_writer():
    def one(prompt, style):
        if prompt.startswith("You compare"):
            found = re.findall(r"(```sql\n.*?\n```)", prompt, re.S)
            return found[-1].replace("SELECT", "select ") if "LIMIT 1" in found[-1] else found[0]
        name = re.search(r"Schema:\n([^\n(]+)\(", prompt)
        tail = " LIMIT 1" if style % 2 else ""
        return f"```sql\nSELECT id FROM {name.group(1)}{tail}\n```" if name else "I cannot tell"

    def model(prompts, options):
        # Both candidates of an item have the same prompt; their round makes them differ.
        rounds = options["rows"]["round_no"] if "rows" in options else [0] * len(prompts)
        return [one(p, r) for p, r in zip(prompts, rounds)]

    return model


@query("""
, items AS (SELECT min(row_idx) AS item_id, schema_file, question FROM fx_questions GROUP BY schema_file, question),
firsts AS (SELECT 'schema_' || schema_id || '.sql' AS schema_file, min(table_name) AS t FROM fx_tables GROUP BY schema_id)
SELECT i.item_id, trim(i.question) AS prompt, CASE WHEN t IS NULL THEN 'SELECT 1;' ELSE 'SELECT id FROM ' || t || ' LIMIT 1;' END AS sql_statement,
  'SELECT' AS cmd_type FROM items i LEFT JOIN firsts f ON f.schema_file = i.schema_file""")
def make_sql(fx):
    schemas = assembled(fx).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "schema_sql")
    items = first_questions(fx.fx_questions).withColumnRenamed("row_idx", "item_id")
    made = S.make_sql(items, schemas, _sql_writer, candidates_per_item=2, tell_rounds=True)
    return made.select("item_id", "prompt", "sql_statement", "cmd_type")


def _reworder():
    def one(prompt):
        question = prompt.split("Question:\n", 1)[1].split("\n", 1)[0]
        if "customer 1" in question and "could not be read" not in prompt:
            return "Paraphrase 1\nParaphrase 2"
        return f"```plaintext\n1) {question.upper()}\n2) Tell me: {question}\n3) Say: {question}\n4) Extra\n```"

    return lambda prompts, options: [one(p) for p in prompts]


@query(CLASSIFIED + """, done AS (SELECT rec_id, question FROM classified WHERE reason IS NULL AND length(question) BETWEEN 20 AND 1024)
SELECT rec_id, question, NULL::VARCHAR AS augmentation_of FROM done
UNION ALL SELECT rec_id, 'Tell me: ' || question, question FROM done
UNION ALL SELECT rec_id, 'Say: ' || question, question FROM done""")
def make_paraphrases(fx):
    # Enriched records are a stored dataset by the time they are paraphrased.
    records = written(E.enrich(fx.fx_triplets), f"{run_folder(fx.spark, 'enriched')}/records")
    made = PP.make_paraphrases(records, "rec_id", _reworder, "stub", n=2, retries=1)
    return made.select("rec_id", "question", "augmentation_of")


@query(CLASSIFIED + f"""SELECT question || ' #' || rec_id AS question, query, schema, {JOINS.format("query")}::BIGINT AS num_joins,
  {TOKENS.format("query")}::BIGINT AS query_tokens, (rec_id % 3 * 2)::BIGINT AS number_of_columns, '{{"rec_id":' || rec_id || '}}' AS rest
FROM classified WHERE reason IS NULL AND length(question || ' #' || rec_id) BETWEEN 20 AND 1024""")
def stream_enriched(fx):
    folder = run_folder(fx.spark, "stream")
    named = fx.fx_triplets.withColumn("prompt", F.concat("prompt", F.lit(" #"), "rec_id"))
    write_jsonl(named.select("prompt", "sql_statement", "schema", "rec_id"), f"{folder}/in")
    stream_enrich(fx.spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    out = fx.spark.read.parquet(f"{folder}/out")
    numbers = [F.col(n).cast("bigint").alias(n) for n in ("num_joins", "number_of_columns")]
    return out.select("question", "query", "schema", *numbers, F.col("token_count.query").cast("bigint").alias("query_tokens"), "rest")
