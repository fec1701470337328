"""Queries on single rows: JSON lines, enrichment, SQL text functions, gates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlloom.functions import fixed_values as fv
from sqlloom.functions import sqltext as S
from sqlloom.functions.text import flatten, token_count
from sqlloom.operators.gates import flatten_fields, has_required
from sqlloom.operators.ranking import first_per_key, shuffled
from sqlloom.plans import enrich as E
from sqlloom.sources import jsonl
from suite.registry import query

KEY_RECORD = T.StructType([T.StructField("k", T.LongType())])

# The cleaned query and drop reason in DuckDB, shared by several checks below.
CLASSIFIED = rf"""
, cleaned AS (
  SELECT rec_id, prompt AS question, schema,
    trim(regexp_replace(sql_statement, '--[^;]*?({"|".join(rf"\b{w}\b" for w in fv.COMMENT_STOP_WORDS)}|;|$)', '\1', 'gi')) AS query
  FROM fx_triplets),
classified AS (
  SELECT *, CASE WHEN upper(query) = 'SELECT 1;' THEN 'Error generating SQL'
    WHEN query IN ('', ';') OR length(query) < 20 THEN 'Only comments present' END AS reason
  FROM cleaned)
"""
TOKENS = r"len(regexp_extract_all({0}, '[A-Za-z0-9_%/*.+<>!=\\-]+'))"
JOINS = r"len(regexp_extract_all({0}, '(?i)\bjoin\b'))"
KINDS = (
    "CASE " + " ".join(f"WHEN starts_with(upper(trim({{0}})), '{k}') THEN '{k}'"
                       for k in fv.STATEMENT_KINDS) + " ELSE 'OTHER' END"
)


@query("""SELECT line_no, CAST(json_extract_string(line, '$.k') AS BIGINT) AS k,
  CASE WHEN line_no % 2 = 0 THEN '{"tag":"' || line_no || '","n":[1,{"x":null}]}' END AS rest
FROM fx_jsonl WHERE line <> '' AND json_valid(line)""")
def jsonl_clean(fx):
    more = F.concat(F.lit('{"tag":"'), "line_no", F.lit('","n":[1,{"x":null}],'), F.substring("line", 2, 2**31 - 1))
    odd = F.when((F.col("line_no") % 2 == 0) & F.startswith("line", F.lit("{")), more).otherwise(F.col("line"))
    return jsonl.parsed(fx.fx_jsonl.withColumn("line", odd), KEY_RECORD, rest="rest")


@query("SELECT line_no, line, 'not a JSON object' AS error FROM fx_jsonl WHERE line <> '' AND NOT json_valid(line)")
def jsonl_quarantine(fx):
    return jsonl.malformed_lines(fx.fx_jsonl)


@query("SELECT line_no, line FROM fx_jsonl WHERE line_no >= 25 AND line_no < 2500 AND line <> '' AND json_valid(line)")
def jsonl_slice(fx):
    return jsonl.line_slice(fx.fx_jsonl, "line_no", 25, 2500)


@query(CLASSIFIED + rf"""
SELECT rec_id, question, query, schema, {TOKENS.format('question')}::BIGINT AS question_tokens,
  {TOKENS.format('query')}::BIGINT AS query_tokens, {TOKENS.format('schema')}::BIGINT AS schema_tokens,
  ({TOKENS.format('question')} + {TOKENS.format('query')} + {TOKENS.format('schema')})::BIGINT AS total_tokens,
  {JOINS.format('query')}::BIGINT AS num_joins, (rec_id % 3)::BIGINT AS num_tables, (rec_id % 3 * 2)::BIGINT AS number_of_columns
FROM classified WHERE reason IS NULL AND length(question) BETWEEN 20 AND 1024""")
def enrich_records(fx):
    done = E.enrich(fx.fx_triplets)
    tokens = [F.col(f"token_count.{n}").cast("bigint").alias(f"{n}_tokens") for n in ("question", "query", "schema", "total")]
    counts = [F.col(n).cast("bigint").alias(n) for n in ("num_joins", "num_tables", "number_of_columns")]
    return done.select("rec_id", "question", "query", "schema", *tokens, *counts)


@query(CLASSIFIED + """
SELECT r AS reason, count(*) AS n FROM (
  SELECT coalesce(reason, CASE WHEN length(question) NOT BETWEEN 20 AND 1024 THEN 'Question length' END) AS r
  FROM classified) WHERE r IS NOT NULL GROUP BY r""")
def drop_reason_counts(fx):
    return E.skip_counts(fx.fx_triplets)


@query(CLASSIFIED + f"""
SELECT num_joins, cmd_type, count(*) AS n, round(avg(tokens), 6) AS mean_query_tokens FROM (
  SELECT {JOINS.format('query')}::BIGINT AS num_joins, {KINDS.format('query')} AS cmd_type,
    {TOKENS.format('query')} AS tokens
  FROM classified WHERE reason IS NULL AND length(question) BETWEEN 20 AND 1024) GROUP BY ALL""")
def enrich_summary(fx):
    done = E.enrich(fx.fx_triplets)
    return (
        done.groupBy(F.col("num_joins").cast("bigint").alias("num_joins"), S.statement_kind("query").alias("cmd_type"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("token_count.query"), 6).alias("mean_query_tokens"))
    )


@query(f"SELECT rec_id, {KINDS.format('sql_statement')} AS kind FROM fx_triplets")
def sql_kind(fx):
    return fx.fx_triplets.select("rec_id", S.statement_kind("sql_statement").alias("kind"))


@query(rf"""
, words AS (
  SELECT rec_id, unnest(list_transform(regexp_extract_all(sql_statement,
      '\b({"|".join(fv.SQL_COMMANDS)})\b', 1, 'i'),
      lambda x: upper(x))) AS w, generate_subscripts(regexp_extract_all(sql_statement,
      '\b({"|".join(fv.SQL_COMMANDS)})\b', 1, 'i'), 1) AS i
  FROM fx_triplets),
firsts AS (SELECT rec_id, w, min(i) AS i FROM words GROUP BY rec_id, w)
SELECT t.rec_id, coalesce(string_agg(f.w, ',' ORDER BY f.i), '') AS commands
FROM fx_triplets t LEFT JOIN firsts f ON f.rec_id = t.rec_id GROUP BY t.rec_id""")
def sql_commands(fx):
    return fx.fx_triplets.select("rec_id", F.array_join(S.commands("sql_statement"), ",").alias("commands"))


@query(CLASSIFIED + "SELECT rec_id, query FROM cleaned")
def sql_clean_comments(fx):
    return fx.fx_triplets.select("rec_id", S.clean_flat_comments("sql_statement").alias("query"))


@query(r"""
SELECT item_id, round_no,
  lower(regexp_replace(regexp_replace(trim(raw, E' \t\n\r'), ';\s*$', ''), '\s+', ' ', 'g')) AS norm,
  CASE WHEN ends_with(trim(raw, E' \t\n\r'), ';') THEN trim(raw, E' \t\n\r') ELSE trim(raw, E' \t\n\r') || ';' END AS closed
FROM fx_candidates""")
def sql_normalize(fx):
    return fx.fx_candidates.select(
        "item_id", "round_no", S.normalize_sql("raw").alias("norm"), S.with_semicolon("raw").alias("closed")
    )


# A script per candidate: several statements, quoted semicolons, and a quote that never closes.
SCRIPT = "{0} || '; SELECT ''a;b'' AS \"c;d\"; ' || 'x ''open; ' || {0}"


@query(f"""
, scripts AS (SELECT item_id, round_no, {SCRIPT.format('raw')} AS script FROM fx_candidates),
parts AS (
  SELECT item_id, round_no, list_filter(regexp_extract_all(script,
    '(?:[^;''"]|''[^'']*(?:''|$)|"[^"]*(?:"|$))+'), lambda s: regexp_matches(s, '\\S')) AS p FROM scripts)
SELECT item_id, round_no, unnest(p) AS statement, generate_subscripts(p, 1)::BIGINT - 1 AS statement_no,
  len(p) = 1 AS is_single FROM parts""")
def statement_split(fx):
    scripts = fx.fx_candidates.selectExpr("item_id", "round_no", f"{SCRIPT.format('raw')} AS script")
    kept = F.filter(S.split_statements("script"), lambda s: F.regexp_like(s, F.lit(r"\S")))
    return scripts.select(
        "item_id", "round_no", S.is_single_statement("script").alias("is_single"),
        F.posexplode(kept).alias("statement_no", "statement"),
    ).withColumn("statement_no", F.col("statement_no").cast("bigint"))


@query(r"""
SELECT item_id, attempt, trim(raw, E' \t\n\r\f\v') AS raw FROM fx_responses
WHERE raw IS NOT NULL AND regexp_matches(raw, '[^\s]')""")
def required_fields(fx):
    from sqlloom.functions.text import strip

    return fx.fx_responses.where(has_required("raw")).select("item_id", "attempt", strip("raw").alias("raw"))


@query(r"SELECT item_id, attempt, trim(replace(raw, chr(10), ' ')) AS raw FROM fx_responses")
def record_flatten(fx):
    return flatten_fields(fx.fx_responses, "raw")


@query(f"SELECT doc_id, {TOKENS.format('text')}::BIGINT AS tokens, length(text)::BIGINT AS chars FROM documents")
def text_tokens(fx):
    from suite.fixtures import table

    docs = table(fx.spark, fx.sf_dir, "documents")
    return docs.select("doc_id", token_count("text").cast("bigint").alias("tokens"), F.length("text").cast("bigint").alias("chars"))


@query("SELECT rec_id, prompt, sql_statement, schema FROM fx_triplets ORDER BY md5('42:' || rec_id), rec_id")
def shuffle_keyed(fx):
    return shuffled(fx.fx_triplets, "rec_id", 42)


@query("""
SELECT t.rec_id, t.prompt, t.sql_statement, t.schema FROM fx_triplets t
JOIN (SELECT prompt, min(rec_id) AS rec_id FROM fx_triplets GROUP BY prompt) f ON f.rec_id = t.rec_id""")
def first_per_prompt(fx):
    return first_per_key(fx.fx_triplets, ["prompt"], "rec_id")


@query("""
SELECT 'A' AS origin, trim(replace(prompt, chr(10), ' ')) AS text FROM fx_triplets
UNION ALL SELECT 'B', trim(replace(nl_prompt, chr(10), ' ')) FROM fx_examples""")
def flattened_union(fx):
    a = fx.fx_triplets.select(F.lit("A").alias("origin"), flatten("prompt").alias("text"))
    return a.unionByName(fx.fx_examples.select(F.lit("B").alias("origin"), flatten("nl_prompt").alias("text")))
