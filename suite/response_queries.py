"""Queries on model responses: lines, attempts, candidates, votes, paraphrases, prompts."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import functions as F

from sqlloom.functions import prompts as T
from sqlloom.functions import responses as R
from sqlloom.operators import attempts as W
from sqlloom.operators import candidates as C
from sqlloom.plans import enrich as E
from sqlloom.plans import paraphrase as PP
from sqlloom.plans import synthesis as S
from suite.registry import query
from suite.rows import CLASSIFIED, TOKENS

TEXT = r"coalesce(list_extract(regexp_extract_all(raw, '(?is)```plaintext\s*\n(.*?)```', 1), -1), raw)"


def lines_sql(numbering: str) -> str:
    """Cleaned, non-empty lines per response: a list expression over ``raw``."""
    trimmed = r"regexp_replace(regexp_replace(l, '\s*[-•]*\s*$', ''), '^\s*[-•]*\s*" + numbering + r"\s*', '')"
    return (
        f"list_filter(list_transform(regexp_split_to_array({TEXT}, '\\r\\n|[\\n\\r]'), lambda l: {trimmed}), lambda l: l <> '')"
    )


ONCE, MIXED = r"[0-9]*\.*\)*-*", r"(?:[0-9.)]\s*)*"
TEMPLATES = r"regexp_matches(array_to_string(lines, chr(10)), '<(First|2nd|Nth|3rd|4th|5th|Second|Fifth) Question>|```|plaintext|<\|Start of a new question\|>')"
PARSED = f"""
, parsed AS (SELECT item_id, attempt, lines, len(lines) > 0 AND NOT {TEMPLATES} AS valid FROM
  (SELECT item_id, attempt, {lines_sql(ONCE)} AS lines FROM fx_responses)),
accepted AS (SELECT item_id, min(attempt) AS attempt, arg_min(lines, attempt) AS lines FROM parsed
  WHERE valid AND attempt <= 2 GROUP BY item_id)"""


def parsed_attempts(fx):
    return W.parsed_questions(fx.fx_responses)


def per_line(df, lines, *keys):
    return df.select(*keys, F.posexplode(lines).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(f"SELECT item_id, attempt, unnest(l) AS line, generate_subscripts(l, 1)::BIGINT - 1 AS line_no FROM (SELECT item_id, attempt, {lines_sql(ONCE)} AS l FROM fx_responses)")
def response_lines(fx):
    return per_line(fx.fx_responses, R.question_lines("raw"), "item_id", "attempt")


@query(f"SELECT item_id, attempt, unnest(l) AS line, generate_subscripts(l, 1)::BIGINT - 1 AS line_no FROM (SELECT item_id, attempt, {lines_sql(MIXED)} AS l FROM fx_responses)")
def response_lines_mixed(fx):
    return per_line(fx.fx_responses, R.paraphrase_lines("raw"), "item_id", "attempt")


@query(PARSED + " SELECT item_id, attempt, valid FROM parsed")
def response_gate(fx):
    return parsed_attempts(fx).select("item_id", "attempt", "valid")


@query(PARSED + """ SELECT item_id, attempt, unnest(lines[1:5]) AS question, generate_subscripts(lines[1:5], 1)::BIGINT - 1 AS line_no FROM accepted""")
def first_valid_attempt(fx):
    lines = W.numbered_lines(W.first_valid(parsed_attempts(fx), 2), 5)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


@query(PARSED + " SELECT DISTINCT item_id FROM fx_responses WHERE item_id NOT IN (SELECT item_id FROM parsed WHERE valid AND attempt = 0)")
def pending_items(fx):
    items = fx.fx_responses.select("item_id").distinct()
    return W.pending(items, W.first_valid(parsed_attempts(fx), 0))


@query("SELECT q.item_id, q.attempt, 'ask ' || q.item_id || '/' || q.attempt AS prompt, r.raw FROM (SELECT item_id, attempt FROM fx_responses) q JOIN fx_responses r USING (item_id, attempt)")
def prompt_alignment(fx):
    asked = fx.fx_responses.selectExpr("item_id", "attempt", "'ask ' || item_id || '/' || attempt AS prompt")
    return W.aligned(asked, fx.fx_responses)


@query(r"""SELECT item_id, attempt, unnest(b) AS block, generate_subscripts(b, 1)::BIGINT - 1 AS block_no FROM (SELECT item_id, attempt,
  list_transform(regexp_extract_all(raw, '(?s)```plaintext(.*?)```', 1), lambda x: trim(x, E' \t\n\r')) AS b FROM fx_responses)""")
def blocks_plain(fx):
    return fx.fx_responses.select(
        "item_id", "attempt", F.posexplode(R.plain_blocks("raw", "plaintext")).alias("block_no", "block")
    ).withColumn("block_no", F.col("block_no").cast("bigint"))


@query(r"""SELECT item_id, attempt, unnest(b) AS block, generate_subscripts(b, 1)::BIGINT - 1 AS block_no FROM (SELECT item_id, attempt,
  list_transform(regexp_extract_all(raw, '(?is)```plaintext\s*\n(.*?)```', 1), lambda x: trim(x, E' \t\n\r')) AS b FROM fx_responses)""")
def blocks_tagged(fx):
    return fx.fx_responses.select(
        "item_id", "attempt", F.posexplode(R.tagged_blocks("raw", "plaintext")).alias("block_no", "block")
    ).withColumn("block_no", F.col("block_no").cast("bigint"))


NORM = r"lower(trim(regexp_replace({0}, '\s+', ' ', 'g')))"
REPHRASED = f"""
, told AS (SELECT item_id, attempt, list_filter({lines_sql(MIXED)}, lambda l: NOT contains(lower(l), 'paraphrase')) AS lines FROM fx_responses),
usable AS (SELECT item_id, arg_min(lines, attempt) AS lines FROM told WHERE len(lines) > 0 GROUP BY item_id),
paired AS (SELECT t.rec_id, t.prompt, u.lines FROM fx_triplets t JOIN usable u ON u.item_id = t.rec_id),
offered AS (SELECT rec_id, prompt, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM paired),
firsts AS (SELECT rec_id, min(i) AS i, arg_min(line, i) AS line FROM offered
  WHERE {NORM.format('line')} <> {NORM.format('prompt')} GROUP BY rec_id, {NORM.format('line')}),
kept AS (SELECT rec_id, line, row_number() OVER (PARTITION BY rec_id ORDER BY i) AS r FROM firsts)"""


def _lines(fx):
    responses = fx.fx_responses.withColumnRenamed("item_id", "rec_id")
    return PP.first_usable(PP.usable_lines(responses, "rec_id"), "rec_id")


@query(REPHRASED + " SELECT rec_id, line AS question, r AS place FROM kept WHERE r <= 2")
def paraphrase_keep(fx):
    kept = R.with_new_wordings(fx.fx_triplets.join(_lines(fx), "rec_id"), "lines", "prompt", 2, "kept")
    return kept.select("rec_id", F.posexplode("kept").alias("place", "question")).withColumn("place", (F.col("place") + 1).cast("bigint"))


@query(CLASSIFIED + REPHRASED + f""", done AS (SELECT rec_id, question, query, schema FROM classified
  WHERE reason IS NULL AND length(question) BETWEEN 20 AND 1024)
SELECT rec_id, question, query, {TOKENS.format('question')}::BIGINT AS question_tokens,
  ({TOKENS.format('question')} + {TOKENS.format('query')} + {TOKENS.format('schema')})::BIGINT AS total_tokens,
  NULL::VARCHAR AS augmentation_type, NULL::VARCHAR AS augmentation_of FROM done
UNION ALL
SELECT d.rec_id, k.line, query, {TOKENS.format('k.line')}::BIGINT, ({TOKENS.format('k.line')} + {TOKENS.format('query')} + {TOKENS.format('schema')})::BIGINT,
  'question_paraphrase', d.question FROM done d JOIN kept k ON k.rec_id = d.rec_id WHERE k.r <= 2""")
def paraphrase_union(fx):
    records = E.enrich(fx.fx_triplets)
    both = PP.with_originals(records, PP.paraphrased(records, _lines(fx), "rec_id", 2, "stub"))
    return both.select(
        "rec_id", "question", "query", F.col("token_count.question").cast("bigint").alias("question_tokens"),
        F.col("token_count.total").cast("bigint").alias("total_tokens"), "augmentation_type", "augmentation_of",
    )


# Extraction cascade over a text column: last sql block, last block, open sql block, last colon to last semicolon.
WS = r"E' \t\n\r'"


def extract_sql(raw: str) -> str:
    open_rest = rf"regexp_extract({raw}, '(?is)```sql\b\s*(.*)$', 1)"
    head = rf"regexp_extract({raw}, '(?s)^(.*;)[^;]*$', 1)"
    return rf"""coalesce(
  nullif(trim(list_extract(regexp_extract_all({raw}, '(?is)```sql\b\s*(.*?)\s*```', 1), -1), {WS}), ''),
  nullif(trim(list_extract(regexp_extract_all({raw}, '(?s)```+\s*(.*?)\s*```+', 1), -1), {WS}), ''),
  CASE WHEN regexp_matches({raw}, '(?i)```sql\b') THEN nullif(trim(regexp_extract({open_rest}, '(?s)^([^;]*;?)', 1), {WS}), '')
    WHEN contains({head}, ':') THEN nullif(trim(regexp_extract({head}, '(?s)([^:]*)$', 1), {WS}), '') END)"""


def norm_sql(sql: str) -> str:
    return rf"lower(regexp_replace(regexp_replace(trim({sql}, {WS}), ';\s*$', ''), '\s+', ' ', 'g'))"


GATED = rf"""
, found AS (SELECT item_id, round_no, {extract_sql('raw')} AS s FROM fx_candidates),
closed AS (SELECT item_id, round_no, CASE WHEN ends_with(s, ';') THEN s ELSE s || ';' END AS sql FROM found),
gated AS (SELECT item_id, round_no, sql, {norm_sql('sql')} AS norm, CASE WHEN sql IS NULL THEN 'no SQL in the response'
  WHEN len(list_filter(regexp_extract_all(sql, '(?:[^;''"]|''[^'']*(?:''|$)|"[^"]*(?:"|$))+'), lambda p: regexp_matches(p, '\S'))) <> 1
    THEN 'not a single statement' END AS reason FROM closed),
kept AS (SELECT item_id, norm, min(round_no) AS round_no, arg_min(sql, round_no) AS sql FROM gated WHERE reason IS NULL GROUP BY item_id, norm)"""


@query(GATED + " SELECT item_id, round_no, sql, norm, reason FROM gated")
def candidate_extract(fx):
    return C.extracted_candidates(fx.fx_candidates)


@query(GATED + " SELECT item_id, round_no, sql, norm FROM kept")
def candidate_dedup(fx):
    return C.distinct_candidates(C.extracted_candidates(fx.fx_candidates))


@query(GATED + """ SELECT g.item_id, g.round_no, g.sql, coalesce(g.reason, 'duplicate of an earlier candidate') AS reason
FROM gated g LEFT JOIN kept k ON k.item_id = g.item_id AND k.norm = g.norm AND k.round_no = g.round_no
WHERE g.reason IS NOT NULL OR k.round_no IS NULL""")
def candidate_quarantine(fx):
    return C.quarantined_candidates(C.extracted_candidates(fx.fx_candidates))


LOOSE = "rtrim({0}, E';\\n\\t ')"
VOTED = GATED + rf""",
usable AS (SELECT item_id, round_no, sql, norm FROM kept
  UNION ALL SELECT DISTINCT item_id, 0, 'SELECT 1;', 'select 1' FROM fx_judge WHERE item_id NOT IN (SELECT item_id FROM kept)),
chosen AS (SELECT item_id, {extract_sql('raw')} AS c FROM fx_judge),
won AS (SELECT u.item_id, coalesce(
    arg_max(u.sql, u.round_no) FILTER (WHERE u.norm = {norm_sql('c')}),
    arg_min(u.sql, u.round_no) FILTER (WHERE {LOOSE.format('u.sql')} = {LOOSE.format('c')}),
    arg_min(u.sql, u.round_no)) AS w FROM usable u LEFT JOIN chosen h ON h.item_id = u.item_id GROUP BY u.item_id)"""


@query(VOTED + " SELECT item_id, CASE WHEN ends_with(w, ';') THEN w ELSE w || ';' END AS winner FROM won")
def vote_winner(fx):
    items = fx.fx_judge.select("item_id")
    usable = C.with_fallback(items, C.distinct_candidates(C.extracted_candidates(fx.fx_candidates)))
    return C.voted(items, usable, fx.fx_judge)


@query(VOTED + " SELECT item_id, round_no, sql FROM usable")
def candidate_fallback(fx):
    usable = C.with_fallback(fx.fx_judge, C.distinct_candidates(C.extracted_candidates(fx.fx_candidates)))
    return usable.select("item_id", "round_no", "sql")


def template_sql(template: str, **slots: str) -> str:
    """The template as a DuckDB concatenation; slots are SQL expressions."""
    parts = []
    for text, slot, _, _ in Formatter().parse(template):
        if text:
            parts.append("'" + text.replace("'", "''") + "'")
        if slot:
            parts.append(f"({slots[slot]})")
    return " || ".join(parts)


_TONE = f"CASE WHEN table_no % 3 = 0 THEN '{T.TONE_SPECIFIC}' ELSE '{T.TONE_GENERAL}' END"
_SAMPLES = f"CASE WHEN table_no % 5 = 0 THEN '' ELSE {template_sql(T.SAMPLES, joins='table_no % 11', lines=chr(39) + '- a' + chr(39) + ' || chr(10) || ' + chr(39) + '- b ' + chr(39) + ' || table_name')} END"


@query("SELECT table_no, " + template_sql(
    T.QUESTION_RETRY, attempt="2", prompt=template_sql(
        T.QUESTION, count="'10'", schema="ddl", samples=_SAMPLES, joins="table_no % 10", tone=_TONE)) + " AS prompt FROM fx_tables")
def prompt_question(fx):
    shown = F.when(F.col("table_no") % 5 != 0, F.array(F.lit("a"), F.concat(F.lit("b "), F.col("table_name")))).otherwise(
        F.array().cast("array<string>"))
    asked = T.question_prompt("ddl", shown, F.col("table_no") % 11, F.col("table_no") % 10, F.col("table_no") % 3 == 0, 10)
    return fx.fx_tables.select("table_no", asked.alias("p")).select("table_no", T.question_retry("p", 2).alias("prompt"))


@query(f"SELECT table_no, CASE WHEN table_no % 2 = 0 THEN {template_sql(T.GROWTH, n_new='table_no % 25', schema='ddl')} "
       f"ELSE {template_sql(T.REPAIR, n_new='table_no % 25', schema='ddl', error='table_name')} END AS prompt FROM fx_tables")
def prompt_growth(fx):
    n = F.col("table_no") % 25
    return fx.fx_tables.select("table_no", F.when(
        F.col("table_no") % 2 == 0, T.growth_prompt("ddl", n)).otherwise(T.repair_prompt("ddl", n, "table_name")).alias("prompt"))


@query(f", compressed AS (SELECT schema_id, string_agg(table_name, chr(10) ORDER BY table_no) AS c FROM fx_tables GROUP BY schema_id) "
       f"SELECT q.row_idx, {template_sql(T.SQL, question='q.question', schema='coalesce(c, ' + chr(39) * 2 + ')')} AS prompt FROM fx_questions q "
       "LEFT JOIN compressed ON q.schema_file = 'schema_' || schema_id || '.sql'")
def prompt_sql(fx):
    compressed = fx.fx_tables.groupBy("schema_id").agg(
        F.expr("listagg(table_name, '\n') within group (order by table_no)").alias("compressed")
    ).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "compressed")
    items = fx.fx_questions.withColumnRenamed("row_idx", "item_id")
    return S.generation_prompts(items, compressed).withColumnRenamed("item_id", "row_idx")


_CANDIDATES = template_sql(T.CANDIDATE, number="n", sql="trim(sql, E' \\t\\n\\r')")


_NAMES = "SELECT schema_id, string_agg(table_name, chr(10) ORDER BY table_no) AS c FROM fx_tables GROUP BY schema_id"


@query(VOTED + f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round_no) AS n FROM usable),
blocks AS (SELECT item_id, string_agg({_CANDIDATES}, chr(10) ORDER BY n) AS b FROM numbered GROUP BY item_id),
names AS ({_NAMES})
SELECT item_id, {template_sql(T.JUDGE, question="'task ' || item_id", schema="coalesce(c, '')", candidates='b')} AS prompt
FROM blocks LEFT JOIN names ON schema_id = item_id % 300""")
def prompt_vote(fx):
    items = fx.fx_judge.selectExpr("item_id", "'task ' || item_id AS question", "'s' || (item_id % 300) AS schema_file")
    usable = C.with_fallback(items, C.distinct_candidates(C.extracted_candidates(fx.fx_candidates)))
    compressed = fx.fx_tables.groupBy("schema_id").agg(
        F.expr("listagg(table_name, '\n') within group (order by table_no)").alias("compressed")
    ).selectExpr("'s' || schema_id AS schema_file", "compressed")
    return S.vote_prompts(items, compressed, usable)


@query("SELECT rec_id, " + template_sql(
    T.PARAPHRASE_RETRY, attempt="1", prompt=template_sql(
        T.PARAPHRASE, question="trim(prompt)", query="trim(sql_statement)", count="'2'")) + " AS prompt FROM fx_triplets WHERE prompt <> '' AND sql_statement <> ''")
def prompt_paraphrase(fx):
    records = fx.fx_triplets.selectExpr("rec_id", "prompt AS question", "sql_statement AS query")
    asked = PP.paraphrase_prompts(records, 2, "rec_id")
    return asked.select("rec_id", T.paraphrase_retry("prompt", 1).alias("prompt"))
