"""Queries on schema texts, catalogs and foreign keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.functions import responses as R
from sqlloom.functions import sqltext as S
from sqlloom.functions.fixed_values import RENDER_QUOTED_NAMES, RESERVED_WORDS
from sqlloom.operators import catalog as C
from sqlloom.operators.gates import without_name_conflicts
from sqlloom.operators.lookups import best_tables, marked_prefixes, with_marked_prefix
from sqlloom.operators.profiles import foreign_key_flags, foreign_key_share
from sqlloom.plans import schemas as J
from suite.fixtures import SCHEMA_ID
from suite.registry import query

# Statements around each table text: comments, quotes and backticks that the counters and strippers must tell apart.
BEFORE = "'/* CREATE TABLE c (x INT); */ CREATE TEMPORARY TABLE z (a INT); -- CREATE TABLE y' || chr(10)"
AFTER = (
    "chr(10) || 'CREATE TEMP TABLE q (b INT); CREATE TABLE `k` (`a` TEXT DEFAULT ''-- no''); -- it''s over' "
    "|| chr(10) || 'x ''-- open' || chr(10) || 'CREATE DATABASE d1; create schema s1' || chr(10)"
)
NOTED = f"{BEFORE} || ddl || {AFTER}"
QUOTED_NAMES = ", ".join(f"'{w}'" for w in RENDER_QUOTED_NAMES)
RESERVED = ", ".join(f"'{w}'" for w in RESERVED_WORDS)


def noted(fx):
    return fx.fx_tables.selectExpr("table_no", f"{NOTED} AS txt")


def assembled(fx):
    return C.assembled(fx.fx_tables, "schema_id", "table_no", "ddl")


def troubled(fx):
    """Assembled schemas whose tables come with comments, options, qualifiers, repeats and odd quotes."""
    name = F.col("table_name")
    head = F.concat(F.lit("CREATE TABLE "), name)
    quoted = F.element_at(
        F.array(F.concat(F.lit("create table main.["), name, F.lit("]")), F.concat(F.lit("CREATE TABLE IF NOT EXISTS '"), name, F.lit("'")),
                F.concat(F.lit("CREATE TABLE /* x( */ `"), name, F.lit("`")), head), (F.col("table_no") % 4 + 1).cast("int"))
    body = F.substring("ddl", F.length(head) + 1, 100_000)
    body = F.replace(body, F.lit("DEFAULT 'a,b'"), F.lit("DEFAULT 'x);' -- , gone TEXT\n/* , gone (1) */"))
    tail = F.when(F.col("table_no") % 3 == 0, F.concat(F.left(body, F.length(body) - 1), F.lit(" WITHOUT ROWID;"))).otherwise(body)
    again = F.concat(F.lit("\n-- CREATE TABLE gone (a INT);\nCREATE TABLE IF NOT EXISTS "), F.upper(name), F.lit(" (other INT);\nCREATE TEMP TABLE t_"), name, F.lit(" (a INT);"))
    return C.assembled(fx.fx_tables.select("schema_id", "table_no", F.concat(quoted, tail, again).alias("ddl")), "schema_id", "table_no", "ddl")


ASSEMBLED = ", assembled AS (SELECT schema_id, string_agg(ddl, chr(10) || chr(10) ORDER BY table_no) AS schema_sql FROM fx_tables GROUP BY schema_id)"
# RE2 has no possessive repeats; the units of a line are unambiguous, so a lazy repeat finds the same cut.
STRIP_QUOTED = r"""array_to_string(list_transform(string_split(
  rtrim(regexp_replace(txt, '/\*[\s\S]*?\*/', '', 'g'), chr(10)), chr(10)),
  lambda l: regexp_replace(l, '^((?:[^''"\-]|''[^'']*''|"[^"]*"|-[^\-''"])*?)--.*$', '\1')), chr(10))"""
STRIP_NAIVE = r"regexp_replace(rtrim(regexp_replace(txt, '/\*[\s\S]*?\*/', '', 'g'), chr(10)), '--[^\n]*', '', 'g')"


@query(f", noted AS (SELECT table_no, {NOTED} AS txt FROM fx_tables) SELECT table_no, {STRIP_NAIVE} AS txt FROM noted")
def strip_comments_naive(fx):
    return noted(fx).select("table_no", S.strip_comments_naive("txt").alias("txt"))


@query(f", noted AS (SELECT table_no, {NOTED} AS txt FROM fx_tables) SELECT table_no, {STRIP_QUOTED} AS txt FROM noted")
def strip_comments_quoted(fx):
    return noted(fx).select("table_no", S.strip_comments_quoted("txt").alias("txt"))


@query(f""", noted AS (SELECT table_no, {NOTED} AS txt FROM fx_tables)
SELECT table_no, regexp_replace(replace(txt, '`', '"'), '(?i)CREATE\\s+(?:SCHEMA|DATABASE)\\s+\\w+;?', '', 'g') AS txt FROM noted""")
def dialect_clean(fx):
    return noted(fx).select("table_no", S.clean_dialect("txt").alias("txt"))


@query(f""", noted AS (SELECT table_no, {NOTED} AS txt FROM fx_tables)
SELECT table_no,
  len(regexp_extract_all(txt, '(?i)\\bCREATE\\s+(?:TEMP|TEMPORARY\\s+)?TABLE\\b'))::INT AS with_temporary,
  len(regexp_extract_all(txt, '(?i)\\bCREATE\\s+TABLE\\b'))::INT AS plain,
  len(regexp_extract_all({STRIP_QUOTED}, '(?i)\\bCREATE\\s+TABLE\\b'))::INT AS uncommented
FROM noted""")
def schema_table_counts(fx):
    return noted(fx).select(
        "table_no", D.table_count_with_temporary("txt").alias("with_temporary"), D.table_count("txt").alias("plain"),
        D.table_count_uncommented("txt").alias("uncommented"),
    )


@query("""SELECT """ + SCHEMA_ID + """ AS schema_id,
  CAST(sum(2 + CAST(p_size % 2 = 0 AS INT) + CAST(p_size % 3 = 0 AS INT)) AS BIGINT) AS number_of_columns
FROM part GROUP BY 1""")
def schema_column_counts(fx):
    return assembled(fx).select("schema_id", D.column_count("schema_sql").cast("bigint").alias("number_of_columns"))


@query(ASSEMBLED + " SELECT schema_id, schema_sql FROM assembled")
def schema_assembled(fx):
    return assembled(fx)


@query("""
, parts AS (SELECT *, """ + SCHEMA_ID + """ AS schema_id,
   replace(p_name, ' ', '_') || '_' || p_partkey AS table_name FROM part),
cols AS (
  SELECT schema_id, table_name, 0 AS pos, 'id' AS col_name, 'INTEGER' AS col_type FROM parts
  UNION ALL SELECT schema_id, table_name, 1, 'label', 'TEXT' FROM parts
  UNION ALL SELECT schema_id, table_name, 2, 'price', 'DECIMAL(10,2)' FROM parts WHERE p_size % 2 = 0
  UNION ALL SELECT schema_id, table_name, 3, 'parent_id', 'INTEGER' FROM parts WHERE p_size % 3 = 0)
SELECT schema_id, table_name, CAST(row_number() OVER (PARTITION BY schema_id, table_name ORDER BY pos) - 1 AS INT) AS col_idx,
  col_name, col_type FROM cols""")
def schema_catalog(fx):
    return C.catalog_from_ddl(troubled(fx), "schema_id", "schema_sql")


@query("""
, lines AS (
  SELECT schema_id, table_name, table_name || '(' ||
    string_agg(col_name || ':' || coalesce(col_type, ''), ', ' ORDER BY col_idx) FILTER (WHERE col_idx < 3) ||
    CASE WHEN count(*) > 3 THEN ', ...' ELSE '' END || ')' AS line
  FROM fx_columns GROUP BY schema_id, table_name)
SELECT schema_id, string_agg(line, chr(10) ORDER BY table_name) AS compressed FROM lines GROUP BY schema_id""")
def schema_compressed(fx):
    return C.compressed_schemas(fx.fx_columns, "schema_id", max_columns=3)


@query(f"""SELECT DISTINCT col_name, CASE WHEN regexp_matches(col_name, '[^A-Za-z0-9_]') OR upper(col_name) IN ({RESERVED})
  THEN '"' || replace(col_name, '"', '""') || '"' ELSE col_name END AS quoted
FROM (SELECT col_name FROM fx_columns UNION ALL SELECT col_name || ' "' || table_no || '"' FROM fx_columns)""")
def ident_quoted(fx):
    names = fx.fx_columns.select("col_name").unionByName(
        fx.fx_columns.select(F.expr("col_name || ' \"' || table_no || '\"'").alias("col_name"))
    )
    return names.distinct().select("col_name", S.quote_identifier("col_name").alias("quoted"))


@query(f"""SELECT schema_id, table_name, 'SELECT ' || string_agg(CASE WHEN upper(col_name) IN ({RESERVED})
   THEN '"' || col_name || '"' ELSE col_name END, ', ' ORDER BY col_idx) || ' FROM ' || table_name || ' LIMIT 20;' AS sql
FROM fx_columns GROUP BY schema_id, table_name""")
def preview_select(fx):
    tables = C.table_columns(fx.fx_columns, "schema_id")
    return tables.select("schema_id", "table_name", S.preview_select("table_name", F.col("columns")).alias("sql"))


RENDERED = f"""
, defs AS (
  SELECT schema_id, table_no, table_name, col_idx,
    CASE WHEN regexp_matches(col_name, '^[0-9]') OR upper(col_name) IN ({QUOTED_NAMES}) THEN '"' || col_name || '"' ELSE col_name END
    || ' ' || CASE col_type WHEN 'INTEGER' THEN col_type WHEN 'DECIMAL' THEN col_type ELSE 'TEXT' END
    || CASE WHEN NOT nullable THEN ' NOT NULL' ELSE '' END || CASE WHEN is_unique THEN ' UNIQUE' ELSE '' END
    || CASE WHEN default_val = '0' THEN ' DEFAULT 0' WHEN coalesce(default_val, '') <> '' THEN ' DEFAULT ''' || replace(default_val, '''', '') || '''' ELSE '' END AS def
  FROM fx_columns)
"""


@query(RENDERED + """SELECT schema_id, table_no, 'CREATE TABLE ' || table_name || ' (' || chr(10) || '  '
  || string_agg(def, ',' || chr(10) || '  ' ORDER BY col_idx) || ',' || chr(10) || '  PRIMARY KEY (id),' || chr(10)
  || '  FOREIGN KEY (id) REFERENCES "order" (id) ON DELETE SET NULL ON UPDATE NO ACTION' || chr(10) || ');' AS ddl
FROM defs GROUP BY schema_id, table_no, table_name""")
def ddl_render(fx):
    nested = C.nested_tables(fx.fx_columns.withColumn("default_bare", F.col("default_val") == "0"), ["schema_id", "table_no"])
    key = F.struct(
        F.array(F.lit("id")).alias("COLUMNS"), F.lit("order").alias("FOREIGN_TABLE"),
        F.array(F.lit("id")).alias("REFERRED_COLUMNS"), F.lit("SetNull").alias("ON_DELETE"),
        F.lit("NoAction").alias("ON_UPDATE"),
    )
    table = F.col("table").withField("PRIMARY_KEY", F.array(F.lit("id"))).withField("FOREIGN_KEYS", F.array(key))
    return nested.select("schema_id", "table_no", D.render_table(table).alias("ddl"))


@query("SELECT schema_id, table_no, table_name, col_idx, col_name, col_type, nullable, is_unique, default_val FROM fx_columns")
def nested_explode(fx):
    return C.exploded_columns(C.nested_tables(fx.fx_columns, ["schema_id", "table_no"]))


@query("SELECT 'table_' || table_no || '.sql' AS file_name, regexp_matches(ddl, 'REFERENCES|FOREIGN\\s+KEY') AS foreign_key FROM fx_tables")
def fk_flag(fx):
    return foreign_key_flags(fx.fx_tables.selectExpr("'table_' || table_no || '.sql' AS schema_file", "ddl AS schema_sql"))


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE fk) AS with_fk, count(*) FILTER (WHERE NOT fk) AS without_fk,
  round(100.0 * count(*) FILTER (WHERE NOT fk) / count(*), 9)::DOUBLE AS percent_without
FROM (SELECT p_size % 3 = 0 OR p_size % 5 = 0 AS fk FROM part)""")
def fk_share(fx):
    flags = foreign_key_flags(fx.fx_tables.selectExpr("'table_' || table_no || '.sql' AS schema_file", "ddl AS schema_sql"))
    return foreign_key_share(flags).withColumn("percent_without", F.round(F.col("percent_without").cast("double"), 9))


@query(r"""SELECT table_no, replace(replace(ddl, ' REFERENCES t0 (id) ON DELETE CASCADE', ' '),
  ',' || chr(10) || '  FOREIGN KEY (label) REFERENCES t1 (label)', '') AS ddl FROM fx_tables""")
def fk_strip(fx):
    return fx.fx_tables.select("table_no", D.strip_foreign_keys("ddl").alias("ddl"))


@query("""
, prefixes AS (SELECT DISTINCT regexp_replace(file_name, '\\.[^.]*$', '') AS prefix FROM fx_marked
  WHERE lower(trim(foreign_key)) IN ('true', '1', 'yes', 'y')),
files AS (SELECT 'schema_' || p_partkey || '.sql' AS schema_file FROM part)
SELECT schema_file FROM files f WHERE EXISTS (
  SELECT 1 FROM prefixes p WHERE starts_with(regexp_replace(f.schema_file, '\\.[^.]*$', ''), p.prefix))""")
def fk_marked_prefix(fx):
    files = fx.fx_tables.selectExpr("'schema_' || table_no || '.sql' AS schema_file")
    return with_marked_prefix(files, marked_prefixes(fx.fx_marked), "schema_file")


@query("""
, flagged AS (SELECT 'schema_' || p_partkey || '.sql' AS schema_file, p_size % 3 = 0 OR p_size % 5 = 0 AS changed FROM part),
prefixes AS (SELECT DISTINCT regexp_replace(file_name, '\\.[^.]*$', '') AS prefix FROM fx_marked
  WHERE lower(trim(foreign_key)) IN ('true', '1', 'yes', 'y'))
SELECT changed, count(*) AS n FROM flagged f WHERE EXISTS (
  SELECT 1 FROM prefixes p WHERE starts_with(regexp_replace(f.schema_file, '\\.[^.]*$', ''), p.prefix)) GROUP BY changed""")
def fk_strip_report(fx):
    schemas = fx.fx_tables.selectExpr("'schema_' || table_no || '.sql' AS schema_file", "ddl AS schema_sql")
    stripped = J.stripped_schemas(schemas, marked_prefixes(fx.fx_marked))
    return stripped.groupBy("changed").agg(F.count(F.lit(1)).alias("n"))


# Growth responses of every shape the extraction cascade knows.
REPLY = (
    "CASE table_no % 6 WHEN 0 THEN '```sqlite' || chr(10) || 'note ' || ddl || chr(10) || '```' "
    "WHEN 1 THEN '```sql' || chr(10) || 'draft' || chr(10) || '``` ```sql' || chr(10) || ddl || chr(10) || '```' "
    "WHEN 2 THEN '```' || chr(10) || ddl || chr(10) || 'DROP TABLE x;' || chr(10) || '```' "
    "WHEN 3 THEN 'Here: ' || ddl || ' CREATE INDEX i ON t (a); done' WHEN 4 THEN ' no DDL at all ' "
    "ELSE 'open ```sqlite' || chr(10) || ddl END"
)


@query("""
SELECT table_no, CASE table_no % 6 WHEN 3 THEN ddl || chr(10) || chr(10) || 'CREATE INDEX i ON t (a);'
  WHEN 4 THEN 'no DDL at all' ELSE ddl END AS ddl FROM fx_tables""")
def ddl_extract(fx):
    replies = fx.fx_tables.selectExpr("table_no", f"{REPLY} AS reply")
    return replies.select("table_no", R.ddl_from_response("reply").alias("ddl"))


@query("""
, batch AS (
  SELECT schema_id, table_no AS ord, table_no, table_name, ddl FROM fx_tables
  UNION ALL SELECT schema_id, table_no + 1000000000, table_no, table_name, replace(ddl, table_name, upper(table_name)) FROM fx_tables),
existing AS (SELECT schema_id, table_name FROM fx_tables WHERE ddl LIKE '%price%')
SELECT schema_id, ord, ddl AS statement FROM batch b
WHERE ord < 1000000000 AND NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.schema_id = b.schema_id AND lower(e.table_name) = lower(b.table_name))""")
def new_table_conflicts(fx):
    tables = fx.fx_tables
    batch = tables.selectExpr("schema_id", "table_no AS ord", "ddl AS statement").unionByName(
        tables.selectExpr("schema_id", "table_no + 1000000000 AS ord", "replace(ddl, table_name, upper(table_name)) AS statement")
    )
    return without_name_conflicts(batch, tables.where("ddl like '%price%'").select("schema_id", "table_name"))


@query("""
, asks AS (SELECT row_idx, CAST(regexp_extract(schema_file, '[0-9]+', 0) AS BIGINT) AS scope,
  list_filter(list_distinct(string_split(lower(question), ' ')), lambda t: t <> '') AS toks FROM fx_questions),
toks AS (SELECT row_idx, scope, unnest(toks) AS tok FROM asks),
names AS (
  SELECT DISTINCT schema_id AS scope, table_name, 'T' AS kind, lower(table_name) AS name FROM fx_columns
  UNION ALL SELECT schema_id, table_name, 'C', lower(col_name) FROM fx_columns),
scores AS (SELECT t.row_idx, t.scope, n.table_name, count(*) AS s FROM toks t JOIN names n
  ON n.scope = t.scope AND contains(n.name, t.tok) GROUP BY ALL),
best AS (SELECT row_idx, scope, table_name, row_number() OVER (PARTITION BY row_idx ORDER BY s DESC, table_name DESC) AS r FROM scores),
firsts AS (SELECT schema_id AS scope, min(table_name) AS first_name FROM fx_columns GROUP BY schema_id)
SELECT a.row_idx, a.scope, coalesce(b.table_name, f.first_name) AS table_name
FROM asks a JOIN firsts f ON f.scope = a.scope LEFT JOIN best b ON b.row_idx = a.row_idx AND b.r = 1""")
def best_table(fx):
    asks = fx.fx_questions.select(
        "row_idx", F.regexp_extract("schema_file", "[0-9]+", 0).cast("bigint").alias("scope"),
        F.split(F.lower("question"), " ").alias("tokens"),
    )
    return best_tables(asks, fx.fx_columns.select(F.col("schema_id").alias("scope"), "table_name", "col_name"))
