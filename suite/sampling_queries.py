"""Queries on distributions, quotas, draws, example buckets, ordering and dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from sqlloom.operators import examples as X
from sqlloom.operators import profiles as P
from sqlloom.operators import ranking as K
from sqlloom.operators import sampling as A
from sqlloom.operators.gates import first_questions, without_failed_names
from sqlloom.plans import schemas as J
from sqlloom.session import run_folder, written
from sqlloom.sources.files import manifest_paths
from suite.registry import query
from suite.schema_queries import ASSEMBLED, assembled

SEED = 42
# A target that bites on the small test data; the jobs default to 100 and 350.
MODE, MAX_TABLES = 8, 60

UNIFORM = "(CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT) / 4294967296.0)"


def density_sql(mode: int, top: int, ramp: float) -> str:
    theta, shape = top / 10, max(mode / (top / 10) + 1, 1.5)
    return f"""
raw AS (SELECT x::INT AS num_tables, pow(x::DOUBLE, {shape - 1}) * exp(-x::DOUBLE / {theta}) AS y FROM range({top + 1}) r(x)),
peak AS (SELECT num_tables AS p, y AS top_y FROM raw ORDER BY y DESC, num_tables LIMIT 1),
ramped AS (SELECT num_tables, CASE WHEN num_tables < p THEN {ramp} + {1 - ramp} * num_tables / greatest(p - 1, 1)
  ELSE y / top_y END AS y FROM raw, peak),
density AS (SELECT num_tables, y / sum(y) OVER () AS density FROM ramped)"""


COUNTS = ASSEMBLED + r""", counts AS (SELECT 'schema_' || schema_id || '.sql' AS schema_file,
  len(regexp_extract_all(schema_sql, '(?i)\bCREATE\s+TABLE\b'))::INT AS num_tables FROM assembled)"""
TARGETS = COUNTS + "," + density_sql(MODE, MAX_TABLES, 0.7) + """,
targets AS (SELECT num_tables, CAST(round_even(density * (SELECT count(*) FROM counts), 0) AS INT) AS target FROM density),
decided AS (SELECT schema_file, c.num_tables, CASE WHEN target IS NULL THEN 'OVER_MAX'
  WHEN row_number() OVER (PARTITION BY c.num_tables ORDER BY md5('42:' || schema_file), schema_file) <= target THEN 'KEEP'
  ELSE 'SKIP' END AS action FROM counts c LEFT JOIN targets t ON t.num_tables = c.num_tables)"""


def schema_counts(fx):
    schemas = assembled(fx).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "schema_sql")
    return J.table_counts(schemas)


@query(COUNTS + """ SELECT x::INT AS num_tables, count(c.schema_file) AS n
FROM range((SELECT max(num_tables) + 1 FROM counts)) r(x) LEFT JOIN counts c ON c.num_tables = x GROUP BY x""")
def histogram_tables(fx):
    return P.table_histogram(schema_counts(fx))


def _stored_counts(fx):
    """The texts are read once; the counts are small and used several times."""
    return written(schema_counts(fx), f"{run_folder(fx.spark, 'fit')}/counts")


def _targets(fx, counts):
    return J.fit_targets(counts, MODE, MAX_TABLES)


@query(TARGETS + " SELECT d.num_tables, round(density, 9) AS density, target FROM density d JOIN targets t ON t.num_tables = d.num_tables")
def density_target(fx):
    density = A.table_count_density(fx.spark, MODE, MAX_TABLES, J.FIT_RAMP)
    targets = _targets(fx, schema_counts(fx))
    return density.join(targets, "num_tables").select("num_tables", F.round("density", 9).alias("density"), "target")


@query(TARGETS + " SELECT schema_file, num_tables, action FROM decided")
def quota_sample(fx):
    return J.fit_distribution(_stored_counts(fx), MODE, MAX_TABLES, SEED)


@query(TARGETS + """ SELECT coalesce(d.num_tables, t.num_tables) AS num_tables, coalesce(observed, 0) AS observed,
  coalesce(target, 0)::BIGINT AS target, coalesce(kept, 0) AS kept, coalesce(skipped, 0) AS skipped, coalesce(over_max, 0) AS over_max
FROM (SELECT num_tables, count(*) AS observed, count(*) FILTER (WHERE action = 'KEEP') AS kept,
  count(*) FILTER (WHERE action = 'SKIP') AS skipped, count(*) FILTER (WHERE action = 'OVER_MAX') AS over_max
  FROM decided GROUP BY num_tables) d FULL JOIN targets t ON t.num_tables = d.num_tables""")
def quota_report(fx):
    counts = _stored_counts(fx)
    return J.fit_report(J.fit_distribution(counts, MODE, MAX_TABLES, SEED), _targets(fx, counts))


@query("," + density_sql(100, 350, 0.5).strip() + f""",
bounds AS (SELECT num_tables, round(sum(density) OVER (ORDER BY num_tables), 9) AS high FROM density),
edges AS (SELECT num_tables, coalesce(lag(high) OVER (ORDER BY num_tables), 0.0) AS low,
  CASE WHEN num_tables = 350 THEN 1.0 ELSE high END AS high FROM bounds),
draws AS (SELECT row_idx, {UNIFORM.format("'42:' || row_idx")} AS u FROM fx_questions)
SELECT row_idx, num_tables AS target FROM draws JOIN edges ON u >= low AND u < high""")
def draw_targets(fx):
    density = A.table_count_density(fx.spark, 100, 350, J.GROWTH_RAMP)
    bounds = A.cumulative(density, "num_tables", "density")
    return A.draw_weighted(fx.fx_questions.select("row_idx"), bounds, "num_tables", SEED, "row_idx").withColumnRenamed(
        "num_tables", "target"
    )


PMF = ("pmf AS (SELECT x::INT AS j, CASE x WHEN 0 THEN 0.15::DOUBLE WHEN 1 THEN 0.2::DOUBLE ELSE 0.6::DOUBLE / 36 * (10 - x) END AS p FROM range(11) r(x)), "
       "cdf AS (SELECT j, sum(p) OVER (ORDER BY j) AS c FROM pmf)")


@query(f", {PMF} SELECT row_idx, coalesce((SELECT min(j) FROM cdf WHERE {UNIFORM.format(chr(39) + '42:' + chr(39) + ' || row_idx')} <= c), 10)::INT AS num_joins FROM fx_questions")
def draw_joins(fx):
    return fx.fx_questions.select("row_idx", A.draw_joins(SEED, "row_idx").alias("num_joins"))


@query(f"SELECT row_idx, {UNIFORM.format(chr(39) + '42:' + chr(39) + ' || row_idx')} < 0.3 AS is_specific FROM fx_questions")
def prompt_variant(fx):
    return fx.fx_questions.select("row_idx", A.draw_flag(0.3, SEED, "row_idx").alias("is_specific"))


@query("""SELECT table_no, least(15 + CAST('0x' || substr(md5('42:' || table_no || ':1'), 1, 8) AS BIGINT) % 11,
  length(ddl) % 40)::INT AS n_new FROM fx_tables""")
def growth_batch(fx):
    return fx.fx_tables.select(
        "table_no", A.growth_step(F.lit(0), F.length("ddl") % 40, SEED, "table_no", F.lit(1)).cast("int").alias("n_new")
    )


VALID = r"""
, valid AS (SELECT DISTINCT trim(nl_prompt) AS nl_prompt, TRY_CAST(trim(num_joins) AS INT) AS num_joins FROM fx_examples
  WHERE trim(nl_prompt) <> '' AND TRY_CAST(trim(num_joins) AS INT) BETWEEN 0 AND 10),
buckets AS (SELECT x::INT AS num_joins, count(v.nl_prompt) AS n_examples FROM range(11) r(x)
  LEFT JOIN valid v ON v.num_joins = x GROUP BY x),
nearest AS (SELECT t.num_joins AS target_joins, (SELECT b.num_joins FROM buckets b WHERE b.n_examples > 0
  ORDER BY abs(b.num_joins - t.num_joins), b.num_joins LIMIT 1) AS used_joins FROM buckets t)"""


@query(r"SELECT DISTINCT trim(nl_prompt) AS nl_prompt, trim(num_joins) AS num_joins FROM fx_examples WHERE trim(nl_prompt) <> ''")
def examples_distinct(fx):
    return X.distinct_examples(fx.fx_examples)


@query(VALID + " SELECT num_joins, n_examples FROM buckets")
def example_buckets(fx):
    return X.example_buckets(X.valid_examples(fx.fx_examples))


@query(VALID + " SELECT target_joins, used_joins FROM nearest")
def nearest_bucket(fx):
    nearest = X.nearest_buckets(X.example_buckets(X.valid_examples(fx.fx_examples)))
    return nearest.select("target_joins", "used_joins")


def _floyd_sql(k: int) -> str:
    """Positions drawn for n rows by Floyd's method, spelled out for k draws."""
    steps, taken = [], "[]::BIGINT[]"
    for i in range(k):
        u = UNIFORM.format(f"'42:' || row_idx || ':{i}'")
        t, j = f"CAST(floor({u} * (n - {k - i} + 1)) AS BIGINT)", f"n - {k - i}"
        steps.append(f"s{i} AS (SELECT row_idx, j, n, used, list_append(s, CASE WHEN list_contains(s, {t}) THEN {j} ELSE {t} END) AS s "
                     f"FROM {'s' + str(i - 1) if i else 'placed0'})")
    return ", ".join([f"placed0 AS (SELECT *, {taken} AS s FROM placed)", *steps])


@query(VALID + f""", {PMF},
wants AS (SELECT row_idx, coalesce((SELECT min(j) FROM cdf WHERE {UNIFORM.format(chr(39) + '42:' + chr(39) + ' || row_idx')} <= c), 10)::INT AS j FROM fx_questions),
placed AS (SELECT w.row_idx, w.j, b.num_joins AS used, b.n_examples AS n FROM wants w JOIN nearest t ON t.target_joins = w.j
  JOIN buckets b ON b.num_joins = t.used_joins),
{_floyd_sql(4)},
picks AS (SELECT row_idx, used, unnest(s) AS pos, generate_subscripts(s, 1) AS slot FROM
  (SELECT row_idx, used, CASE WHEN n <= 4 THEN range(n) ELSE s END AS s FROM s3)),
ranked AS (SELECT num_joins, nl_prompt, row_number() OVER (PARTITION BY num_joins ORDER BY md5('42:' || nl_prompt), nl_prompt) - 1 AS pos FROM valid)
SELECT p.row_idx, p.j AS target, p.used AS examples_joins,
  coalesce((SELECT string_agg(r.nl_prompt, ' | ' ORDER BY slot) FROM picks k JOIN ranked r ON r.num_joins = k.used AND r.pos = k.pos
    WHERE k.row_idx = p.row_idx), '') AS examples
FROM placed p""")
def example_draw(fx):
    wants = fx.fx_questions.select("row_idx", A.draw_joins(SEED, "row_idx").alias("target"))
    drawn = X.draw_examples(wants, "row_idx", "target", X.valid_examples(fx.fx_examples), 4, SEED)
    return drawn.withColumn("examples", F.array_join("examples", " | "))


@query(r"""SELECT prompt AS nl_prompt, len(regexp_extract_all(sql_statement, '(?i)\bjoin\b'))::INT AS num_joins FROM fx_triplets
UNION ALL SELECT 'item ' || item_id, len(regexp_extract_all(raw, '(?i)\bjoin\b'))::INT FROM fx_candidates""")
def examples_build(fx):
    return X.build_examples(
        fx.fx_triplets.selectExpr("prompt AS nl_prompt", "sql_statement AS sql_query"),
        fx.fx_candidates.selectExpr("'item ' || item_id AS nl_prompt", "raw AS sql_query"),
    )


@query("SELECT min(row_idx) AS row_idx, schema_file, question FROM fx_questions GROUP BY schema_file, question")
def question_dedup(fx):
    return first_questions(fx.fx_questions)


@query("""SELECT row_idx, schema_file, question FROM (SELECT *, row_number() OVER (ORDER BY row_idx) - 1 AS pos FROM
  (SELECT min(row_idx) AS row_idx, schema_file, question FROM fx_questions GROUP BY schema_file, question)) WHERE pos >= 5 AND pos < 400""")
def question_slice(fx):
    return K.slice_rows(first_questions(fx.fx_questions), "row_idx", 5, 400)


@query("SELECT question, count(*) AS n FROM fx_questions WHERE question <> '' GROUP BY question HAVING count(*) > 1")
def question_duplicates(fx):
    return P.repeated_questions(fx.fx_questions)


@query("SELECT row_idx, CAST(floor((row_number() OVER (ORDER BY row_idx) - 1) / 16) AS BIGINT) AS chunk FROM fx_questions")
def question_chunks(fx):
    return K.with_chunk(fx.fx_questions.select("row_idx"), "row_idx", 16)


MANIFEST = """
, manifest AS (SELECT path, filename, n_tables, CASE WHEN starts_with(filename, '/') OR path = '' THEN filename
  ELSE path || '/' || filename END AS full_path FROM fx_files WHERE filename <> '')"""


@query(MANIFEST + " SELECT full_path, path, filename FROM manifest")
def manifest_rows(fx):
    return manifest_paths(fx.fx_files).select("full_path", "path", "filename")


@query("SELECT path, filename FROM fx_files WHERE lower(filename) NOT LIKE '%failed%'")
def name_filter(fx):
    return without_failed_names(fx.fx_files).select("path", "filename")


@query(MANIFEST + """ SELECT full_path, regexp_replace(regexp_extract(full_path, '[^/]*$', 0), '\\.[^.]*$', '') AS stem,
  row_number() OVER (ORDER BY full_path) - 1 AS position FROM manifest""")
def ordered_report(fx):
    from sqlloom.functions.text import stem

    paths = manifest_paths(fx.fx_files).select("full_path", stem("full_path").alias("stem"))
    return K.with_position(paths, "full_path")


@query(MANIFEST + " SELECT full_path, CAST(floor((row_number() OVER (ORDER BY full_path) - 1) / 100) AS BIGINT) + 1 AS chunk FROM manifest")
def folder_chunks(fx):
    return K.with_chunk(manifest_paths(fx.fx_files).select("full_path"), "full_path", 100, first=1)


@query("SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0 * count(*) FILTER (WHERE n_tables = 0) / count(*), 9) END::DOUBLE AS empty_percent FROM fx_files")
def empty_share(fx):
    tables = F.when(F.col("n_tables") > 0, F.array_repeat(F.lit("t"), F.col("n_tables").cast("int")))
    return P.empty_table_share(fx.fx_files.select(tables.alias("tables"))).select(F.round("empty_percent", 9).alias("empty_percent"))
