"""Jobs and sinks that write and read back: publication, resumption, totals, repeats over several runs, formats, reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlloom.operators.gates import first_questions
from sqlloom.plans import enrich as E
from sqlloom.plans import synthesis as S
from sqlloom.plans.reports import corpus_profile, question_report
from sqlloom.session import run_folder
from sqlloom.sources import files, jsonl
from sqlloom.sources import sinks as W
from sqlloom.streaming.enrich_stream import stream_enrich
from suite.job_queries import _sql_writer
from suite.registry import query
from suite.rows import CLASSIFIED
from suite.schema_queries import assembled

SHARD_MEGABYTES = 0.5


@query("""SELECT sql_statement, count(*) AS n, TRUE AS fits FROM (SELECT sql_statement FROM fx_triplets
  UNION ALL SELECT 'the same row' FROM fx_triplets WHERE rec_id % 2 = 0) GROUP BY sql_statement""")
def publish_shards(fx):
    """A table, a third of it equal rows, published under a size limit that every shard must keep."""
    path = run_folder(fx.spark, "published")
    triplets = fx.fx_triplets.select("prompt", "sql_statement")
    equal = fx.fx_triplets.where("rec_id % 2 = 0").select(F.repeat(F.lit("equal "), 9).alias("prompt"), F.lit("the same row").alias("sql_statement"))
    W.publish(triplets.unionAll(equal), path, megabytes=SHARD_MEGABYTES)
    fits = W.published(fx.spark, path).agg(F.max("bytes") <= SHARD_MEGABYTES * 1_000_000).first()[0]
    back = fx.spark.read.parquet(f"{path}/train")
    return back.groupBy("sql_statement").agg(F.count(F.lit(1)).alias("n")).withColumn("fits", F.lit(fits))


class Broken(Exception):
    """The caller's check dies."""


def _check_that_dies_once():
    calls = []

    def check(candidates, schemas):
        calls.append(1)
        if len(calls) == 1:
            raise Broken
        return candidates.where("false").select("item_id", "round_no")

    return check


def _never():
    def model(prompts, options):
        if any(p.startswith("You compare") for p in prompts):
            return writer(prompts, options)
        raise AssertionError("asked again")

    writer = _sql_writer()
    return model


@query("""
, items AS (SELECT min(row_idx) AS item_id, schema_file, question FROM fx_questions GROUP BY schema_file, question),
firsts AS (SELECT 'schema_' || schema_id || '.sql' AS schema_file, min(table_name) AS t FROM fx_tables GROUP BY schema_id)
SELECT i.item_id, CASE WHEN t IS NULL THEN 'SELECT 1;' ELSE 'SELECT id FROM ' || t || ' LIMIT 1;' END AS sql_statement
FROM items i LEFT JOIN firsts f ON f.schema_file = i.schema_file""")
def make_sql_resumed(fx):
    """A job that breaks after its candidates; the second run finds them and must not ask for them again."""
    schemas = assembled(fx).selectExpr("'schema_' || schema_id || '.sql' AS schema_file", "schema_sql")
    items = first_questions(fx.fx_questions).withColumnRenamed("row_idx", "item_id")
    more = {"candidates_per_item": 2, "tell_rounds": True, "folder": run_folder(fx.spark, "resumed"), "check": _check_that_dies_once()}
    try:
        S.make_sql(items, schemas, _sql_writer, **more)
    except Broken:
        pass
    return S.make_sql(items, schemas, _never, **more).select("item_id", "sql_statement")


@query(CLASSIFIED + """SELECT question || ' #' || rec_id AS question, query FROM classified
WHERE reason IS NULL AND length(question || ' #' || rec_id) BETWEEN 20 AND 1024""")
def stream_repeats(fx):
    """Two runs from one checkpoint; the second gets the first one's records once more and some new ones."""
    folder = run_folder(fx.spark, "repeats")
    named = fx.fx_triplets.withColumn("prompt", F.concat("prompt", F.lit(" #"), "rec_id"))
    records = named.select("prompt", "sql_statement", "schema", "rec_id")
    for part in (records.where("rec_id % 3 = 0"), records):
        W.write_jsonl(part.drop("rec_id"), f"{folder}/in", mode="append")
        stream_enrich(fx.spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", keep=None).awaitTermination()
    return fx.spark.read.parquet(f"{folder}/out").select("question", "query")


@query(CLASSIFIED + """, judged AS (SELECT coalesce(reason, CASE WHEN length(question) NOT BETWEEN 20 AND 1024 THEN 'Question length' END) AS reason FROM classified)
SELECT n.name, coalesce(k.n, 0) AS n FROM (SELECT unnest(['processed', 'written', 'read back', 'Error generating SQL', 'Only comments present', 'Question length']) AS name) n
LEFT JOIN (SELECT 'processed' AS name, count(*) AS n FROM judged UNION ALL SELECT 'written', count(*) FILTER (WHERE reason IS NULL) FROM judged
  UNION ALL SELECT 'read back', count(*) FILTER (WHERE reason IS NULL) FROM judged UNION ALL SELECT reason, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY reason) k USING (name)""")
def enrich_totals(fx):
    """The numbers that the enrichment job returns, beside what it has written."""
    path = run_folder(fx.spark, "totals")
    told = E.write_enriched(fx.fx_triplets, f"{path}/out", "rec_id", 5, 8)
    back = fx.spark.read.text(f"{path}/out").count()
    rows = [("processed", told["processed"]), ("written", told["written"]), ("read back", back), *told["dropped"].items()]
    return fx.spark.createDataFrame(rows, "name string, n bigint")


@query("SELECT rec_id::VARCHAR AS rec_id, 'a \"' || prompt || '\", b' AS prompt, schema FROM fx_triplets WHERE schema <> ''")
def csv_round_trip(fx):
    """Quotes and separators through the CSV sink and the dispatch on a path's ending."""
    path = f"{run_folder(fx.spark, 'csv')}/triplets.csv"
    W.write_csv(fx.fx_triplets.where("schema <> ''").select("rec_id", F.concat(F.lit('a "'), "prompt", F.lit('", b')).alias("prompt"), "schema"), path)
    return files.load(fx.spark, path)


@query("SELECT rec_id, prompt FROM fx_triplets")
def jsonl_many_files(fx):
    """Several JSON-lines folders read as one dataset."""
    folder = run_folder(fx.spark, "many")
    for n in range(3):
        W.write_jsonl(fx.fx_triplets.where(F.col("rec_id") % 3 == n).select("rec_id", "prompt"), f"{folder}/{n}")
    schema = T.StructType([T.StructField("rec_id", T.LongType()), T.StructField("prompt", T.StringType())])
    return jsonl.read_jsonl(fx.spark, [f"{folder}/{n}" for n in range(3)], schema)


@query("""SELECT line_no, CASE WHEN json_valid(line) THEN line END AS line, CASE WHEN json_valid(line) THEN 'good' ELSE 'malformed' END AS status,
  count(*) FILTER (WHERE NOT json_valid(line)) OVER () AS n_malformed FROM fx_jsonl WHERE line <> ''""")
def jsonl_split(fx):
    """Good and malformed lines, both written by one scan, which also counts them."""
    good, bad, told = jsonl.split_lines(fx.fx_jsonl, f"{run_folder(fx.spark, 'split')}/lines")
    lines = good.select("line_no", "line", F.lit("good").alias("status")).unionByName(bad.select("line_no", F.lit(None).cast("string").alias("line"), F.lit("malformed").alias("status")))
    return lines.withColumn("n_malformed", F.lit(told["malformed"]))


@query("""SELECT replace(schema_file, '.sql', '') AS folder, count(*) AS files, sum(n) AS lines FROM
  (SELECT schema_file, question, count(*) AS n FROM fx_questions GROUP BY ALL) GROUP BY 1""")
def folder_listing(fx):
    """Files by folder: a listing that reads no contents, joined with a scan that counts lines."""
    root = run_folder(fx.spark, "listing")
    named = fx.fx_questions.select(F.replace("schema_file", F.lit(".sql"), F.lit("")).alias("folder"), "question")
    counted = named.groupBy("folder", "question").agg(F.count(F.lit(1)).alias("n"))
    counted.repartition("folder").write.partitionBy("folder").json(root)
    listed = files.list_files(fx.spark, root, recursive=True).where("filename like 'part-%.json'")
    there = listed.select(F.regexp_extract("path", "folder=(.*)$", 1).alias("folder")).distinct()
    back = fx.spark.read.schema("question string, n bigint, folder string").json(root)
    return back.join(there, "folder").groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("lines"))


@query("""SELECT question, count(*) AS n, count(*) > 1 AS repeated FROM (SELECT coalesce(question, '') AS question FROM fx_questions) GROUP BY question""")
def question_reports(fx):
    """Both parts of the question report put together."""
    every, repeated = question_report(fx.fx_questions)
    counted = every.groupBy("question").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(repeated.select("question", F.col("n").alias("_n")), "question", "left").select("question", "n", (F.coalesce("_n", F.lit(0)) > 1).alias("repeated"))


@query("""SELECT x::INT AS num_tables, count(f.n_tables) AS n, (SELECT round(100.0 * count(*) FILTER (WHERE n_tables = 0) / count(*), 9) FROM fx_files)::DOUBLE AS empty_percent
FROM range((SELECT max(n_tables) + 1 FROM fx_files)) r(x) LEFT JOIN fx_files f ON f.n_tables = x GROUP BY x""")
def corpus_profiles(fx):
    """Both parts of the corpus profile put together."""
    tables = F.when(F.col("n_tables") > 0, F.array_repeat(F.lit("t"), F.col("n_tables").cast("int")))
    share, histogram = corpus_profile(fx.fx_files.select(tables.alias("tables")))
    return histogram.withColumn("empty_percent", F.lit(round(share.first()[0], 9)))
