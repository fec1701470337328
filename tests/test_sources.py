"""Readers and writers, each written to a temporary folder, read back and compared."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlloom.sources import files as S
from sqlloom.sources import jsonl as L
from sqlloom.sources import sinks as W

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_jsonl_drops_blank_and_malformed_lines(spark, tmp_path):
    text = '{"a": 1, "b": "é"}\n\n  \n{"a": 2\n[1]\n{"a": 3, "extra": 1}\n"x"\n{"a": 4} tail\n'
    (tmp_path / "x.jsonl").write_text(text, encoding="utf-8")
    got = L.read_jsonl(spark, str(tmp_path / "x.jsonl"), SCHEMA)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "é"), (3, None)]
    lines = L.numbered_lines(spark, str(tmp_path / "x.jsonl"))
    assert sorted((r.line_no, r.line) for r in L.malformed_lines(lines).collect()) == [(3, '{"a": 2'), (4, "[1]"), (6, '"x"'), (7, '{"a": 4} tail')]
    assert sorted(r.line_no for r in L.line_slice(lines, "line_no", 1, 6).collect()) == [5]
    assert sorted(r.line_no for r in L.line_slice(lines, "line_no", 0).collect()) == [0, 5]


def test_physical_line_numbers_over_several_blocks(spark, tmp_path):
    for name, n in (("p", 4000), ("q", 37)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{name}{i:05d}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        lines = L.numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() >= 1 and lines.select("file").distinct().count() == 2
        wrong = lines.where(F.substring("line", 2, 5).cast("int") != F.col("line_no"))
        assert lines.count() == 4037 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_schema_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.sql").write_bytes(b"CREATE \xff\xfeTABLE t (x INT);")
    (tmp_path / "a_3.FAILED.sql").write_text("x")
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "sub" / "b.sql").write_text("é")
    flat = {r.schema_file: r.schema_sql for r in S.read_schemas(spark, str(tmp_path), skip_failed=True).collect()}
    assert flat == {"a.sql": "CREATE TABLE t (x INT);"}
    deep = {r.schema_file for r in S.read_schemas(spark, str(tmp_path), recursive=True, skip_failed=False).collect()}
    assert deep == {"a.sql", "a_3.FAILED.sql", "b.sql"}
    listed = {(r.path.split(":")[-1].replace("//", "/"), r.filename) for r in S.list_files(spark, str(tmp_path), recursive=True).collect()}
    assert {n for _, n in listed} == {"a.sql", "a_3.FAILED.sql", "note.txt", "b.sql"}
    assert any(p.endswith("/sub") and n == "b.sql" for p, n in listed)


def test_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Path,FileName\nd,a.sql\nd/,b.sql\n,c.sql\nd,/abs/e.sql\nd,\n , f.sql \n")
    rows = S.read_manifest(spark, str(tmp_path / "m.csv"))
    assert sorted(r.full_path for r in rows.collect()) == ["/abs/e.sql", "c.sql", "d/a.sql", "d/b.sql", "f.sql"]
    (tmp_path / "plain.csv").write_text("x/a.sql\n\n b.sql \n")
    assert sorted(r.full_path for r in S.read_manifest(spark, str(tmp_path / "plain.csv")).collect()) == ["b.sql", "x/a.sql"]
    have, missing = S.split_by_existence(rows, spark.createDataFrame([("c.sql",)], "full_path string"))
    assert [r.full_path for r in have.collect()] == ["c.sql"] and missing.count() == 4


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    rows = [('say "hi",\nthere', "1"), ("plain", "2")]
    df = spark.createDataFrame(rows, "nl_prompt string, num_joins string")
    W.write_csv(df, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in S.read_csv(spark, str(tmp_path / "c"), line_breaks=True).collect()) == sorted(rows)


def test_load_dispatch(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "ds" / "test"))
    spark.range(5).write.parquet(str(tmp_path / "ds" / "train"))
    assert S.load(spark, str(tmp_path / "ds")).count() == 5
    df.write.json(str(tmp_path / "x.jsonl"))
    assert S.load(spark, str(tmp_path / "x.jsonl")).count() == 3
    df.write.option("header", True).csv(str(tmp_path / "y.csv"))
    assert S.load(spark, str(tmp_path / "y.csv")).columns == ["id"]
    with pytest.raises(ValueError):
        S.load(spark, "hf://some/set")


def test_document(spark, tmp_path):
    from sqlloom.operators.profiles import empty_table_share

    document = {"files": [{"tables": ["a"]}, {"tables": []}, {}, {"tables": ["b", "c"]}]}
    (tmp_path / "d.json").write_text(json.dumps(document, indent=1))
    for source in (document, json.dumps(document), str(tmp_path / "d.json")):
        assert empty_table_share(S.read_document(spark, source)).first()[0] == 50.0
    assert empty_table_share(S.read_document(spark, {"files": []})).first()[0] == 0.0


def test_records(spark, tmp_path):
    record = {"TABLES": [{"TABLE_NAME": "t", "COLUMNS": [{"NAME": "x", "TYPE": "INT"}]}]}
    (tmp_path / "r.jsonl").write_text(json.dumps(record) + "\n" + '{"TABLES": []}\n')
    from sqlloom.operators.catalog import exploded_tables

    rows = S.read_records(spark, str(tmp_path / "r.jsonl")).withColumn("k", F.size("TABLES"))
    got = {r.k: (r.table_no, r.table) for r in exploded_tables(rows, "k").collect()}
    assert got[1][1].TABLE_NAME == "t" and got[0] == (None, None)


def test_jsonl_sink_keeps_nulls_and_accents(spark, tmp_path):
    W.write_jsonl(spark.createDataFrame([("é", None)], "a string, b string").coalesce(1), str(tmp_path / "o"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "o").glob("*.json"))
    assert text == '{"a":"é","b":null}\n'


def test_chunks_and_publish(spark, tmp_path):
    df = spark.range(25).select(F.format_string("f%02d.sql", "id").alias("name"))
    W.write_chunks(df, "name", 10, str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "c")).groupBy("chunk").agg(F.count("name").alias("n"), F.min("name").alias("m")).orderBy("chunk").collect()
    assert [tuple(r) for r in got] == [(1, 10, "f00.sql"), (2, 10, "f10.sql"), (3, 5, "f20.sql")]
    told = W.publish(df.coalesce(1), str(tmp_path / "p"), "train", files=3)
    assert told == {"rows": 25, "columns": ["name"]}
    assert len(list((tmp_path / "p" / "train").glob("*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "p" / "train")).count() == 25


def test_several_files_are_one_dataset(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text('{"a": 1, "b": "x"}\n' * 2)
    assert L.read_jsonl(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")], SCHEMA).count() == 4


def test_quarantine_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s", "x", "bad"), ("t", "y", None)], "k string, ddl string, err string")
    got = rows.select("k", W.quarantine_text("ddl", "err").alias("text")).orderBy("k").collect()
    assert [r.text for r in got] == ["-- Execution failed: bad\nx\n", "-- Execution failed: \ny\n"]
    W.write_quarantine(rows.fillna("none"), str(tmp_path / "q"), "err")
    assert {r.err for r in spark.read.parquet(str(tmp_path / "q")).collect()} == {"bad", "none"}
    steps = spark.createDataFrame([(0, "a", 1, "x"), (1, "a", 2, "y")], "round_no int, schema_file string, num_tables int, added string")
    W.write_growth_steps(steps, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).where("round_no = 1").first().added == "y"


def test_totals_come_from_the_write(spark, tmp_path):
    out, seen = W.watched(spark.range(10), large=F.count_if(F.col("id") > 6))
    out.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 10, "large": 3}


def test_reports(spark):
    from sqlloom.plans.reports import corpus_profile, question_report

    records = spark.createDataFrame([("a",), ("a",), ("",), ("",), ("b",), (None,)], "question string")
    every, repeated = question_report(records)
    assert every.count() == 6 and [tuple(r) for r in repeated.collect()] == [("a", 2)]
    share, histogram = corpus_profile(spark.createDataFrame([([],), (None,), (["t", "u"],), (["v", "w"],)], "tables array<string>"))
    assert share.first()[0] == 50.0 and {r.num_tables: r.n for r in histogram.collect()} == {0: 2, 1: 0, 2: 2}


def test_json_objects_stand_alone(ev):
    good = ['{"a": 1}', "{}", '{"a": {"b": [1, "]}"]}}', '{"a": 1, "a": 2}']
    bad = ['{"a": 1} tail', '{"a": 1}{"a": 2}', '{"a": 1},{"a": 2}', '{"a": 1}]', '{"a": 1}] {"b": 2}', '{"a": 1}}', '{"a": 1}, "b": {}', '{"a": 1', "[1]", "1", '"x"', "", None]
    assert ev(L.is_json_object, *good, *bad) == [True] * len(good) + [False] * len(bad)


def test_other_fields_of_json_lines_stay(spark, tmp_path):
    lines = ['{"a": 1, "b": "x", "c": [1, {"d": null}], "e": 1.50}', '{"a": 2}', '{"a": 3, "z": "ü"} tail', '{"a": "no number"}', ""]
    (tmp_path / "x.jsonl").write_text("\n".join(lines), encoding="utf-8")
    schema = T.StructType([T.StructField("a", T.LongType())])
    got = L.read_jsonl(spark, str(tmp_path / "x.jsonl"), schema, rest="rest")
    assert {r.a: r.rest and json.loads(r.rest) for r in got.collect()} == {1: {"b": "x", "c": [1, {"d": None}], "e": 1.5}, 2: None}
    whole = sorted(r.line for r in L.whole_lines(got.withColumn("n", F.lit(None).cast("int")), "rest").collect())
    assert [json.loads(x) for x in whole] == [{"a": 1, "n": None, "b": "x", "c": [1, {"d": None}], "e": 1.5}, {"a": 2, "n": None}]


def test_records_from_files_have_keys_and_typed_defaults(spark, tmp_path):
    from sqlloom.plans.schemas import render_records

    def record(*columns):
        return json.dumps({"TABLES": [{"TABLE_NAME": "t", "COLUMNS": list(columns), "PRIMARY_KEY": ["a"], "FOREIGN_KEYS": []}]})

    column = {"NAME": "a", "TYPE": "INT", "NULLABLE": True, "UNIQUE": False}
    rows = [record({**column, "DEFAULT": 5}), record({**column, "DEFAULT": "5"}), "", record({**column, "NULLABLE": None, "DEFAULT": None}), record({**column, "DEFAULT": "it's"})]
    (tmp_path / "r.jsonl").write_text("\n".join(rows))
    found = S.read_records(spark, str(tmp_path / "r.jsonl"))
    got = {r.record_no: r.schema_sql for r in render_records(found, "record_no").collect()}
    text = "CREATE TABLE t (\n  a INT{},\n  PRIMARY KEY (a)\n);"
    assert got == {0: text.format(" DEFAULT 5"), 1: text.format(" DEFAULT '5'"), 3: text.format(" NOT NULL"), 4: text.format(" DEFAULT 'its'")}
    found.write.parquet(str(tmp_path / "r.parquet"))
    again = S.read_records(spark, str(tmp_path / "r.parquet"))
    assert sorted(r.record_no for r in again.collect()) == [0, 1, 2, 3]
    assert sorted(r.schema_sql for r in render_records(again, "record_no").collect()) == sorted(got.values())


def test_no_shard_is_larger_than_wanted(spark, tmp_path):
    wide = F.when(F.col("id") % 50 == 0, F.repeat(F.lit("x"), 3000)).otherwise(F.lit("y"))
    df = spark.range(2000).select("id", wide.alias("text"))
    told = W.publish(df, str(tmp_path / "p"), megabytes=0.02)
    assert told == {"rows": 2000, "columns": ["id", "text"]}
    back = spark.read.parquet(str(tmp_path / "p" / "train"))
    sizes = [r[1] for r in back.groupBy("shard").agg(F.sum(F.octet_length(F.to_json(F.struct("id", "text"))))).collect()]
    assert back.count() == 2000 and max(sizes) <= 20_000 and len(sizes) >= sum(sizes) / 20_000
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "p" / "train").glob("shard=*"))
    assert back.drop("shard").exceptAll(df).count() == 0


def test_publish_keeps_the_limit_with_a_third_of_equal_rows(spark, tmp_path):
    different = spark.range(3000).select(F.concat(F.lit("row "), "id", F.repeat(F.lit("x"), F.pmod("id", F.lit(40)).cast("int"))).alias("text"))
    df = different.unionAll(spark.range(1500).select(F.lit("the same " * 9).alias("text"))).unionAll(spark.range(1).select(F.lit(None).cast("string")))
    df = df.withColumns({"_cell": F.lit("own"), "_bytes": F.lit(1)}).repartition(5)
    told = W.publish(df, str(tmp_path / "p"), megabytes=0.01)
    assert told == {"rows": 4501, "columns": ["text", "_cell", "_bytes"]}
    shards = W.published(spark, str(tmp_path / "p")).collect()
    total = sum(r.bytes for r in shards)
    assert sum(r.rows for r in shards) == 4501 and max(r.bytes for r in shards) <= 10_000 and len(shards) <= 2 * total / 10_000
    assert spark.read.parquet(str(tmp_path / "p" / "train")).drop("shard").exceptAll(df).count() == 0


def test_publish_of_one_large_row_and_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b" * 5000,), ("c",)], "text string")
    W.publish(df, str(tmp_path / "p"), megabytes=0.001)
    assert sorted(r.rows for r in W.published(spark, str(tmp_path / "p")).collect()) in ([1, 1, 1], [1, 2])
    assert W.publish(df.where("false"), str(tmp_path / "q"), megabytes=1)["rows"] == 0


def test_one_scan_splits_good_and_malformed_lines(spark, tmp_path):
    lines = spark.createDataFrame([(n, x) for n, x in enumerate(['{"a": 1}', "", " broken ", None, '{"a": 2} tail', ' {"b": []} '])], "line_no int, line string")
    good, bad, told = L.split_lines(lines, str(tmp_path / "split"))
    assert told == {"good": 2, "malformed": 2}
    assert sorted(r.line_no for r in good.collect()) == [0, 5] and good.columns == lines.columns
    assert sorted((r.line_no, r.line, r.error) for r in bad.collect()) == [(2, "broken", "not a JSON object"), (4, '{"a": 2} tail', "not a JSON object")]
    assert L.split_lines(lines.where("false"), str(tmp_path / "none"))[2] == {"good": 0, "malformed": 0}

