"""Whole jobs with stand-in models: retries, repairs, failures, resumption, streaming."""

import json
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sqlloom.plans import enrich as E
from sqlloom.plans import growth as G
from sqlloom.plans import paraphrase as PP
from sqlloom.plans import questions as Q
from sqlloom.plans import schemas as J
from sqlloom.plans import synthesis as S
from sqlloom.session import run_folder, work_folder, written
from sqlloom.streaming.enrich_stream import stream_enrich

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def model(one):
    return lambda: lambda prompts, options: [one(p) for p in prompts]


def ddl(name, n):
    return "\n".join(f"CREATE TABLE {name}{i} (id INT);" for i in range(n))


def test_work_folder_comes_from_the_session(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_folder(spark, "x") != run_folder(spark, "x")
    table = written(spark.range(3), f"{run_folder(spark, 'x')}/t")
    assert table.count() == 3 and "Range" not in table._jdf.queryExecution().toString()


def test_enrich_does_not_depend_on_partitions(spark):
    rows = [(i, f"Which orders does customer {i} have?", f"SELECT a FROM t{i} JOIN u WHERE b = {i};", "CREATE TABLE t (a INT, b INT);", "SELECT") for i in range(50)]
    rows += [(90, "short", "SELECT a FROM t WHERE b = 1;", "", "SELECT"), (91, "A question that is long enough", "-- nothing", "", "OTHER"),
             (92, "A question that is long enough", "SELECT 1;", "", "SELECT")]
    df = spark.createDataFrame(rows, "id int, prompt string, sql_statement string, schema string, cmd_type string")
    one, many = (E.enrich(df.repartition(n), with_commands=True).orderBy("id").collect() for n in (1, 7))
    assert one == many and len(one) == 50
    assert one[0].token_count.total == sum(one[0].token_count[:3]) and one[0].commands == ["SELECT"]
    assert (one[0].num_joins, one[0].num_tables, one[0].number_of_columns) == (1, 1, 2)
    assert {r.reason: r.n for r in E.skip_counts(df).collect()} == {
        "Error generating SQL": 1, "Only comments present": 1, "Question length": 1}


def test_enrich_is_narrow(spark):
    df = spark.createDataFrame([("p", "s", "x")], "prompt string, sql_statement string, schema string")
    assert "Exchange" not in E.enrich(df)._jdf.queryExecution().executedPlan().toString()


def test_written_enrichment(spark, tmp_path):
    df = spark.createDataFrame([(i, "A question that is long enough", f"SELECT a FROM t WHERE b = {i};") for i in range(30)], "id int, prompt string, sql_statement string")
    E.write_enriched(df, str(tmp_path / "o"), "id", 1, 3)
    rows = [json.loads(line) for p in (tmp_path / "o").glob("*.json") for line in p.read_text().splitlines()]
    assert sorted(r["id"] for r in rows) == list(range(30)) and len(list((tmp_path / "o").glob("*.json"))) == 3


def test_growth_repairs_fails_and_stops(spark):
    seen = {"good": 3, "stubborn": 2, "fixed": 2, "indexes": 2}
    schemas = spark.createDataFrame([(k, ddl(f"{k}_", n)) for k, n in seen.items()] + [("big", ddl("b", 40))], "schema_file string, schema_sql string")

    def one(prompt):
        if "stubborn_" in prompt:
            return "no"
        if "indexes_" in prompt:
            return f"CREATE INDEX i{len(prompt)} ON indexes_0 (id);"
        if "fixed_" in prompt and "did not work" not in prompt and "new_" not in prompt:
            return "```sqlite\nCREATE TABLE fixed_0 (id INT);\n```"  # only a clash: nothing gained
        n = int(re.search(r"(?:exactly|Write the) (\d+) new tables", prompt).group(1))
        have = len(re.findall("CREATE TABLE", prompt))
        return "```sqlite\n" + ddl(f"new_{have}_", n) + "\n```"

    versions = G.grow_schemas(schemas, model(one), mode=20, max_tables=30, retries=2, seed=3)
    last = {r.schema_file: r for r in G.final_schemas(versions).collect()}
    assert last["good"].status == last["fixed"].status == last["big"].status == "done"
    assert last["good"].num_tables == max(3, last["good"].target) and last["big"].num_tables == 40
    # Answers without a new table use up the attempts.
    assert last["stubborn"].status == last["indexes"].status == "failed"
    assert last["stubborn"].last_error == last["indexes"].last_error == G.NO_GAIN and last["stubborn"].attempt == last["indexes"].attempt == 3
    assert last["good"].schema_sql.startswith(ddl("good_", 3)) and len(re.findall("CREATE TABLE", last["good"].schema_sql)) == last["good"].num_tables
    text = {r.schema_file: r.text for r in G.quarantined_schemas(versions).collect()}
    assert set(text) == {"stubborn", "indexes"} and text["stubborn"].startswith("-- Execution failed: ")


def test_growth_has_no_limit_of_rounds(spark):
    def one(prompt):
        have = len(re.findall("CREATE TABLE", prompt))
        return f"CREATE TABLE one_more_{have} (id INT);"

    grown = G.final_schemas(G.grow_schemas(spark.createDataFrame([("s", ddl("s", 1))], "schema_file string, schema_sql string"), model(one), mode=60, max_tables=62, seed=1))
    row = grown.first()
    assert row.status == "done" and row.num_tables == row.target > 40


def test_growth_takes_the_caller_s_gate(spark):
    from sqlloom.operators.gates import additions_without_conflicts

    def gate(states, old, new):
        return additions_without_conflicts(states, old, new).withColumn("old_error", F.when(F.col("schema_file") == "bad", F.lit("does not load")))

    schemas = spark.createDataFrame([("bad", "CREATE TABLE ("), ("good", ddl("g", 2))], "schema_file string, schema_sql string")
    grown = G.grow_schemas(schemas, model(lambda p: "nothing"), mode=20, max_tables=30, retries=1, gate=gate)
    assert {r.schema_file: r.last_error for r in G.final_schemas(grown).collect()} == {"bad": "does not load", "good": G.NO_GAIN}


def test_questions_retry_only_what_is_open(spark):
    schemas = spark.createDataFrame([(f"s{i}", ddl(f"t{i}_", 2)) for i in range(12)], "schema_file string, schema_sql string")
    examples = spark.createDataFrame([("how many?", 0), ("which?", 3)], "nl_prompt string, num_joins int")

    def one(prompt):
        if "t1_0" in prompt:
            raise RuntimeError("down")
        if "t2_0" in prompt and "retry 2" not in prompt:
            return ""
        return "```plaintext\n1. One?\n2. Two?\n3. Three?\n```"

    made = Q.make_questions(schemas, examples, model(one), "m", per_schema=2, retries=2, batch_size=1)
    got = made.groupBy("schema_file").count().collect()
    assert {r.schema_file: r["count"] for r in got} == {f"s{i}": 2 for i in range(12) if i != 1}
    row = Q.with_schema_text(made, schemas).where("schema_file = 's2'").orderBy("line_no").first()
    assert row.question == "One?" and row.schema_sql.startswith("CREATE TABLE t2_0") and row.generation_model == "m"
    assert row.timestamp is not None and row.source == "semi-synthetic"


def test_a_grown_input_is_asked_for_what_is_new(spark):
    def schemas(n):
        return spark.createDataFrame([(f"s{i}", ddl(f"t{i}_", 2)) for i in range(n)], "schema_file string, schema_sql string")

    examples = spark.createDataFrame([("how many?", 0)], "nl_prompt string, num_joins int")
    folder = run_folder(spark, "again")

    def only(*wanted):
        def one(prompt):
            assert any(f"t{i}_0" in prompt for i in wanted), "the model must not be asked again"
            return "One?\nTwo?"
        return one

    def ask(n, one, **more):
        return {tuple(r)[:3] for r in Q.make_questions(schemas(n), examples, model(one), "m", retries=1, folder=folder, batch_size=1, **more).collect()}

    first = ask(4, only(0, 1, 2, 3))
    assert ask(4, only()) == first and len(first) == 8
    more = ask(6, only(4, 5))
    assert len(more) == 12 and first <= more
    with pytest.raises(ValueError, match="other parameters"):
        ask(4, only(), seed=7)


def test_growth_replays_its_answers(spark):
    schemas = spark.createDataFrame([(f"s{i}", ddl(f"s{i}_", 2)) for i in range(5)], "schema_file string, schema_sql string")
    folder = run_folder(spark, "again")

    def one(prompt):
        n = int(re.search(r"exactly (\d+) new tables", prompt).group(1))
        return ddl(f"new_{len(re.findall('CREATE TABLE', prompt))}_", n)

    def never(prompt):
        raise AssertionError("asked again")

    first, again = (G.final_schemas(G.grow_schemas(schemas, model(m), mode=30, max_tables=40, folder=folder, slices=2)).collect() for m in (one, never))
    assert sorted(first) == sorted(again) and all(r.status == "done" for r in again)


def test_a_crash_after_some_slices_loses_only_the_rest(spark):
    from sqlloom.operators.inference import answered, stored_answers

    asked = written(spark.range(400).select("id", F.concat(F.lit("p"), "id").alias("prompt")), f"{run_folder(spark, 'asked')}/t")
    folder = run_folder(spark, "crash")

    def breaks():
        raise RuntimeError("this task dies")

    answered(asked.where("pmod(xxhash64(id), 4) < 2"), model(str.upper), ["id"], folder, slices=4)
    done = stored_answers(spark, folder).count()
    with pytest.raises(Exception, match="this task dies"):
        answered(asked, breaks, ["id"], folder, slices=4)
    assert stored_answers(spark, folder).count() == done
    seen = spark.sparkContext.accumulator(0)

    def counting():
        def model_(prompts, options):
            seen.add(len(prompts))
            return [p.upper() for p in prompts]
        return model_

    got = answered(asked, counting, ["id"], folder, slices=4)
    assert got.where("response = upper(concat('p', id))").count() == got.count() == 400
    assert seen.value == 400 - done and 0 < done < 400
    # A changed prompt is another question.
    changed = answered(asked.withColumn("prompt", F.concat("prompt", F.lit("!"))), model(str.upper), ["id"], folder)
    assert changed.where("response like '%!'").count() == changed.count() == 400


def test_sql_candidates_gate_and_vote(spark):
    schemas = spark.createDataFrame([("s", "CREATE TABLE t (id INT);"), ("e", "CREATE TABLE e (id INT);")], "schema_file string, schema_sql string")
    items = spark.createDataFrame([(1, "s", "count\nall"), (2, "s", "broken"), (3, "e", "pick")], "item_id long, schema_file string, question string")

    def generate(prompt):
        if "broken" in prompt:
            return "```sql\nSELECT gone FROM t\n```"
        return "```sql\nSELECT count(*) FROM " + ("e" if "e(id:INT)" in prompt else "t") + "\n```"

    def judge(prompt):
        return "the first"

    def check(candidates, schemas):
        return candidates.where("sql like '%gone%'").select("item_id", "round_no")

    folder = run_folder(spark, "sql")
    ask = lambda items, one, **more: S.make_sql(items, schemas, model(one), candidates_per_item=3, make_judge=model(judge), **more)
    made = ask(items, generate, check=check)
    got = {r.item_id: (r.prompt, r.sql_statement, r.cmd_type) for r in made.collect()}
    assert got == {1: ("count all", "SELECT count(*) FROM t;", "SELECT"), 2: ("broken", "SELECT 1;", "SELECT"), 3: ("pick", "SELECT count(*) FROM e;", "SELECT")}
    assert S.with_flat_schema(made, schemas).where("item_id = 3").first().schema == "CREATE TABLE e (id INT);"
    # Without a check the candidate stays; an old folder doesn't hide a new item.
    assert {r.item_id for r in ask(items.where("item_id = 1"), generate, folder=folder).collect()} == {1}
    grown = {r.item_id: r.sql_statement for r in ask(items, generate, folder=folder).collect()}
    assert grown == {1: "SELECT count(*) FROM t;", 2: "SELECT gone FROM t;", 3: "SELECT count(*) FROM e;"}


def test_jobs_shuffle_no_text_before_the_first_round(spark):
    from sqlloom.operators.inference import answered

    asked = spark.range(10).select("id", F.lit("p").alias("prompt"))
    plan = answered(asked, model(str.upper), ["id"], run_folder(spark, "plan"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_paraphrases(spark):
    rows = [(1, "How many  orders are there?", "SELECT count(*) FROM o;", (9, 8, 7, 24)), (2, "", "SELECT 1", None), (3, "Name all the parts", "SELECT p FROM q;", None)]
    records = spark.createDataFrame(rows, "id int, question string, query string, token_count struct<question:int,query:int,schema:int,total:int>").withColumn("schema", F.lit("a b"))

    def one(prompt):
        if "parts" in prompt and "retry 1" not in prompt:
            return "Paraphrase 1"
        q = prompt.split("Question:\n")[1].split("\n")[0]
        return f"```plaintext\n1. {q.upper()}\n2. Count the orders\n3) count  THE orders\n4. Orders: how many?\n5. More\n```"

    made = PP.make_paraphrases(records, "id", model(one), "m", n=2, retries=1)
    got = sorted((r.id, r.augmentation_type is not None, r.question) for r in made.collect())
    assert got == [(1, False, "How many  orders are there?"), (1, True, "Count the orders"), (1, True, "Orders: how many?"), (2, False, ""),
                   (3, False, "Name all the parts"), (3, True, "Count the orders"), (3, True, "Orders: how many?")]
    new = made.where("id = 1 and question = 'Count the orders'").first()
    assert tuple(new.token_count) == (3, 8, 7, 18) and new.augmentation_of == "How many  orders are there?" and new.paraphrase_model == "m"
    fresh = made.where("id = 3 and question = 'Count the orders'").first()
    assert tuple(fresh.token_count) == (3, 4, 2, 9)
    only = PP.make_paraphrases(records, "id", model(one), "m", n=2, retries=1, skip_original=True)
    assert only.count() == 4


def test_fit_and_strip(spark):
    rows = [(f"s{i}.sql", ddl("t", i % 5) + " x INT REFERENCES y (id)" * (i % 2)) for i in range(60)] + [("x.failed.sql", ddl("t", 2))]
    schemas = spark.createDataFrame(rows, "schema_file string, schema_sql string")
    counts = J.table_counts(schemas)
    decided = J.fit_distribution(counts, mode=2, max_tables=3, seed=1)
    assert counts.count() == decided.count() == 60 and decided.where("action = 'OVER_MAX'").count() == 12
    targets = J.fit_targets(counts, 2, 3)
    report = {r.num_tables: r for r in J.fit_report(decided, targets).collect()}
    assert all(r.kept == min(r.observed, r.target) and r.kept + r.skipped + r.over_max == r.observed for r in report.values())
    assert J.apply_decisions(schemas, decided).count() == sum(r.kept for r in report.values())
    flags, share = J.foreign_key_profile(schemas.where("schema_file not like '%failed%'"))
    assert tuple(share.first())[:3] == (60, 30, 30) and flags.count() == 60
    stripped = J.stripped_schemas(schemas, spark.createDataFrame([("s1",)], "prefix string"))
    assert {r.schema_file: r.changed for r in stripped.collect()} == {f"s{i}.sql": bool(i % 2) for i in [1, *range(10, 20)]}


def test_stream_enriches_new_files_once(spark, tmp_path):
    def line(n):
        return json.dumps({"prompt": f"Which orders does customer {n} have?", "sql_statement": f"SELECT a FROM t WHERE b = {n};", "schema": "CREATE TABLE t (a INT);"}) + "\n"

    source = tmp_path / "in"
    source.mkdir()
    (source / "1.jsonl").write_text(line(1) + line(1) + "broken\n" + line(2))
    args = (spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"))
    stream_enrich(*args).awaitTermination()
    (source / "2.jsonl").write_text(line(2) + line(3))
    stream_enrich(*args).awaitTermination()
    stream_enrich(*args).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.question for r in out.collect()) == [f"Which orders does customer {n} have?" for n in (1, 2, 3)]
    assert out.first().number_of_columns == 1


def test_a_job_goes_on_behind_its_last_finished_step(spark, monkeypatch):
    from sqlloom import session

    schemas = spark.createDataFrame([(f"s{i}", ddl(f"t{i}_", 2)) for i in range(4)], "schema_file string, schema_sql string")
    examples = spark.createDataFrame([("how many?", n) for n in range(11)], "nl_prompt string, num_joins int")
    runs = []

    class Counted(session.Steps):
        limit = None

        def __init__(self, *args, **settings):
            super().__init__(*args, **settings)
            runs.append(self)

        def table(self, name, build):
            if self.limit is not None and len(self.made) == self.limit:
                raise KeyboardInterrupt
            return super().table(name, build)

    monkeypatch.setattr(Q, "Steps", Counted)

    def one(prompt):
        return "One?" if "could not be read" in prompt or "t1_0" in prompt else "<First Question>"

    def ask(folder, **more):
        return {(r.schema_file, r.line_no, r.question) for r in Q.make_questions(schemas, examples, model(one), "m", retries=1, folder=folder, **more).collect()}

    whole = ask(run_folder(spark, "whole"))
    every = runs[-1].made
    assert len(every) == 6 and not runs[-1].found and len(whole) == 4
    for n in range(1, len(every)):
        folder = run_folder(spark, "broken")
        Counted.limit = n
        with pytest.raises(KeyboardInterrupt):
            ask(folder)
        Counted.limit = None
        assert ask(folder) == whole
        assert runs[-1].found == every[:n] and runs[-1].made == every[n:]
    # Other settings have steps of their own.
    assert len(ask(folder, per_schema=1)) == 4 and runs[-1].made == every


def test_growth_writes_what_it_adds(spark, tmp_path):
    def one(prompt):
        n = int(re.search(r"exactly (\d+) new tables", prompt).group(1))
        return ddl(f"new_{len(re.findall('CREATE TABLE', prompt))}_", n) + " CREATE INDEX i1 ON s0 (id);"

    schemas = spark.createDataFrame([("s", ddl("s", 2) + " -- " + "long " * 2000)], "schema_file string, schema_sql string")
    log = G.growth_log(schemas, model(one), mode=60, max_tables=62, seed=1, steps_path=str(tmp_path / "steps"))
    rows = log.orderBy("round_no").collect()
    assert len(rows) > 2 and len(rows[0].added) > 10_000 and all(len(r.added) < 3_000 for r in rows[1:])
    stored = G.versions(spark.read.parquet(str(tmp_path / "steps"))).orderBy("round_no").collect()
    whole = G.versions(log).orderBy("round_no").collect()
    assert [r.schema_sql for r in stored] == [r.schema_sql for r in whole]
    assert all(a.schema_sql.rstrip() in b.schema_sql for a, b in zip(whole, whole[1:]))
    assert whole[-1].schema_sql.count("CREATE TABLE") == whole[-1].num_tables >= whole[-1].target and whole[-1].schema_sql.count("CREATE INDEX") == 1
    names = G.names_of(log, log.select("schema_file").distinct()).first()
    assert len(names.names) == whole[-1].num_tables and names.indexes == ["i1"]


def test_totals_of_the_enrichment(spark, tmp_path):
    rows = [(1, "How many orders are there?", "SELECT a FROM t WHERE b = 3;"), (2, "How many orders are there?", "SELECT 1;"), (3, "How many orders are there?", "-- nothing"), (4, "Short", "SELECT a FROM t WHERE b = 3;")]
    df = spark.createDataFrame(rows, "id int, question string, query string").repartition(3)
    told = E.write_enriched(df, str(tmp_path / "out"), "id", 1, 2)
    assert told == {"processed": 4, "written": 1, "dropped": {"Error generating SQL": 1, "Only comments present": 1, "Question length": 1}}
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["id"] == 1
    assert E.write_enriched(df.where("false"), str(tmp_path / "none"), "id", 1, 2)["processed"] == 0


def test_a_stream_without_end_of_memory_takes_each_record_once(spark, tmp_path):
    def line(n):
        return json.dumps({"prompt": f"Which orders does customer {n} have?", "sql_statement": "SELECT a FROM t WHERE b = 3;", "schema": "s"}) + "\n"

    (tmp_path / "in").mkdir()
    for run, numbers in enumerate(([1, 2, 2], [2, 3], [1, 3, 4])):
        (tmp_path / "in" / f"{run}.jsonl").write_text("".join(map(line, numbers)))
        stream_enrich(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), keep=None).awaitTermination()
    assert sorted(r.question for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"Which orders does customer {n} have?" for n in (1, 2, 3, 4)]

