"""Text functions: fixed examples for every branch, and random texts against character loops."""

import random

from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.functions import responses as R
from sqlloom.functions import sqltext as S
from sqlloom.functions import text as T
from sqlloom.operators import gates as G


def random_texts(alphabet, n=400, longest=40, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


# --- plain text


def test_strip_is_python_strip(ev):
    texts = [" a ", " b ", "\x1cc\x1f", "", " \n\t", "d"] + random_texts(" \n\t x\x1d")
    assert ev(T.strip, *texts) == [t.strip() for t in texts]


def test_normalize_and_flatten(ev):
    texts = ["  A  B\n\nc ", "x\r\ny", "", "a b", "one\x0btwo"]
    assert ev(T.normalize, *texts) == [" ".join(t.lower().split()) for t in texts]
    assert ev(T.flatten, *texts) == [" ".join(t.splitlines()).strip() for t in texts]


def test_unix_lines_is_splitlines(ev):
    texts = ["a\nb\n", "a\r\nb", "a\n\n", "\n", "", "a\rb\x85c", "x\r\n"] + random_texts("a\n\r\x0c\x1e")
    assert ev(T.unix_lines, *texts) == ["\n".join(t.splitlines()) for t in texts]


def test_stem_and_basename(ev):
    assert ev(T.stem, "a/b.tar.gz", ".x", "/abs/n", "s.sql", "a.b/c") == ["b.tar", ".x", "n", "s", "c"]
    assert ev(T.basename, "a/b.sql", "c.sql") == ["b.sql", "c.sql"]


def test_token_count(ev):
    assert ev(T.token_count, "SELECT a.b, c >= 1", "", None, "a\\b-c d", "éa") == [5, 0, 0, 2, 1]


def test_keyed_uniform_is_in_range_and_repeatable(spark):
    df = spark.range(2000).select(T.keyed_uniform(1, "id").alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.03
    assert df.collect() == df.collect()


# --- SQL text


def test_statement_kind(ev):
    assert ev(S.statement_kind, " select 1", "WITH a", "Update t", None, "", "dropx") == [
        "SELECT", "OTHER", "UPDATE", "OTHER", "OTHER", "DROP"]


def test_commands_and_joins(ev):
    sql = "with c as (select 1) select * from a join b union select 2; joined"
    assert ev(S.commands, sql, None) == [["WITH", "SELECT", "UNION"], []]
    assert ev(S.join_count, sql, "left JOIN x 'join'", None) == [1, 2, 0]


def test_clean_flat_comments(ev):
    assert ev(S.clean_flat_comments, "SELECT x -- pick x FROM t;", "-- only", "a -- b; c", "SELECT 1 -- a -- b WHERE") == [
        "SELECT x FROM t;", "", "a ; c", "SELECT 1"]


def cut_quoted(line):
    quote = None
    for i, ch in enumerate(line):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif line[i:i + 2] == "--":
            return line[:i]
    return line


def test_strip_comments(ev):
    assert ev(S.strip_comments_naive, "a /* x\ny */ b -- c\n'--' d\n") == ["a  b \n'"]
    assert ev(S.strip_comments_quoted, "a '--' -- c\n'open -- x") == ["a '--' \n'open -- x"]
    texts = random_texts("a-'\"\n ")
    assert ev(S.strip_comments_quoted, *texts) == ["\n".join(cut_quoted(s) for s in t.splitlines()) for t in texts]


def test_long_texts_do_not_overflow(ev):
    long = "a 'b;c' -- x\n" * 20_000
    assert len(ev(S.strip_comments_quoted, long)[0]) > 100_000
    assert ev(S.statement_count, "a'b;c'" * 20_000 + ";x") == [2]
    assert ev(lambda c: F.size(D.split_top_level(c)), "a(b,c), " * 3000) == [3001]


def split_statements(sql):
    parts, part, quote = [], "", None
    for ch in sql:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        if ch == ";" and quote is None:
            parts.append(part)
            part = ""
        else:
            part += ch
    return parts + [part] if part else parts


def test_split_statements(ev):
    texts = ["a;b", "a;", "", ";;", "a 'x;y'; \"q;\" ; z 'open ; "] + random_texts("a;'\" \n")
    expected = [split_statements(t) for t in texts]
    assert ev(S.split_statements, *texts) == expected
    assert ev(S.is_single_statement, *texts) == [sum(bool(p.strip()) for p in e) == 1 for e in expected]


def test_normal_forms(ev):
    assert ev(S.normalize_sql, " SELECT  1 ;\n", "a;;", "X\ty") == ["select 1 ", "a;", "x y"]
    assert ev(S.with_semicolon, " a ", "b; ") == ["a;", "b;"]
    assert ev(S.loose_form, "a;\n ;", "b") == ["a", "b"]


def test_identifiers_and_preview(ev):
    assert ev(S.quote_identifier, "id", "order", 'a"b', "2x", "Group") == ["id", '"order"', '"a""b"', "2x", '"Group"']
    preview = lambda c: S.preview_select(c, F.array(F.lit("a"), F.lit("from")), 5)
    assert ev(preview, "t x") == ['SELECT a, "from" FROM "t x" LIMIT 5;']
    assert ev(lambda c: S.preview_select(c, F.array().cast("array<string>")), "t") == ["SELECT * FROM t LIMIT 20;"]


def test_clean_dialect(ev):
    assert ev(S.clean_dialect, "CREATE DATABASE d; create schema s CREATE TABLE `t` (a INT);") == [
        '  CREATE TABLE "t" (a INT);']


# --- DDL text


def split_commas(text):
    parts, part, depth, quote = [], "", 0, None
    for ch in text:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth = max(0, depth - 1)
        if ch == "," and depth == 0 and quote is None:
            parts.append(part.strip())
            part = ""
        else:
            part += ch
    return parts + [part.strip()] if part else parts


def test_split_top_level(ev):
    texts = ["a, b(c,d), 'x,y' z, ", "a,,b", "q 'open, x", "", ")a,b(", "f((a,b),c),d"] + random_texts("a,()'\"` ")
    assert ev(D.split_top_level, *texts) == [split_commas(t) for t in texts]


def test_counts(ev):
    ddl = "CREATE TABLE a (x INT); CREATE TEMPORARY TABLE b (x INT); CREATE TEMP TABLE c (x INT); -- CREATE TABLE d\n"
    assert ev(D.table_count_with_temporary, ddl, None) == [3, 0]
    assert ev(D.table_count, ddl) == [2]
    assert ev(D.table_count_uncommented, ddl) == [1]


def test_column_count(ev):
    assert ev(
        D.column_count,
        "CREATE TABLE a (id INT, d DECIMAL(10,2) DEFAULT 'a,b', PRIMARY KEY (id, d), unique (d));",
        "CREATE TABLE IF NOT EXISTS \"a b\" (x INT, , y INT, CONSTRAINT c CHECK (x > 0)) ;",
        "CREATE TABLE a (x INT) WITHOUT ROWID; CREATE TABLE b (y INT, z INT);",  # the first swallows the second
        "CREATE TABLE a (x INT)", "", None,
    ) == [2, 2, 1, 0, 0, 0]


def test_foreign_keys(ev):
    assert ev(D.has_foreign_key, "x REFERENCES t", "-- foreign key", "/* references */ a", "FOREIGN  KEY") == [
        True, False, False, True]
    assert ev(
        D.strip_foreign_keys,
        'CREATE TABLE a (\n x INT REFERENCES "b c" (id) ON DELETE SET NULL ON UPDATE NO ACTION NOT NULL,\n'
        " CONSTRAINT f FOREIGN KEY (x) REFERENCES b(id) DEFERRABLE INITIALLY DEFERRED\n);",
        "ALTER TABLE a ADD CONSTRAINT f FOREIGN KEY (x) REFERENCES b (id) ON DELETE CASCADE;\nSELECT 1;",
        "CREATE TABLE a (x INT, FOREIGN KEY (x) REFERENCES b, y INT);",
        "CREATE TABLE a (x INT NOT NULL); -- gone",
    ) == [
        "CREATE TABLE a (\n x INT  NOT NULL\n);", "\nSELECT 1;", "CREATE TABLE a (x INT, y INT);",
        "CREATE TABLE a (x INT NOT NULL); "]


def test_render(spark):
    from sqlloom.operators.catalog import RECORD
    from sqlloom.plans.schemas import render_records

    def column(name, type=None, nullable=None, unique=None, default=None):
        return {"NAME": name, "TYPE": type, "NULLABLE": nullable, "UNIQUE": unique, "DEFAULT": default}

    key = {"COLUMNS": ["a"], "FOREIGN_TABLE": "x.order", "REFERRED_COLUMNS": ["id"], "ON_DELETE": "SetDefault", "ON_UPDATE": "odd"}
    empty_key = {"COLUMNS": [], "FOREIGN_TABLE": "t", "REFERRED_COLUMNS": [], "ON_DELETE": None, "ON_UPDATE": None}
    tables = [
        {"TABLE_NAME": "a.b-c", "COLUMNS": [
            column("id", "integer", False, True), column("Order", "VARCHAR(9)", True, False, "it's"), column("2nd", None, None, None, "")],
         "PRIMARY_KEY": ["id", "2nd"], "FOREIGN_KEYS": [key, empty_key]},
        {"TABLE_NAME": "Group", "COLUMNS": [], "PRIMARY_KEY": None, "FOREIGN_KEYS": None},
        {"TABLE_NAME": "bad", "COLUMNS": [column(None)], "PRIMARY_KEY": None, "FOREIGN_KEYS": None},
        {"TABLE_NAME": None, "COLUMNS": [column("x")], "PRIMARY_KEY": None, "FOREIGN_KEYS": None},
    ]
    row = render_records(spark.createDataFrame([("s", tables)], f"k string, {RECORD}"), "k").first()
    assert row.schema_sql == (
        "CREATE TABLE a_b_c (\n  id integer NOT NULL UNIQUE,\n  \"Order\" TEXT DEFAULT 'its',\n  \"2nd\" TEXT NOT NULL,\n"
        "  PRIMARY KEY (id, 2nd),\n"
        "  FOREIGN KEY (a) REFERENCES x_order (id) ON DELETE SET DEFAULT ON UPDATE odd\n);\n\n"
        'CREATE TABLE "Group" (\n  \n);'
    )
    assert [t.TABLE_NAME for t in row.skipped] == ["bad", None]


def test_definitions(ev):
    assert ev(D.definition_type, "id INTEGER NOT NULL", "p DECIMAL(10, 2)", '"x y" UNSIGNED BIG INT DEFAULT 3', "z", "w NULL") == [
        "INTEGER", "DECIMAL(10, 2)", "UNSIGNED BIG INT", "", ""]
    assert ev(D.definition_name, '"x y" INT', "`a` TEXT", "[b c] INT", "d INT") == ["x y", "a", "b c", "d"]
    assert ev(D.statement_name, 'CREATE TABLE IF NOT EXISTS "A b" (x)', "create unique index i on t(x)") == ["A b", "i"]


# --- responses


def sql_of(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r["sql"] for r in R.with_sql(df, "x").orderBy("i").collect()]


def test_sql_from_response(spark):
    assert sql_of(
        spark, "```sql\na\n``` ```SQL b ```", "```sql\n\n``` ```\nc\n```", "```\nd\n```\n```text\ne\n```", "x ```sql f; g",
        "x ```sql h", "so: i: j; k", "j; k", "", None, "Answer: SELECT 1; ```sql", "```sqlite\nm\n```",
    ) == ["b", "c", "text\ne", "f;", "h", "j;", None, None, None, None, "sqlite\nm"]


def test_ddl_from_response(ev):
    t, i = "CREATE TABLE a (x INT);", "CREATE INDEX k ON a (x);"
    assert ev(
        R.ddl_from_response, f"```sqlite\n{t}\nDROP TABLE z;\n{i}\n```", f"```sqlite\nCREATE TABLE z (q INT);\n``` ```sqlite\n{t}```",
        f"open ```sqlite\n{t} tail", f"```sql\n{t}\n```", f"```\n{t}\n```", f"say {t} and {i} end", " nothing ", "", None,
        "```\nno statements\n```", f"```sqlite\n\n``` ```sql\n{t}\n```",
    ) == [f"{t}\n\n{i}", t, t, t, t, f"{t}\n\n{i}", "nothing", None, None, "no statements", t]
    both = f"{t} CREATE UNIQUE INDEX u ON a (x); create table if not exists b (y INT);"
    assert ev(R.table_statements, both) == [[t, "create table if not exists b (y INT);"]]
    assert ev(R.index_statements, both) == [["CREATE UNIQUE INDEX u ON a (x);"]]


def test_lines(ev):
    assert ev(R.question_lines, "1. Foo\n- 2) bar -\n\n • \n7-x-\n2024 sales", "x\n```plaintext\na\n```\n```PLAINTEXT\n12. 3) b\n```", "") == [
        ["Foo", "bar", "x", "sales"], ["3) b"], []]
    assert ev(R.paraphrase_lines, "12. 3) x\n²) y\n 4 . 5 z\r\n...") == [["x", "y", "z"]]


def question_lines(raw):
    out = []
    for line in raw.splitlines():
        s = line.strip().strip("-•").strip()
        for characters in ("0123456789", ".", ")", "-"):
            s = s.lstrip(characters)
        if s.strip():
            out.append(s.strip())
    return out


def test_lines_against_loop(ev):
    texts = random_texts("a1.)-• \n \r")
    assert ev(R.question_lines, *texts) == [question_lines(t) for t in texts]


def test_line_gates(ev):
    lines = lambda c: F.split(c, "\n")
    assert ev(lambda c: R.has_template_text(lines(c)), "a\nb", "a\n<3rd Question> x", "say plaintext") == [False, True, True]
    assert ev(lambda c: R.without_self_reference(lines(c)), "a\nParaphrase 1\nb") == [["a", "b"]]
    assert ev(lambda c: R.first_text(F.array(c)), "x") == ["x"]
    assert ev(lambda c: R.plain_blocks(c, "sql"), "```sqlA``` ```SQL b``` ```sql c") == [["A"]]
    assert ev(lambda c: R.tagged_blocks(c, "sql"), "```sql\n A\n``` ```SQL\nb``` ```sql c```") == [["A", "b"]]


# --- gates


def test_drop_reason(ev):
    none, comments = "Error generating SQL", "Only comments present"
    assert ev(G.drop_reason, "select 1;", "", ";", "SELECT x FROM t;", "SELECT x FROM t WHERE y = 1;") == [
        none, comments, comments, comments, None]
    assert ev(G.is_parsable, "x", "", None) == [True, False, False]
    assert ev(G.good_question_length, "x" * 19, "x" * 20, "é" * 1024, "x" * 1025) == [False, True, True, False]


def test_unify_fields(spark):
    rows = [("", "q1", "", "s1", "S", "k"), ("p", "q", "x", "s", None, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "prompt string, question string, sql_statement string, query string, cmd_type string, extra string")
    got = [tuple(r) for r in G.unify_fields(df).collect()]
    assert got == [("k", "q1", "s1", ""), (None, "p", "x", ""), (None, "", "", "")]
