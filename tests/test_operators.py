"""Ranking, sampling, lookups, candidates and the SQLite gate on small frames, hot keys included."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sqlloom.operators import attempts as W
from sqlloom.operators import candidates as C
from sqlloom.operators import catalog as K
from sqlloom.operators import examples as X
from sqlloom.operators import gates as G
from sqlloom.operators import lookups as L
from sqlloom.operators import profiles as P
from sqlloom.operators import ranking as R
from sqlloom.operators import sampling as A
from sqlloom.operators.inference import infer
from sqlloom.plans import schemas as J


def hashed(*keys):
    return hashlib.md5(":".join(str(k) for k in keys).encode()).hexdigest()


def hot(n=3000, seed=1):
    """(group, key): one group holds a third of the rows."""
    rng = random.Random(seed)
    return [(0 if i % 3 == 0 else rng.randint(1, 40), f"k{i}") for i in range(n)]


# --- ranking


def test_keyed_rank_matches_sorting(spark):
    rows = hot()
    df = spark.createDataFrame(rows, "g int, k string")
    expected = {}
    for g in {r[0] for r in rows}:
        for i, k in enumerate(sorted((k for h, k in rows if h == g), key=lambda k: (hashed(5, k), k)), 1):
            expected[k] = i
    for digits in (1, 3):
        got = {r.k: r["rank"] for r in R.keyed_rank(df, ["g"], "k", 5, spread_digits=digits).collect()}
        assert got == expected


def test_with_position_matches_sorting(spark):
    words = sorted({f"{hashed(i)[:6]}é{i}" for i in range(6000)}, key=lambda w: w.encode())
    shuffled = random.Random(3).sample(words, len(words))
    df = spark.createDataFrame([(w,) for w in shuffled], "w string")
    assert [r.w for r in R.with_position(df, "w").orderBy("position").collect()] == words
    numbers = spark.range(0, 20_000, 3).select((F.col("id") * 7919 % 20_011).alias("n"))
    got = [tuple(r) for r in R.with_position(numbers, "n").collect()]
    assert sorted(got) == [(n, i) for i, n in enumerate(sorted(n for n, _ in got))]


def exchanges(spark, df) -> int:
    """Exchanges of the static plan, without broadcasts."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") + plan.count("Exchange rangepartitioning")


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_positions_are_exact_and_sum_up_partitions_only(spark, static_plans):
    ranked = R.with_position(spark.range(50_000).repartition(7), "id")
    assert ranked.where("id <> position").count() == 0
    # Only the sizes of the stored partitions are grouped and summed, the rows stay where they are.
    assert exchanges(spark, ranked) == 2


def test_a_vote_is_one_shuffle_of_the_candidates(spark, static_plans):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, cands = spark.range(10).select(F.col("id").alias("item_id")), spark.range(10).select(
            F.col("id").alias("item_id"), F.lit(0).alias("round_no"), F.lit("SELECT 1;").alias("sql"), F.lit("select 1").alias("norm"))
        judged = spark.range(10).select(F.col("id").alias("item_id"), F.lit("```sql\nSELECT 1\n```").alias("raw"))
        # Items, candidates and verdicts are each dealt out by item, once.
        assert exchanges(spark, C.voted(items, cands, judged)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slices_and_chunks(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("n"))
    take = lambda *a: sorted(r.n for r in R.slice_rows(df, "n", *a).collect())
    assert take(2, 5) == [4, 6, 8] and take(8) == [16, 18] and take(10) == [] and take(0, 99) == list(range(0, 20, 2))
    chunks = {r.n: r.chunk for r in R.with_chunk(df, "n", 4, first=1).collect()}
    assert chunks == {n: i // 4 + 1 for i, n in enumerate(range(0, 20, 2))}
    assert R.with_position(df.limit(0), "n").count() == 0


def test_first_per_key(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    assert sorted(tuple(r) for r in R.first_per_key(df, ["k"], "n").collect()) == [("a", 1, "y"), ("b", 2, "z")]
    once = R.first_per_key(df, ["k"], "n")
    assert sorted(R.first_per_key(once, ["k"], "n").collect()) == sorted(once.collect())


def test_shuffles_keep_all_rows_and_repeat(spark):
    df = spark.range(500)
    first = [r.id for r in R.shuffled(df, "id", 1).collect()]
    assert first == [r.id for r in R.shuffled(df.repartition(7), "id", 1).collect()]
    assert sorted(first) == list(range(500)) != first
    assert sorted(r.id for r in R.scattered(df, "id", 1, 3).collect()) == list(range(500))


# --- sampling


def test_density_is_the_closed_form(spark):
    import math

    for mode, top, ramp in ((100, 350, 0.5), (8, 60, 0.7), (0, 10, 0.7), (1, 10, 0.5), (40, 20, 0.7)):
        theta = top / 10
        k = max(mode / theta + 1, 1.5)
        y = [x ** (k - 1) * math.exp(-x / theta) for x in range(top + 1)]
        peak = y.index(max(y))
        y = [v / max(y) for v in y]
        for x in range(peak):
            y[x] = ramp if peak == 1 else ramp + (1 - ramp) * x / (peak - 1)
        got = {r.num_tables: r.density for r in A.table_count_density(spark, mode, top, ramp).collect()}
        assert all(abs(got[x] - v / sum(y)) < 1e-12 for x, v in enumerate(y)) and len(got) == top + 1


def test_quotas_round_half_to_even(spark):
    density = spark.createDataFrame([(0, 0.25), (1, 0.75)], "num_tables int, density double")
    got = {r.num_tables: r.target for r in A.quotas(density, F.lit(10)).collect()}
    assert got == {0: 2, 1: 8}


def test_quota_sample_keeps_targets_and_loses_nothing(spark):
    rows = hot()
    df = spark.createDataFrame(rows, "num_tables int, schema_file string")
    targets = spark.createDataFrame([(g, 10 * g + 500 * (g == 0)) for g in range(30)], "num_tables int, target int")
    got = A.quota_sample(df, "schema_file", targets, 42).collect()
    assert sorted(r.schema_file for r in got) == sorted(k for _, k in rows)
    have, kept = Counter(g for g, _ in rows), Counter(r.num_tables for r in got if r.action == "KEEP")
    assert all(kept[g] == min(have[g], 10 * g + 500 * (g == 0)) for g in range(30))
    assert all((r.action == "OVER_MAX") == (r.num_tables >= 30) for r in got)


def test_draw_joins_follows_the_weights(spark):
    n = 20_000
    got = Counter(r.j for r in spark.range(n).select(A.draw_joins(3, "id").alias("j")).collect())
    weights = [0.15, 0.2] + [0.6 / 36 * (10 - j) for j in range(2, 10)] + [0.05]
    assert all(abs(got[j] / n - w) < 0.012 for j, w in enumerate(weights))


def test_draw_weighted_follows_the_density(spark):
    density = spark.createDataFrame([(0, 0.5), (1, 0.0), (2, 0.25), (3, 0.25)], "v int, p double")
    bounds = A.cumulative(density, "v", "p")
    got = Counter(r.v for r in A.draw_weighted(spark.range(8000), bounds, "v", 9, "id").collect())
    assert sum(got.values()) == 8000 and 1 not in got
    assert abs(got[0] / 8000 - 0.5) < 0.03 and abs(got[3] / 8000 - 0.25) < 0.03


def test_draw_positions_are_uniform_subsets(spark):
    draws = spark.range(6000).select(A.draw_positions(F.lit(5), 2, 1, "id").alias("s")).collect()
    got = Counter(tuple(sorted(r.s)) for r in draws)
    assert set(got) == set(itertools.combinations(range(5), 2))
    assert all(abs(c / 6000 - 0.1) < 0.02 for c in got.values())
    small = spark.range(1).select(A.draw_positions(F.lit(2), 4, 1, "id").alias("s"), A.draw_positions(F.lit(0), 4, 1, "id").alias("e")).first()
    assert list(small.s) == [0, 1] and list(small.e) == []


def test_growth_step(spark):
    rows = spark.range(500).select(A.growth_step(F.lit(10), F.lit(100), 1, "id").alias("n"), A.growth_step(F.lit(98), F.lit(100), 1, "id").alias("m")).collect()
    assert {r.n for r in rows} == set(range(15, 26)) and {r.m for r in rows} == {2}


# --- examples


def test_labels_and_buckets(ev, spark):
    assert ev(X.join_label, "3", "10", "11", "-1", "n/a", "2.0", "") == [3, 10, None, None, None, None, None]
    raw = spark.createDataFrame([("q1 ", " 2"), ("q1", "2"), ("q2", "9"), ("", "1"), (None, "1"), ("q3", "x")], "nl_prompt string, num_joins string")
    valid = X.valid_examples(raw)
    assert sorted(tuple(r) for r in valid.collect()) == [("q1", 2), ("q2", 9)]
    nearest = {r.target_joins: r.used_joins for r in X.nearest_buckets(X.example_buckets(valid)).collect()}
    assert nearest == {j: 2 if j <= 5 else 9 for j in range(11)}
    none = X.nearest_buckets(X.example_buckets(valid.limit(0))).collect()
    assert len(none) == 11 and all(r.used_joins is None for r in none)


def test_draw_examples_from_a_hot_bucket(spark):
    examples = spark.createDataFrame([(f"e{i}", 1) for i in range(400)] + [("solo", 7)], "nl_prompt string, num_joins int")
    requests = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 9).otherwise(0).alias("j"))
    got = X.draw_examples(requests, "id", "j", examples, 4, 11).collect()
    assert len(got) == 300
    for r in got:
        if r.id % 3 == 0:
            assert r.examples_joins == 7 and r.examples == ["solo"]
        else:
            assert r.examples_joins == 1 and len(set(r.examples)) == 4 and all(e.startswith("e") for e in r.examples)
    assert len({e for r in got for e in r.examples}) > 250
    nothing = X.draw_examples(requests, "id", "j", examples.limit(0), 4, 11).first()
    assert nothing.examples == [] and nothing.examples_joins == nothing.j


# --- lookups


def test_marked_prefix(spark):
    flags = spark.createDataFrame([("schema_1.sql", " True "), ("x.y.sql", "1"), ("no.sql", "false"), (" ", "yes")], "file_name string, foreign_key string")
    files = spark.createDataFrame([(f,) for f in ("schema_1.sql", "schema_10.sql", "schema_2.sql", "x.y_3.sql", "x.sql", "")], "f string")
    hit = lambda exact: sorted(r.f for r in L.with_marked_prefix(files, L.marked_prefixes(flags), "f", exact).collect())
    assert hit(False) == ["schema_1.sql", "schema_10.sql", "x.y_3.sql"]
    assert hit(True) == ["schema_1.sql"]
    assert L.with_marked_prefix(files, L.marked_prefixes(flags.limit(0)), "f").count() == 0


def test_best_table_matches_a_loop(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ab_") for _ in range(rng.randint(1, 4)))
    catalog = sorted({(s, f"T{word()}{i}", f"{word()}{c}") for s in range(3) for i in range(6) for c in range(3)})
    asks = [(q, q % 3 if q else 0, [word() for _ in range(rng.randint(0, 4))]) for q in range(60)]
    expected = {}
    for q, s, tokens in asks:
        names = sorted({t for z, t, _ in catalog if z == s})
        score = {t: sum(k in t.lower() for k in set(tokens)) + sum(
            k in c.lower() for z, u, c in catalog if (z, u) == (s, t) for k in set(tokens)) for t in names}
        best = max(names, key=lambda t: (score[t], t))
        expected[q] = best if score[best] else names[0]
    got = L.best_tables(
        spark.createDataFrame(asks, "q int, scope int, tokens array<string>"),
        spark.createDataFrame(catalog, "scope int, table_name string, col_name string"),
    )
    assert {r.q: r.table_name for r in got.collect()} == expected


# --- profiles, catalog, conflicts


def test_profiles(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 2), ("c", 2)], "schema_file string, num_tables int")
    assert {r.num_tables: r.n for r in P.table_histogram(counts).collect()} == {0: 1, 1: 0, 2: 2}
    assert P.table_histogram(counts, 5).count() == 6
    flags = spark.createDataFrame([("a", True), ("b", False), ("c", False), ("d", False)], "file_name string, foreign_key boolean")
    assert tuple(P.foreign_key_share(flags).first()) == (4, 1, 3, 75.0)
    assert P.foreign_key_share(flags.limit(0)).first().percent_without is None
    files = spark.createDataFrame([([],), (None,), (["t"],), (["t", "u"],)], "tables array<string>")
    assert P.empty_table_share(files).first()[0] == 50.0
    assert P.empty_table_share(files.limit(0)).first()[0] == 0.0


def test_catalog_agrees_with_sqlite(spark):
    import sqlite3

    ddl = (
        'CREATE TABLE "b t" (id INTEGER PRIMARY KEY AUTOINCREMENT, "a b" VARCHAR(20) NOT NULL, d DECIMAL(10, 2) DEFAULT 1, e,\n'
        " FOREIGN KEY (id) REFERENCES a (x), UNIQUE (d));\n"
        "CREATE TABLE IF NOT EXISTS a (x UNSIGNED BIG INT, y TEXT CHECK (y <> ','), z REFERENCES a (x));"
    )
    db = sqlite3.connect(":memory:")
    db.executescript(ddl)
    tables = [r[0] for r in db.execute("select name from sqlite_master where type='table' and name not like 'sqlite_%' order by 1")]
    expected = [(t, c[0], c[1], c[2]) for t in tables for c in db.execute(f'pragma table_info("{t}")')]
    catalog = K.catalog_from_ddl(spark.createDataFrame([("s", ddl)], "k string, ddl string"), "k", "ddl")
    got = sorted((r.table_name, r.col_idx, r.col_name, r.col_type) for r in catalog.collect())
    assert got == sorted(expected)
    assert K.compressed_schemas(catalog, "k", 2).first().compressed == "a(x:UNSIGNED BIG INT, y:TEXT, ...)\nb t(id:INTEGER, a b:VARCHAR(20), ...)"


def varied_schema(seed: int) -> str:
    """A schema text with the shapes that trip up simple patterns, valid for SQLite."""
    import random

    rng = random.Random(seed)
    out, names = [], rng.sample(range(1000), 12)
    for n in names[: rng.randrange(1, 12)]:
        name = rng.choice([f"t{n}", f'"T {n}"', f"`t-{n}`", f"[t {n}]", f"'t{n}'", f"main.t{n}", f'"a""{n}"', f"main . [t {n}]"])
        columns = [rng.choice([
            f"c{k} INTEGER", f'"c {k}" TEXT NOT NULL', f"[c{k}] DECIMAL(10, 2) DEFAULT 1.5", f"`c{k}` TEXT DEFAULT 'x);'",
            f"c{k} TEXT DEFAULT 'it''s -- not a comment'", f"c{k} /* a, b */ INT", f"c{k} UNSIGNED BIG INT -- one, two\n", f"c{k}",
            f"'c{k}' VARCHAR(20) CHECK ('c{k}' <> '/* ;')", f"c{k} TEXT COLLATE NOCASE", f"c{k} INT DEFAULT (1 + (2))",
        ]) for k in range(rng.randrange(1, 6))]
        rest = rng.choice(["", ", UNIQUE (p)", ", CONSTRAINT u UNIQUE (p)", ", CHECK (p > 0)", ", FOREIGN KEY (p) REFERENCES z (q)"])
        tail = rng.choice(["", " WITHOUT ROWID", " STRICT"]) if rng.random() < 0.3 else ""
        if tail == " STRICT":
            columns = [f"c{k} TEXT" for k in range(3)]
        exists = rng.choice(["", "IF NOT EXISTS "])
        out.append(f"CREATE TABLE {exists}{name} (p INTEGER PRIMARY KEY, {', '.join(columns)}{rest}){tail};")
        if rng.random() < 0.3:
            out.append(f"create table if not exists {name} (other TEXT);")
        if rng.random() < 0.3:
            out.append(rng.choice([
                f"-- CREATE TABLE x{n} (a INT);\n", f"/* CREATE TABLE y{n} (a INT);\n; */", f"CREATE TEMP TABLE q{n} (a INT);",
                f"CREATE TEMPORARY TABLE r{n} (a INT);", f"CREATE INDEX i{n} ON {name.split('.')[-1]} (p);" if "." not in name else ";", ";",
                f"CREATE VIEW v{n} AS SELECT ';' AS a;",
            ]))
    return rng.choice(["\n", " ", "\n\n"]).join(out)


def test_catalog_of_varied_schemas_agrees_with_sqlite(spark):
    import sqlite3

    texts = [(n, varied_schema(n)) for n in range(200)] + [(900, "\n".join(f"CREATE TABLE b{n} (x INT, y TEXT);" for n in range(5000)))]
    expected = set()
    for n, ddl in texts:
        db = sqlite3.connect(":memory:")
        db.executescript(ddl)
        for (t,) in db.execute("select name from sqlite_master where type='table' and name not like 'sqlite_%'").fetchall():
            quoted = t.replace('"', '""')
            expected |= {(n, t, c[0], c[1], c[2]) for c in db.execute(f'pragma table_info("{quoted}")')}
        db.close()
    catalog = K.catalog_from_ddl(spark.createDataFrame(texts, "k int, ddl string").repartition(8), "k", "ddl")
    got = {tuple(r) for r in catalog.select("k", "table_name", "col_idx", "col_name", "col_type").collect()}
    assert sorted(got - expected)[:3] == [] and sorted(expected - got)[:3] == []


def test_spark_types():
    got = [K.spark_type(t) for t in ("int", "UNSIGNED BIG INT", "Double Precision", "VARCHAR(3)", "DATE", "BLOB", "null")]
    assert got == ["bigint", "bigint", "double", "string", "date", "binary", "void"]


def test_name_conflicts(spark):
    new = [("s", 1, "CREATE TABLE A (x INT);"), ("s", 2, "CREATE TABLE b (x INT);"), ("s", 3, 'CREATE TABLE "B" (y INT);'),
           ("s", 4, "CREATE TABLE IF NOT EXISTS a (x INT);"), ("s", 5, "CREATE TABLE IF NOT EXISTS c (x INT);"), ("s", 6, "CREATE TABLE c (x INT);"),
           ("t", 1, "CREATE TABLE a (x INT);")]
    kept = G.without_name_conflicts(
        spark.createDataFrame(new, "k string, ord int, statement string"), spark.createDataFrame([("s", "a")], "k string, table_name string"))
    assert sorted((r.k, r.ord) for r in kept.collect()) == [("s", 2), ("s", 4), ("s", 5), ("t", 1)]


# --- attempts, candidates, vote


def test_attempts(spark):
    raw = [(1, 0, "```"), (1, 1, "a\nb\nc"), (1, 2, "d"), (2, 0, ""), (2, 3, "late"), (3, 0, "```plaintext\n<First Question>\n```")]
    parsed = W.parsed_questions(spark.createDataFrame(raw, "item_id int, attempt int, raw string"))
    accepted = W.first_valid(parsed, 2)
    assert [tuple(r) for r in accepted.collect()] == [(1, 1, ["a", "b", "c"])]
    items = spark.createDataFrame([(1,), (2,), (3,)], "item_id int")
    assert sorted(r.item_id for r in W.pending(items, accepted).collect()) == [2, 3]
    assert [r.question for r in W.numbered_lines(accepted, 2).orderBy("line_no").collect()] == ["a", "b"]


def test_vote_precedence(spark):
    cands = [(1, 0, "SELECT a;"), (1, 1, "select  A;"), (1, 2, "SELECT b;"), (2, 0, "SELECT a;"), (2, 1, "SELECT 'B' ;;"), (3, 0, "SELECT z;")]
    df = spark.createDataFrame(cands, "item_id int, round_no int, sql string")
    from sqlloom.functions.sqltext import normalize_sql

    df = df.withColumn("norm", normalize_sql("sql"))
    judged = [(1, "```sql\nSELECT A\n```"), (2, "```sql\nSELECT 'B'\n```"), (3, "no idea"), (4, "```sql\nSELECT 9;\n```")]
    items = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "item_id int")
    won = {r.item_id: r.winner for r in C.voted(items, df, spark.createDataFrame(judged, "item_id int, raw string")).collect()}
    assert won == {1: "select  A;", 2: "SELECT 'B' ;;", 3: "SELECT z;", 4: "SELECT 1;"}


def test_a_hot_item_is_voted_like_any_other(spark):
    rows = [(0, i, f"```sql\nSELECT {i % 500}\n```") for i in range(2000)] + [(i, 0, "```sql\nSELECT x\n```") for i in range(1, 200)]
    gated = C.extracted_candidates(spark.createDataFrame(rows, "item_id int, round_no int, raw string"))
    kept = C.distinct_candidates(gated)
    assert kept.count() == 500 + 199
    assert C.quarantined_candidates(gated).count() == 1500
    items = spark.range(201).select(F.col("id").cast("int").alias("item_id"))
    won = C.voted(items, C.with_fallback(items, kept), spark.createDataFrame([(0, "```sql\nSELECT 321\n```")], "item_id int, raw string"))
    got = {r.item_id: r.winner for r in won.collect()}
    assert got[0] == "SELECT 321;" and got[5] == "SELECT x;" and got[200] == "SELECT 1;"


# --- additions and model calls


def test_additions_without_conflicts(spark):
    old = "CREATE TABLE t (x INT); /* CREATE TABLE n (x INT); */ create table main.[Big One] (y INT); CREATE INDEX i0 ON t (x);"
    new = ("CREATE TABLE T (z INT); CREATE TABLE n (x INT); CREATE TABLE N (y INT); CREATE TABLE IF NOT EXISTS t (q INT); "
           'CREATE TABLE "big one" (z INT); CREATE INDEX I0 ON n (x); CREATE INDEX j ON n (x);')
    rows = [("a", old, new), ("b", None, "CREATE TABLE n (x INT);"), ("c", old, "CREATE INDEX k ON t (x);"), ("d", old, "")]
    got = G.additions_without_conflicts(spark.createDataFrame(rows, "k string, old string, new string"), "old", "new").collect()
    assert {r.k: (r.kept, r.n_new) for r in got} == {
        "a": ("CREATE TABLE n (x INT);\n\nCREATE TABLE IF NOT EXISTS t (q INT);\n\nCREATE INDEX j ON n (x);", 1),
        "b": ("CREATE TABLE n (x INT);", 1), "c": ("CREATE INDEX k ON t (x);", 0), "d": ("", 0)}


def test_infer_reports_failures_per_batch(spark):
    def make():
        def model(prompts, options):
            if len(prompts) > 3 or "7" in prompts:
                raise RuntimeError("down")
            return [p + options["tail"] if p != "8" else [] for p in prompts]
        return model

    asked = spark.range(20).repartition(2, "id").select("id", F.col("id").cast("string").alias("prompt"))
    got = {r.id: (r.response, r.error) for r in infer(asked, make, batch_size=1, options={"tail": "!"}, key="id").collect()}
    assert got[3] == ("3!", None) and got[7] == (None, "RuntimeError: down") and got[8] == ("", None) and len(got) == 20


def test_additions_to_schemas_of_thousands_of_tables(spark):
    def sql(names):
        return "\n".join(f"CREATE TABLE {n} (id INT);" for n in names)

    old, new = [f"t{n}" for n in range(3000)], [f"T{n * 2}" for n in range(2500)]
    got = G.additions_without_conflicts(spark.createDataFrame([(sql(old), sql(new + new))], "old string, new string"), "old", "new").first()
    assert got.n_new == 1000 and got.kept == "\n\n".join(f"CREATE TABLE T{n} (id INT);" for n in range(3000, 5000, 2))

