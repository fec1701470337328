"""Joins on text: prefixes, and tokens inside names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.text import stem, strip


def marked_prefixes(flags: DataFrame) -> DataFrame:
    """(prefix): stems of the files marked true in (file_name, foreign_key)."""
    if not {"file_name", "foreign_key"} <= set(flags.columns):
        raise ValueError("the flag list needs the columns file_name and foreign_key")
    name = strip(F.coalesce("file_name", F.lit("")))
    marked = F.lower(strip(F.coalesce(F.col("foreign_key").cast("string"), F.lit("")))).isin(*fv.TRUE_SPELLINGS)
    return flags.where(marked & (name != "")).select(stem(name).alias("prefix")).distinct()


def with_marked_prefix(files: DataFrame, prefixes: DataFrame, name: str, exact: bool = False) -> DataFrame:
    """Files whose stem starts with any prefix (or equals one, if exact).

    The stem is cut at the lengths that occur among the prefixes and the cuts are
    joined by equality, so no file is compared with every prefix.  File names are
    unique and prefixes are file stems, so there are a few hundred lengths at most.
    """
    if exact:
        return files.withColumn("prefix", stem(name)).join(prefixes, "prefix", "left_semi").select(*files.columns)
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect())
    cuts = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    hits = (
        files.select(name, stem(name).alias("_stem"))
        .select(name, "_stem", F.explode(F.filter(cuts, lambda n: n <= F.length("_stem"))).alias("_n"))
        .select(name, F.left("_stem", F.col("_n")).alias("prefix"))
        .join(prefixes, "prefix", "left_semi")
        .select(name).distinct()
    )
    return files.join(hits, name, "left_semi").select(*files.columns)


def best_tables(questions: DataFrame, catalog: DataFrame) -> DataFrame:
    """(question key, scope, table_name): the table that shares most tokens with each question.

    ``questions`` is (key, scope, tokens array), ``catalog`` is (scope, table_name,
    col_name).  The score of a table is the number of distinct tokens found inside its
    name plus those found inside each column name, names in lower case.  Ties go to the
    greater name; without any hit it is the first name of the scope.

    Names are cut at the lengths that the scope's tokens have, and the cuts are joined to
    the tokens by equality, so only real hits are produced.
    """
    key = questions.columns[0]
    tokens = questions.select(key, "scope", F.explode(F.array_distinct("tokens")).alias("token")).where("token <> ''")
    tables = catalog.select("scope", "table_name", F.lower("table_name").alias("_name")).distinct()
    columns = catalog.where("col_name is not null").select("scope", "table_name", F.lower("col_name").alias("_name"))
    size = F.length("_name")
    # Only substrings that some question of the scope asks for; longer tokens than a name can't be in it.
    asked = tokens.select("scope", "token").distinct()
    lengths = asked.select("scope", F.length("token").alias("n")).distinct().groupBy("scope").agg(F.collect_set("n").alias("_lengths"))
    substrings = F.array_distinct(F.flatten(F.transform(
        F.filter("_lengths", lambda n: n <= size),
        lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.substring("_name", at, n)),
    )))
    scores = (
        tables.unionByName(columns).where(size > 0).join(lengths, "scope")
        .select("scope", "table_name", F.explode(substrings).alias("token"))
        .join(asked, ["scope", "token"], "left_semi")
        .groupBy("scope", "token", "table_name").agg(F.count(F.lit(1)).alias("hits"))
    )
    best = (
        tokens.join(scores, ["scope", "token"])
        .groupBy(key, "scope", "table_name").agg(F.sum("hits").alias("score"))
        .groupBy(key, "scope").agg(F.max_by("table_name", F.struct("score", "table_name")).alias("_best"))
    )
    first = catalog.groupBy("scope").agg(F.min("table_name").alias("_first"))
    return (
        questions.select(key, "scope")
        .join(first, "scope")
        .join(best, [key, "scope"], "left")
        .select(key, "scope", F.coalesce("_best", "_first").alias("table_name"))
    )
