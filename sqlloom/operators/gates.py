"""Row filters and their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.ddl import has_if_not_exists, statement_name, table_names
from sqlloom.functions.responses import index_statements, table_statements
from sqlloom.functions.text import col, computed, flatten, is_blank, non_empty, strip
from sqlloom.operators.ranking import first_per_key


def first_non_empty(*names: str) -> Column:
    """The first column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[non_empty(n) for n in names], F.lit(""))


def column_or_empty(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def unify_fields(df: DataFrame) -> DataFrame:
    """question from prompt or question, query from sql_statement or query; other columns stay."""
    have = lambda *names: [n for n in names if n in df.columns]
    dropped = ("cmd_type", "prompt", "sql_statement", "question", "query", "schema")
    return df.select(
        *[c for c in df.columns if c not in dropped],
        first_non_empty(*have("prompt", "question")).alias("question"),
        first_non_empty(*have("sql_statement", "query")).alias("query"),
        F.coalesce(column_or_empty(df, "schema"), F.lit("")).alias("schema"),
    )


def drop_reason(query) -> Column:
    """Why a cleaned query is not worth keeping, or null.  The order of the tests is contract.

    The parse test accepts any text with a statement in it, so only the empty text
    fails it, and the length test has caught that before.
    """
    text = F.upper(strip(query))
    return F.when(text == "SELECT 1;", fv.REASON_NO_SQL).when(
        (text == "") | (text == ";") | (F.length(strip(query)) < fv.SHORTEST_QUERY), fv.REASON_ONLY_COMMENTS
    )


def is_parsable(sql) -> Column:
    """What a non-validating parser accepts: any text with a character in it."""
    return F.length(F.coalesce(col(sql), F.lit(""))) > 0


def good_question_length(question) -> Column:
    return F.length(col(question)).between(*fv.QUESTION_LENGTH)


def has_required(*names: str) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & ~is_blank(name)
    return test


def flatten_fields(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: flatten(n) for n in names})


def without_failed_names(df: DataFrame, name: str = "filename") -> DataFrame:
    return df.where(~F.contains(F.lower(F.coalesce(name, F.lit(""))), F.lit("failed")))


def without_name_conflicts(new: DataFrame, existing: DataFrame) -> DataFrame:
    """CREATE TABLE statements whose table is new to its schema.

    ``new`` is (schema key, ord, statement), ``existing`` is (schema key, table_name).
    Names compare without case.  Statements with IF NOT EXISTS never clash.  Of several
    new statements for one name, the first stays.
    """
    key = new.columns[0]
    named = computed(new, _name=F.lower(statement_name("statement")), _lenient=has_if_not_exists("statement"))
    claims = named.select(key, "_name", "ord", "_lenient", F.lit(False).alias("_taken")).unionByName(
        existing.select(key, F.lower("table_name").alias("_name"), F.lit(True).alias("_taken")), allowMissingColumns=True
    )
    strict, lenient = F.min(F.when(~F.col("_lenient"), F.col("ord"))), F.min(F.when(F.col("_lenient"), F.col("ord")))
    # A name goes to its first strict statement, unless the schema or an earlier lenient one has it.
    granted = (
        claims.groupBy(key, "_name")
        .agg(F.max("_taken").alias("_taken"), strict.alias("ord"), lenient.alias("_lenient_ord"))
        .where("not _taken and ord is not null and (_lenient_ord is null or ord < _lenient_ord)")
        .select(key, "_name", "ord", F.lit(True).alias("_granted"))
    )
    kept = named.join(granted, [key, "_name", "ord"], "left").where("_lenient or _granted")
    return kept.select(*new.columns)


def index_names(ddl) -> Column:
    """Names of the indexes that a schema text creates, in lower case."""
    return F.transform(index_statements(ddl), lambda s: F.lower(statement_name(s)))


def additions_to_names(states: DataFrame, names: str, indexes: str, new: str) -> DataFrame:
    """Add (kept, n_new): the CREATE statements of ``new`` that fit to a schema with these names.

    The rule of :func:`without_name_conflicts` for one row, without a shuffle: a table must be new to
    the schema unless it says IF NOT EXISTS.  Tables come first, then indexes whose name
    is new among the indexes.  ``n_new`` counts tables that the schema didn't have.  Names known and
    names asked for are sorted together, so that a name is new exactly if no equal one stands before it; the
    work grows with the names, not with their square.
    """

    def sorted_names(taken, statements):
        known = F.transform(taken, lambda n: F.struct(n.alias("name"), F.lit(-1).alias("ord"), F.lit("").alias("text")))
        asked = F.transform(statements, lambda s, i: F.struct(F.lower(statement_name(s)).alias("name"), i.alias("ord"), s.alias("text")))
        return F.array_sort(F.concat(known, asked))

    def judged(entries: str):
        def one(e, place):
            before = F.get(F.col(entries), place - 1)["name"]
            fresh = (e["name"] != "") & F.coalesce(before != e["name"], F.lit(True))
            return F.struct(e["ord"].alias("ord"), e["text"].alias("text"), fresh.alias("fresh"))

        asked = F.filter(F.transform(F.col(entries), one), lambda e: e["ord"] >= 0)
        return F.array_sort(F.filter(asked, lambda e: e["fresh"] | has_if_not_exists(e["text"])))

    split = computed(states, _t=sorted_names(F.col(names), table_statements(new)), _i=sorted_names(F.col(indexes), index_statements(new)))
    done = computed(split, _tables=judged("_t"), _indexes=judged("_i"))
    texts = F.transform(F.concat("_tables", "_indexes"), lambda e: e["text"])
    return done.select(*states.columns, F.array_join(texts, "\n\n").alias("kept"), F.size(F.filter("_tables", lambda e: e["fresh"])).alias("n_new"))


def additions_without_conflicts(states: DataFrame, old: str, new: str) -> DataFrame:
    """Add (kept, n_new) as :func:`additions_to_names` does, for a schema text ``old``."""
    named = computed(states, _have=F.transform(table_names(old), F.lower), _had=index_names(old))
    return additions_to_names(named, "_have", "_had", new).drop("_have", "_had")


def first_questions(questions: DataFrame, order: str = "row_idx") -> DataFrame:
    """The first row of every (schema_file, question)."""
    return first_per_key(questions, ["schema_file", "question"], order)
