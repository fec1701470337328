"""SQL-text expressions: counters, comment removal, statement splitting, normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.text import col, collapse, is_blank, strip, unix_lines

_QUOTED = r"'[^']*+(?:'|\z)|\"[^\"]*+(?:\"|\z)"
_STATEMENT = rf"((?:[^;'\"]++|{_QUOTED})*+)(?:;|\z)"


def _count(x, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(col(x), F.lit("")), F.lit(pattern))


def join_count(sql) -> Column:
    return _count(sql, fv.JOIN_WORD)


def commands(sql) -> Column:
    """Distinct SQL keywords in the order in which they first occur."""
    words = r"(?iU)\b(" + "|".join(fv.SQL_COMMANDS) + r")\b"
    found = F.regexp_extract_all(F.coalesce(col(sql), F.lit("")), F.lit(words), F.lit(1))
    return F.array_distinct(F.transform(found, F.upper))


def statement_kind(sql) -> Column:
    text = F.upper(strip(F.coalesce(col(sql), F.lit(""))))
    kind = F.regexp_extract(text, r"\A(" + "|".join(fv.STATEMENT_KINDS) + ")", 1)
    return F.when(kind == "", F.lit("OTHER")).otherwise(kind)


def clean_flat_comments(sql) -> Column:
    """Drop line comments from SQL whose line breaks are gone: each ends before the next clause."""
    stops = "|".join(rf"\b{w}\b" for w in fv.COMMENT_STOP_WORDS)
    return strip(F.regexp_replace(col(sql), rf"(?iU)--[^;]*?(?={stops}|;|$)", ""))


def strip_comments_naive(sql) -> Column:
    """Block comments, then the rest of every line from its first double dash."""
    text = F.regexp_replace(col(sql), fv.BLOCK_COMMENT, "")
    return F.regexp_replace(unix_lines(text), r"--[^\n]*", "")


def strip_comments_quoted(sql) -> Column:
    """As the naive form, but a double dash inside quotes stays.

    Quotes do not run past a line end; a double dash after an unclosed quote stays too.
    """
    text = unix_lines(F.regexp_replace(col(sql), fv.BLOCK_COMMENT, ""))
    kept = r"(?:[^'\"\n-]++|'[^'\n]*+'|\"[^\"\n]*+\"|-(?!-))*+"
    return F.regexp_replace(text, rf"(?md)^({kept})--[^\n]*", "$1")


def normalize_sql(sql) -> Column:
    """Comparison form: trimmed, one closing semicolon dropped, single blanks, lower case."""
    text = F.regexp_replace(strip(sql), r"(?U);[\s\x1C-\x1F]*\z", "")
    return F.lower(collapse(text))


def with_semicolon(sql) -> Column:
    text = strip(sql)
    return F.when(F.endswith(text, F.lit(";")), text).otherwise(F.concat(text, F.lit(";")))


def loose_form(sql) -> Column:
    """Without closing semicolons, line breaks, tabs and blanks."""
    return F.regexp_replace(col(sql), r"(?<![;\n\t ])[;\n\t ]++\z", "")


def split_statements(sql) -> Column:
    """Statements between semicolons that are outside quotes; an unclosed quote runs to the end."""
    parts = F.regexp_extract_all(col(sql), F.lit(_STATEMENT), F.lit(1))
    # The pattern matches once more, empty, at the very end of the text.
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def statement_count(sql) -> Column:
    """Statements that are not blank."""
    return F.size(F.filter(split_statements(sql), lambda s: ~is_blank(s)))


def is_single_statement(sql) -> Column:
    return statement_count(sql) == 1


def quote_identifier(name) -> Column:
    name = col(name)
    odd = F.regexp_like(name, F.lit(r"[^A-Za-z0-9_]")) | F.upper(name).isin(*fv.RESERVED_WORDS)
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(odd, quoted).otherwise(name)


def clean_dialect(ddl) -> Column:
    """Backticks become double quotes; CREATE SCHEMA and CREATE DATABASE go."""
    text = F.translate(col(ddl), "`", '"')
    return F.regexp_replace(text, r"(?iU)CREATE\s+(?:SCHEMA|DATABASE)\s+\w+;?", "")


def preview_select(table, columns, limit: int = 20) -> Column:
    """A SELECT over the quoted columns (an array) of a table, or * when there are none."""
    names = F.transform(columns, quote_identifier)
    listed = F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise(F.lit("*"))
    return F.concat(F.lit("SELECT "), listed, F.lit(" FROM "), quote_identifier(table), F.lit(f" LIMIT {int(limit)};"))
