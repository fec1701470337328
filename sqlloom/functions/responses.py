"""Expressions that read model responses: fenced blocks, SQL, DDL and question lines."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.text import WS, col, computed, line_feeds, non_empty, normalize, strip

# Characters that Python's str.isdigit accepts.
_DIGITS = "".join(chr(c) for c in range(0x20000) if chr(c).isdigit())


def _all(x, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(col(x), F.lit("")), F.lit(pattern), F.lit(1))


def _last(x, pattern: str) -> Column:
    """Text of the last match, trimmed; null when there is no match."""
    return strip(F.try_element_at(_all(x, pattern), F.lit(-1)))


def tagged_blocks(x, tag: str) -> Column:
    """Fenced blocks with this tag, in any case, whose text starts on a new line."""
    return F.transform(_all(x, rf"(?isU)```{re.escape(tag)}\s*\n(.*?)```"), strip)


def plain_blocks(x, tag: str) -> Column:
    """Fenced blocks with exactly this tag; the text may start right after it."""
    return F.transform(_all(x, rf"(?s)```{re.escape(tag)}(.*?)```"), strip)


def first_text(x) -> Column:
    """The first text of a response that is an array of texts, or the empty string."""
    return F.coalesce(F.get(x, F.lit(0)), F.lit(""))


def with_sql(df: DataFrame, raw: str, name: str = "sql") -> DataFrame:
    """Add the SQL of a response, or null.

    Taken from the last closed sql block, else the last closed block of any kind, else
    an open sql block up to its first semicolon, else the text between the last
    semicolon and the last colon before it.  Each pattern runs once per row.
    """
    x = F.coalesce(raw, F.lit(""))
    found = computed(
        df,
        _in_sql=_last(raw, fv.SQL_FENCE),
        _in_any=_last(raw, fv.ANY_FENCE),
        _in_open=F.regexp_substr(x, F.lit(fv.SQL_FENCE_OPEN)),
        _in_head=F.left(x, F.length(x) - F.length(F.substring_index(x, ";", -1))),
    )
    # From the fence on; its tag and the white space after it are cut off here.
    rest = strip(F.substring("_in_open", 7, 2**31 - 1))
    to_first_semicolon = F.when(
        F.locate(";", rest) > 0, F.concat(F.substring_index(rest, ";", 1), F.lit(";"))
    ).otherwise(rest)
    after_colon = F.when(F.locate(":", "_in_head") > 0, strip(F.substring_index("_in_head", ":", -1)))
    last_resort = F.when(F.col("_in_open").isNotNull(), to_first_semicolon).otherwise(after_colon)
    sql = F.coalesce(non_empty("_in_sql"), non_empty("_in_any"), non_empty(last_resort))
    return found.withColumn(name, sql).drop("_in_sql", "_in_any", "_in_open", "_in_head")


def table_and_index_statements(x) -> Column:
    """CREATE TABLE and CREATE INDEX statements joined by blank lines."""
    return F.array_join(F.transform(_all(x, fv.TABLE_OR_INDEX_STATEMENT), strip), "\n\n")


def table_statements(x) -> Column:
    return F.transform(_all(x, fv.TABLE_STATEMENT), strip)


def index_statements(x) -> Column:
    return F.transform(_all(x, fv.INDEX_STATEMENT), strip)


def create_table_span(x) -> Column:
    """From the first complete CREATE TABLE statement to the last semicolon, or null."""
    return non_empty(strip(F.regexp_extract(F.coalesce(col(x), F.lit("")), r"(?isU)(CREATE\s+TABLE\b.*;)", 1)))


def ddl_from_response(x) -> Column:
    """DDL of a growth response; null for an empty response.

    The last sqlite block, sql block, block of any kind, or the span of CREATE TABLE
    statements is reduced to its CREATE TABLE and CREATE INDEX statements.  If that
    leaves nothing, the first block of any kind is used, else the whole text.
    """
    x = non_empty(x)
    open_tail = F.when(F.contains(x, F.lit("```sqlite")), strip(F.substring_index(x, "```sqlite", -1)))
    block = F.coalesce(
        non_empty(F.coalesce(_last(x, fv.SQLITE_FENCE), open_tail)),
        non_empty(F.coalesce(_last(x, fv.SQL_FENCE), open_tail)),
        non_empty(_last(x, fv.NAMED_FENCE)),
        create_table_span(x),
    )
    reduced = F.when(block.isNotNull(), table_and_index_statements(block)).otherwise(strip(x))
    first_block = strip(F.get(_all(x, fv.NAMED_FENCE), F.lit(0)))
    return F.when(x.isNotNull(), F.coalesce(non_empty(reduced), first_block, strip(x)))


def _block_or_text(x) -> Column:
    x = F.coalesce(col(x), F.lit(""))
    blocks = _all(x, r"(?isU)```plaintext\s*\n(.*?)```")
    return F.coalesce(F.try_element_at(blocks, F.lit(-1)), x)


def _cleaned(x, numbering: Callable[[Column], Column]) -> Column:
    """Non-empty lines of the last plaintext block, or of the text, without bullets and numbering."""
    lines = F.split(line_feeds(_block_or_text(x)), "\n")
    cleaned = F.transform(lines, lambda line: strip(numbering(strip(F.trim(strip(line), F.lit("-•"))))))
    return F.filter(cleaned, lambda line: line != "")


def question_lines(x) -> Column:
    """Lines of a question response; digits, dots, brackets and dashes are dropped once, in that order."""

    def once(line: Column) -> Column:
        for characters in ("0123456789", ".", ")", "-"):
            line = F.ltrim(line, F.lit(characters))
        return line

    return _cleaned(x, once)


def paraphrase_lines(x) -> Column:
    """Lines of a paraphrase response; any mix of leading digits, dots and brackets is dropped."""
    return _cleaned(x, lambda line: F.ltrim(line, F.lit(_DIGITS + ".)" + WS)))


def has_template_text(lines) -> Column:
    """Whether any line holds one of the placeholder strings."""

    def marked(line: Column) -> Column:
        return reduce(or_, [F.contains(line, F.lit(t)) for t in fv.TEMPLATE_STRINGS])

    return F.exists(lines, marked)


def without_self_reference(lines) -> Column:
    """Drop lines that mention paraphrasing."""
    return F.filter(lines, lambda s: ~F.contains(F.lower(s), F.lit("paraphrase")))


def with_new_wordings(df: DataFrame, lines: str, original: str, n: int, name: str) -> DataFrame:
    """Add the first n lines whose normal form differs from the original and from earlier lines.

    Works inside the row: distinct normal forms in first-seen order, the original's
    form taken out, then each form's first line.
    """
    forms = computed(df, _forms=F.transform(lines, normalize))
    own = normalize(F.coalesce(original, F.lit("")))
    kept = computed(forms, _kept=F.slice(F.array_remove(F.array_distinct("_forms"), own), 1, n))
    line = F.transform("_kept", lambda f: F.get(F.col(lines), F.array_position("_forms", f).cast("int") - 1))
    return kept.withColumn(name, line).drop("_forms", "_kept")
