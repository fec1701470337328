"""DDL-text expressions: table and column counts, top-level splitting, foreign keys, rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.sqltext import strip_comments_naive, strip_comments_quoted
from sqlloom.functions.text import col, strip

_SPAN = r"'[^']*+(?:'|\z)|\"[^\"]*+(?:\"|\z)|`[^`]*+(?:`|\z)"
_PIECE = rf"({_SPAN}|[(),]|[^'\"`(),]++)"
_NAME = r"(?:[\w.]+|\"[^\"]+\"|`[^`]+`|\[[^\]]+\])"
_STRINGS = "array<string>"


def _count(x, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(col(x), F.lit("")), F.lit(pattern))


def table_count_with_temporary(ddl) -> Column:
    """CREATE TABLE and CREATE TEMPORARY TABLE; CREATE TEMP TABLE does not count."""
    return _count(ddl, fv.CREATE_TEMPORARY_TABLE)


def table_count(ddl) -> Column:
    """CREATE TABLE, also inside comments."""
    return _count(ddl, fv.CREATE_TABLE)


def table_count_uncommented(ddl) -> Column:
    """CREATE TABLE outside comments."""
    return F.regexp_count(strip_comments_quoted(F.coalesce(col(ddl), F.lit(""))), F.lit(fv.CREATE_TABLE))


def split_top_level(text) -> Column:
    """Trimmed parts between commas that are outside brackets and quotes.

    Folds over pieces (quoted spans, brackets, commas, runs of other text) instead of
    characters, so that the fold stays short.
    """
    pieces = F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(_PIECE), F.lit(1))
    start = F.struct(
        F.lit(0).alias("depth"), F.lit("").alias("part"), F.array().cast(_STRINGS).alias("parts")
    )

    def step(acc, piece):
        depth, part, parts = acc["depth"], acc["part"], acc["parts"]
        cut = (piece == ",") & (depth == 0)
        return F.struct(
            F.when(piece == "(", depth + 1)
            .when(piece == ")", F.greatest(F.lit(0), depth - 1))
            .otherwise(depth)
            .alias("depth"),
            F.when(cut, F.lit("")).otherwise(F.concat(part, piece)).alias("part"),
            F.when(cut, F.array_append(parts, part)).otherwise(parts).alias("parts"),
        )

    def finish(acc):
        return F.when(acc["part"] == "", acc["parts"]).otherwise(F.array_append(acc["parts"], acc["part"]))

    return F.transform(F.aggregate(pieces, start, step, finish), strip)


def column_definitions(body) -> Column:
    """Parts of a table body that define columns."""
    words = r"(?iU)\A(?:" + "|".join(fv.TABLE_CONSTRAINT_WORDS) + r")\b"
    return F.filter(split_top_level(body), lambda p: (p != "") & ~F.regexp_like(p, F.lit(words)))


def column_count(ddl) -> Column:
    """Column definitions over all CREATE TABLE statements that end in a bracket and a semicolon."""
    bodies = F.regexp_extract_all(F.coalesce(col(ddl), F.lit("")), F.lit(fv.TABLE_BODY), F.lit(1))
    return F.aggregate(bodies, F.lit(0), lambda n, body: n + F.size(column_definitions(body)))


def has_foreign_key(ddl) -> Column:
    return F.regexp_like(strip_comments_naive(F.coalesce(col(ddl), F.lit(""))), F.lit(fv.FOREIGN_KEY_WORDS))


_ACTIONS = (
    r"(?:\s+ON\s+(?:DELETE|UPDATE)\s+(?:SET\s+NULL|SET\s+DEFAULT|NO\s+ACTION|\w+)"
    r"|\s+MATCH\s+\w+|\s+(?:NOT\s+)?DEFERRABLE|\s+INITIALLY\s+\w+)*+"
)
_REFERENCES = rf"REFERENCES\s+{_NAME}(?:\s*\([^)]+\))?{_ACTIONS}"
_KEY = rf"(?:CONSTRAINT\s+{_NAME}\s+)?FOREIGN\s+KEY\s*\([^)]+\)\s*{_REFERENCES}"


def strip_foreign_keys(ddl) -> Column:
    """Remove comments and every foreign key: altered in, table level or inline.

    Two-word actions and quoted parent names are understood.
    """
    text = strip_comments_naive(col(ddl))
    for pattern, new in (
        (rf"(?iU)\bALTER\s+TABLE\b[^;]*?\bADD\s+{_KEY}\s*;", ""),
        (rf"(?imU)(?:^\s*|,\s*){_KEY}(?=\s*,|\s*\)|\s*$)", ""),
        (rf"(?iU)\b{_REFERENCES}", ""),
        (r",\s*\)", ")"),
        (r"\n{3,}", "\n\n"),
        (r"[ \t]+\n", "\n"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return text


def foreign_key_action(x) -> Column:
    table = F.create_map(*[F.lit(v) for pair in fv.FOREIGN_KEY_ACTIONS.items() for v in pair])
    return F.coalesce(F.element_at(table, x), x)


def _quote_protected(name: Column) -> Column:
    names = [w.lower() for w in fv.RENDER_QUOTED_NAMES]
    return F.when(F.lower(name).isin(*names), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(name)


def _rendered_column(c: Column) -> Column:
    name = F.when(F.regexp_like(c["NAME"], F.lit(r"(?U)\A\d")), F.concat(F.lit('"'), c["NAME"], F.lit('"'))).otherwise(
        _quote_protected(c["NAME"])
    )
    known = F.lower(c["TYPE"]).isin(*[t.lower() for t in fv.ACCEPTED_TYPES])
    quoted = F.concat(F.lit("'"), F.replace(c["DEFAULT"], F.lit("'"), F.lit("")), F.lit("'"))
    default = F.concat(F.lit(" DEFAULT "), F.when(c["DEFAULT_BARE"], c["DEFAULT"]).otherwise(quoted))
    return F.concat(
        name,
        F.lit(" "),
        F.when(known, c["TYPE"]).otherwise(F.lit("TEXT")),
        F.when(c["NULLABLE"], F.lit("")).otherwise(F.lit(" NOT NULL")),
        F.when(c["UNIQUE"], F.lit(" UNIQUE")).otherwise(F.lit("")),
        F.when(F.coalesce(c["DEFAULT"], F.lit("")) != "", default).otherwise(F.lit("")),
    )


def _rendered_key(k: Column) -> Column:
    parent = _quote_protected(F.replace(k["FOREIGN_TABLE"], F.lit("."), F.lit("_")))
    on_delete, on_update = foreign_key_action(k["ON_DELETE"]), foreign_key_action(k["ON_UPDATE"])
    return F.concat(
        F.lit("FOREIGN KEY ("), F.array_join(k["COLUMNS"], ", "), F.lit(") REFERENCES "), parent,
        F.lit(" ("), F.array_join(k["REFERRED_COLUMNS"], ", "), F.lit(")"),
        F.when(F.coalesce(on_delete, F.lit("")) != "", F.concat(F.lit(" ON DELETE "), on_delete)).otherwise(F.lit("")),
        F.when(F.coalesce(on_update, F.lit("")) != "", F.concat(F.lit(" ON UPDATE "), on_update)).otherwise(F.lit("")),
    )



def is_renderable(table) -> Column:
    """A table renders when it has a name and a column list in which every column is named."""
    table = col(table)
    return F.coalesce(
        (table["TABLE_NAME"].isNotNull())
        & (table["COLUMNS"].isNotNull())
        & ~F.exists(table["COLUMNS"], lambda c: F.coalesce(c["NAME"], F.lit("")) == ""),
        F.lit(False),
    )


def render_table(table) -> Column:
    """CREATE TABLE text of one nested table record; null when it is not renderable."""
    table = col(table)
    columns = F.transform(table["COLUMNS"], _rendered_column)
    primary = F.when(
        F.size(table["PRIMARY_KEY"]) > 0,
        F.array(F.concat(F.lit("PRIMARY KEY ("), F.array_join(table["PRIMARY_KEY"], ", "), F.lit(")"))),
    ).otherwise(F.array().cast(_STRINGS))
    whole = F.filter(
        table["FOREIGN_KEYS"],
        lambda k: (F.size(k["COLUMNS"]) > 0)
        & (F.coalesce(k["FOREIGN_TABLE"], F.lit("")) != "")
        & (F.size(k["REFERRED_COLUMNS"]) > 0),
    )
    keys = F.coalesce(F.transform(whole, _rendered_key), F.array().cast(_STRINGS))
    name = F.translate(_quote_protected(table["TABLE_NAME"]), ".-", "__")
    text = F.concat(
        F.lit("CREATE TABLE "), name, F.lit(" (\n  "),
        F.array_join(F.concat(columns, primary, keys), ",\n  "), F.lit("\n);"),
    )
    return F.when(is_renderable(table), text)


def render_schema(tables) -> Column:
    """All renderable tables of a record, in order, joined by blank lines."""
    return F.array_join(F.transform(F.filter(tables, is_renderable), render_table), "\n\n")


def statement_name(statement) -> Column:
    """Name in a CREATE TABLE or CREATE INDEX statement, without quotes."""
    head = (
        rf"(?iU)\A\s*CREATE\s+(?:TEMP\s+|TEMPORARY\s+|UNIQUE\s+)?(?:TABLE|INDEX)\s+"
        rf"(?:IF\s+NOT\s+EXISTS\s+)?({_NAME})"
    )
    return unquote(F.regexp_extract(col(statement), head, 1))


def has_if_not_exists(statement) -> Column:
    return F.regexp_like(
        col(statement), F.lit(r"(?iU)\A\s*CREATE\s+(?:UNIQUE\s+)?(?:TABLE|INDEX)\s+IF\s+NOT\s+EXISTS\b")
    )


def unquote(name) -> Column:
    """A name without its quotes; doubled quotes inside become single ones."""
    inner = F.regexp_replace(name, r"\A[\"`\['](.*)[\"`\]']\z", "$1")
    for q in "\"`'":
        inner = F.when(F.startswith(name, F.lit(q)), F.replace(inner, F.lit(q * 2), F.lit(q))).otherwise(inner)
    return inner


_QUOTED = r"\"[^\"]*+(?:\"\"[^\"]*+)*+\"|`[^`]*+(?:``[^`]*+)*+`|\[[^\]]*+\]|'[^']*+(?:''[^']*+)*+'"
_TABLE_HEAD = (
    rf"(?isU)\A\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(?:(?:{_QUOTED}|[\w$]+)\s*\.\s*)?({_QUOTED}|[\w$]+)\s*\("
)


def without_comments(ddl) -> Column:
    """Comments become blanks; quoted text stays, whatever it holds."""
    kept = rf"((?:[^'\"`\[/-]++|{_QUOTED}|['\"`\[]|-(?!-)|/(?!\*))++)"
    parts = F.regexp_extract_all(F.coalesce(col(ddl), F.lit("")), F.lit(rf"(?s){kept}|--[^\n]*+|/\*.*?(?:\*/|\z)"), F.lit(1))
    return F.array_join(parts, " ")


def create_tables(ddl) -> Column:
    """Array of (name, body) of the tables that a schema text creates, each name's first definition only.

    Statements are cut at semicolons outside quotes and comments.  A name loses its quotes and its
    database; temporary tables and tables made from a SELECT are left out; what follows the
    last bracket of a statement is no part of the body.
    """
    cut = rf"(?s)((?:[^;'\"`\[]++|{_QUOTED}|['\"`\[])*+)(?:;|\z)"
    statements = F.regexp_extract_all(without_comments(ddl), F.lit(cut), F.lit(1))
    heads = F.filter(statements, lambda s: F.regexp_like(s, F.lit(_TABLE_HEAD)))
    tables = F.transform(
        heads,
        lambda s: F.struct(
            unquote(F.regexp_extract(s, _TABLE_HEAD, 1)).alias("name"),
            F.regexp_extract(F.regexp_replace(s, _TABLE_HEAD, ""), r"(?s)\A(.*)\)", 1).alias("body"),
        ),
    )
    return F.filter(tables, lambda t: ~F.startswith(F.lower(t["name"]), F.lit("sqlite_")))


def table_names(ddl) -> Column:
    return F.transform(create_tables(ddl), lambda t: t["name"])


def statement_body(statement) -> Column:
    """Text between the outer brackets of one CREATE TABLE statement."""
    return F.regexp_extract(col(statement), fv.TABLE_BODY, 1)


def definition_name(definition) -> Column:
    return unquote(F.regexp_extract(definition, rf"(?sU)\A({_QUOTED}|[^\s(]+)", 1))


def definition_type(definition) -> Column:
    """Declared type of a column definition: the words before its first constraint."""
    stop = "CONSTRAINT|PRIMARY|NOT|NULL|UNIQUE|CHECK|DEFAULT|COLLATE|REFERENCES|GENERATED|AS"
    pattern = (
        rf"(?isU)\A(?:{_QUOTED}|[^\s(]+)\s*"
        rf"((?:(?!(?:{stop})\b)\w+\s*)*+(?:\([^)]*\))?)"
    )
    return strip(F.regexp_extract(definition, pattern, 1))
