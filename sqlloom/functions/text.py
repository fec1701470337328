"""Plain-text expressions: trimming, lines, case folding, token counts, keyed hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv

# White space as Python's str.strip sees it, and the characters that end a line.  Native
# trim and translate over these sets are many times faster than patterns on long texts.
WS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(col(x), F.lit(WS))


def rstrip(x) -> Column:
    return F.rtrim(col(x), F.lit(WS))


def is_blank(x) -> Column:
    return F.coalesce(strip(x), F.lit("")) == ""


def non_empty(x) -> Column:
    """Null for the empty string."""
    return F.nullif(col(x), F.lit(""))


def collapse(x) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(F.translate(col(x), WS, " " * len(WS)), " {2,}", " ")


def line_feeds(x) -> Column:
    """Use ``\\n`` for every line break."""
    return F.translate(F.replace(col(x), F.lit("\r\n"), F.lit("\n")), LINE_ENDS, "\n" * len(LINE_ENDS))


def flatten(x) -> Column:
    """One line: every line break becomes a blank, ends are trimmed."""
    return strip(F.translate(line_feeds(F.coalesce(col(x), F.lit(""))), "\n", " "))


def unix_lines(x) -> Column:
    """Use ``\\n`` for every line break and drop one trailing break."""
    return F.regexp_replace(line_feeds(x), r"\n\z", "")


def normalize(x) -> Column:
    """Lower case with single blanks between words."""
    return F.lower(F.trim(collapse(x)))


def token_count(x) -> Column:
    return F.regexp_count(F.coalesce(col(x), F.lit("")), F.lit(fv.TOKEN_RUN))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    The optimizer copies an expression into every later filter and projection that uses
    it; for costly text expressions that multiplies the work.  A one-row generator is
    a boundary it does not copy across, and it stays in the same stage.
    """
    row = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select(*[c for c in df.columns if c not in columns], F.inline(row))


def stem(x) -> Column:
    """File name without folders and without its last suffix (a leading dot is no suffix)."""
    return F.regexp_replace(basename(x), r"(?<=[^/])\.[^./]*\z", "")


def basename(x) -> Column:
    return F.substring_index(col(x), "/", -1)


def keyed_hash(seed, *keys) -> Column:
    """32 hexadecimal digits that depend on the seed and the keys only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def keyed_bits(seed, *keys) -> Column:
    """The first 32 bits of the keyed hash as a long."""
    return F.conv(F.substring(keyed_hash(seed, *keys), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(seed, *keys) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only."""
    return keyed_bits(seed, *keys) / F.lit(4294967296.0)
