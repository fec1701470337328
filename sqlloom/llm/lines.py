"""Line dedup by overlapping three-line windows (native).

A line counts when it has a character that is not blank; the lines that count are trimmed of
blanks and taken in windows of three, one starting at each line.  A window whose three lines
occurred before (smaller doc_id, or earlier in the same document) is a repeat, and all lines
that some repeat covers are removed; windows are judged on the input.  First occurrences stay.

Windows travel as two independent 64-bit hashes with their place, never as text.  Only windows
found more than once go back to their places, and the first place comes from a minimum that
combines before the shuffle, so a line that every document holds costs one row a task.

Defined cases: a null text has no lines and stays null; documents with fewer than three lines
that count stay as they are; blank lines between removed lines stay; repeated rows with
the same doc_id are one document that occurs twice, of which the copies keep what the first
keeps; rows without a doc_id come first among equals and are otherwise treated alike; other
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions.text import computed
from sqlloom.llm.common import BLANKS, as_row, from_row

LINES = 3


def lines_of(text) -> Column:
    return F.split(text, "\n")


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def _counted(text) -> Column:
    """The trimmed lines that count, as (place in the text, h1, h2)."""
    numbered = F.transform(lines_of(text), lambda x, i: F.struct(i.alias("line"), _trimmed(x).alias("x")))
    return F.transform(
        F.filter(numbered, lambda s: s["x"] != ""),
        lambda s: F.struct(s["line"].alias("line"), F.xxhash64(s["x"]).alias("h1"), F.xxhash64(F.lit(1), s["x"]).alias("h2")),
    )


def _windows(lines: int) -> Column:
    """Array of (place, h1, h2) of every window; place counts the lines that count, from 0."""

    def window(start):
        parts = [F.get(F.col("counted"), start + k) for k in range(lines)]
        return F.struct(
            start.alias("place"),
            F.xxhash64(*[p["h1"] for p in parts]).alias("h1"),
            F.xxhash64(F.lit(1), *[p["h2"] for p in parts]).alias("h2"),
        )

    return F.transform(F.sequence(F.lit(0), F.size("counted") - lines), window)


def repeated_places(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, mark, places): for each document, the starts of windows that occurred before.

    ``mark`` is a hash of the text, which tells rows with the same doc_id apart.
    """
    counted = computed(docs.where("text is not null").select("doc_id", "text"), counted=_counted(F.col("text")), mark=F.xxhash64("text"))
    places = counted.where(F.size("counted") >= lines).select("doc_id", "mark", F.inline(_windows(lines)))
    first = (
        places.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "mark", "place")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return (
        places.join(first, ["h1", "h2"])
        .where(~F.struct("doc_id", "mark", "place").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "mark")
        .agg(F.collect_set("place").alias("places"))
    )


def _cut_points(lines: int) -> Column:
    """Numbers of the lines that a repeated window covers, between -1 and the number of lines."""
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (lines - 1)))))
    removed = F.array_sort(F.transform(covered, lambda p: F.get(F.col("counted"), p)["line"]))
    return F.concat(F.array(F.lit(-1)), removed, F.array(F.size("lines")))


def _stretch(j) -> Column:
    before, after = F.get(F.col("cuts"), j), F.get(F.col("cuts"), j + 1)
    return F.slice(F.col("lines"), before + 2, after - before - 1)


def dedup_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """docs with the repeated lines taken out of ``text``; all rows and columns stay."""
    repeats = repeated_places(docs, lines)
    rows = docs.select(as_row(docs))
    own_text = F.col("_row.text")
    same = F.col("_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(own_text) == F.col("mark"))
    joined = rows.join(repeats, same, "left").select("_row", "places")
    hit = F.col("places").isNotNull()
    cut = computed(joined, lines=F.when(hit, lines_of(own_text)), counted=F.when(hit, _counted(own_text)))
    cut = computed(cut, cuts=F.when(hit, _cut_points(lines)))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), _stretch))
    return from_row(cut, docs.columns, text=F.when(hit, F.array_join(kept, "\n")).otherwise(own_text))
