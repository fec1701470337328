"""What several operators share: words, ASCII case, shared tables, caches that outlive a task."""

from __future__ import annotations

import gc
import string
import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions.text import col
from sqlloom.session import remove_run, run_folder

# A word is a run of other characters than blank, tab and the four line and page breaks.
# bytes.split() without arguments splits at exactly these six, bytes.lower() changes A-Z only.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(x) -> Column:
    return F.translate(col(x), string.ascii_uppercase, string.ascii_lowercase)


def word_count(x) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(col(x), F.lit(WORD)), F.lit(0)).cast("bigint")


def text_bytes(x) -> Column:
    """The text as UTF-8 bytes, which Python tasks split and hash without decoding; null is empty."""
    return F.coalesce(col(x), F.lit("")).cast("binary")


def as_row(df: DataFrame) -> Column:
    """All columns as one, so that an operator's own columns can't meet a name of the caller's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def from_row(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``as_row`` again, some of them replaced."""
    return df.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table into a fresh folder of the shared work folder and read it back.

    Spark deletes shuffle files once the driver has collected what refers to them; asking for that
    after each written step keeps the disk at the needs of one step.  The listeners of a session hold on to
    the last query that has ended, so an empty one ends after the write.
    """
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.createDataFrame([], "nothing int").collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` has written and no later step reads."""
    for table in tables:
        remove_run(table.sparkSession, table.saved_at)


def task_cache() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions travel to the workers by value, so a module global would start empty in every task.
    """
    name = "sqlloom_task_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def joined_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes and links i-j: the smallest node that each node reaches."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label
