"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is a table of (digest, doc_id, n, known) in ``buckets`` buckets.  A batch of documents is
digested, grouped by digest (sums and maxima combine before the shuffle, so a text that a third
of all rows share costs one row a task), and dealt once into the index's own buckets; a
sort-merge anti-join drops what the index holds already, and the rest is appended.  The
index side is never shuffled.  Counts of known digests are appended too, as rows
with ``known`` set, so that nothing in the index is rewritten.

Within a batch the row with the largest doc_id stays; across batches what the index holds stays.

Defined cases: a null text counts as empty; a null doc_id loses against any other, and a group of
such rows has a null keep_id and no row marked as kept; repeated rows with the same doc_id are all
marked alike; an empty table leaves the index as it is; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlloom.llm.common import ascii_lower, saved
from sqlloom.session import path_exists, run_folder

# Buckets of a new index: at least so many, and more as its first batch is larger.
BUCKETS = 64
BUCKET_ROWS = 2_000_000


def digest(text) -> Column:
    """SHA-256 of the text with A-Z in lower case, 64 hexadecimal digits."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row, written once as everything else needs them."""
    return saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest")), "digests")


class DigestIndex:
    """A digest index in a folder that all executors share; opening a folder again goes on with it.

    The number of buckets is kept beside the folder.  It is the index's own from then on: another one is refused.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or run_folder(spark, "digest-index")
        note = f"{self.path}-buckets"
        if path_exists(spark, f"{note}/_SUCCESS"):
            held = int(spark.read.text(note).first()[0])
            if buckets not in (None, held):
                raise ValueError(f"{self.path} has {held} buckets, not {buckets}")
            buckets = held
        else:
            buckets = buckets or BUCKETS
            spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.mode("overwrite").text(note)
        self.buckets = buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, doc_id BIGINT, n BIGINT, known BOOLEAN) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        """The index as a bucketed table: joins on digest don't shuffle it."""
        return self.spark.table(self.table)

    def kept(self) -> DataFrame:
        """(digest, keep_id, group_size), read as plain files so that a hot digest can be split in a join."""
        if not path_exists(self.spark, self.path):
            return self.rows().select("digest", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"))
        plain = self.spark.read.schema(self.rows().schema).parquet(self.path)
        return plain.groupBy("digest").agg(
            F.max(F.when(~F.col("known"), F.col("doc_id"))).alias("keep_id"), F.sum("n").alias("group_size")
        )

    def add(self, batch: DataFrame) -> DataFrame:
        """Add (doc_id, digest) rows; returns what is new, (digest, doc_id, n)."""
        groups = saved(
            batch.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n")).repartition(self.buckets, "digest"),
            "digest-groups",
        )
        held = self.rows().where("not known").select("digest")
        fresh = groups.hint("merge").join(held.hint("merge"), "digest", "left_anti")
        again = groups.hint("merge").join(held.hint("merge"), "digest", "left_semi")
        added = saved(fresh.select("digest", "doc_id", "n", F.lit(False).alias("known")).union(again.select("digest", "doc_id", "n", F.lit(True).alias("known"))), "digest-added")
        added.repartition(self.buckets, "digest").write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode(
            "append"
        ).option("path", self.path).saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)
        return added.where("not known").select("digest", "doc_id", "n")


def decisions(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every digested row."""
    return rows.join(index.kept(), "digest").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Digest docs, add them to the index (a new one if none is given) and decide on each row."""
    rows = digests(docs)
    index = index or DigestIndex(docs.sparkSession, buckets=max(BUCKETS, -(-rows.count() // BUCKET_ROWS)))
    index.add(rows)
    return decisions(rows, index)
