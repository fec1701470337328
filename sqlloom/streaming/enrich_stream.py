"""Incremental enrichment of JSON-lines files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sqlloom.plans.enrich import enrich
from sqlloom.sources.jsonl import parsed

TRIPLET = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("prompt", "sql_statement", "schema", "cmd_type")]
)


def enriched_stream(spark: SparkSession, path: str, schema: T.StructType = TRIPLET, keep: str | None = "1 day") -> DataFrame:
    """Enriched records of new files, each (schema, question) once within ``keep`` of its arrival, or once for good with None.

    Fields beyond ``schema`` stay as one JSON text in the column ``rest``.

    The state is one hash per record.  With ``keep`` it expires with the watermark on arrival time, so
    it does not grow with the age of the stream; a later repeat passes again.  Without, it is a key table that the
    checkpoint holds and every batch adds to, dealt out over the shuffle partitions; a session with
    RocksDB as state store keeps it on disk.
    """
    lines = spark.readStream.text(path).withColumnRenamed("value", "line")
    records = enrich(parsed(lines, schema, rest="rest")).withColumns(
        {
            "arrived_at": F.current_timestamp(),
            "record_key": F.sha2(F.concat_ws("\x1f", F.col("schema"), F.col("question")), 256),
        }
    )
    if keep is None:
        return records.dropDuplicates(["record_key"])
    return records.withWatermark("arrived_at", keep).dropDuplicatesWithinWatermark(["record_key"])


def stream_enrich(
    spark: SparkSession, path: str, out: str, checkpoint: str, schema: T.StructType = TRIPLET, keep: str | None = "1 day"
) -> StreamingQuery:
    """Process all files that are there now, append the result to ``out``, and stop.

    The parquet sink records finished batches, so a restart from the same checkpoint
    neither loses nor repeats rows.
    """
    return (
        enriched_stream(spark, path, schema, keep)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
