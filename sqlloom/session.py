"""Session settings and the shared work folder."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that suit these jobs; a session that already exists keeps its own.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sqlloom")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may do
    without; it gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), f"sqlloom-{spark.sparkContext.applicationId}")
    return named.rstrip("/")


def run_folder(spark: SparkSession, job: str) -> str:
    """A fresh folder below the shared work folder for one run of a job."""
    return f"{work_folder(spark)}/{job}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def committed_folders(spark: SparkSession, folder: str) -> list[str]:
    """Sub-folders that a writer has finished."""
    there = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(there):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(there) if s.isDirectory()]
    return sorted(f for f in found if path_exists(spark, f"{f}/_SUCCESS"))


def opened_run(spark: SparkSession, job: str, folder: str | None, parameters: dict) -> str:
    """A folder for the answers of a run: a new one, or that of an earlier run with the same parameters.

    Other parameters than those of the earlier run are refused.
    """
    told = json.dumps(parameters, sort_keys=True, default=str)
    folder = folder or run_folder(spark, job)
    note = f"{folder}/parameters"
    if path_exists(spark, f"{note}/_SUCCESS"):
        held = spark.read.text(note).first()[0]
        if held != told:
            raise ValueError(f"{folder} belongs to a run with other parameters: {held}, not {told}")
    else:
        spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return folder


def content_mark(*tables: DataFrame) -> str:
    """A mark of the tables' rows, whatever their order; one pass over each."""
    marks = []
    for df in tables:
        # Hashes don't take maps or variants; their JSON text does.
        values = [
            F.to_json(F.struct(F.col(f"`{f.name}`"))) if re.search("map<|variant", f.dataType.simpleString()) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
        found = df.select(F.xxhash64(*values).alias("h")).agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("h")))
        marks.append([df.columns, *map(str, found.first())])
    return hashlib.sha256(json.dumps(marks).encode()).hexdigest()[:24]


class Steps:
    """The written tables of one run, by name, in the run's folder: a ledger of what is done.

    A run that gets the folder of a broken one, with the same settings and the same input rows, finds the
    tables that were finished and goes on behind them; what was half written is replaced.  Other input has
    steps of its own.  ``made`` and ``found`` name the tables that were written and those that were there.
    """

    def __init__(self, spark: SparkSession, folder: str, *inputs: DataFrame, **settings):
        self.spark, self.made, self.found = spark, [], []
        told = json.dumps([content_mark(*inputs), settings], sort_keys=True, default=str)
        self.folder = f"{folder}/steps-{hashlib.sha256(told.encode()).hexdigest()[:24]}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table ``name``, built and written unless an earlier run has finished it."""
        path = f"{self.folder}/{name}"
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            self.found.append(name)
            return self.spark.read.parquet(path)
        done = written(build(), path)
        self.made.append(name)
        return done


def remove_run(spark: SparkSession, folder: str) -> bool:
    """Delete a run's folder, once nothing reads its tables any more."""
    there = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: later steps neither repeat its work nor keep its lineage.

    A table that this run has finished is read as it is; what a broken attempt left half
    written is replaced.
    """
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
