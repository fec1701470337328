"""Schema folders, directory listings, manifests, CSV lists and dispatch on a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlloom.functions.text import basename, computed, is_blank, strip
from sqlloom.operators.catalog import JSON_RECORD, RECORD, typed_defaults
from sqlloom.operators.gates import without_failed_names


def lenient_utf8(content) -> Column:
    """Binary content as text without its invalid bytes."""
    return F.replace(F.make_valid_utf8(F.col(content).cast("string")), F.lit("�"), F.lit(""))


def read_schemas(
    spark: SparkSession, folder: str, suffix: str = ".sql", recursive: bool = False, skip_failed: bool = False
) -> DataFrame:
    """(path, schema_file, schema_sql): one row per schema file, invalid bytes dropped.

    Order by path where an order matters; rows carry their path.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)
    named = files.select("path", basename("path").alias("schema_file"), lenient_utf8("content").alias("schema_sql"))
    return without_failed_names(named, "schema_file") if skip_failed else named


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, filename): parent folder and name of every file; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path")
    )
    return files.select(
        F.regexp_extract("path", r"\A(.*)/[^/]*\z", 1).alias("path"), basename("path").alias("filename")
    )


def manifest_paths(rows: DataFrame) -> DataFrame:
    """Add ``full_path`` to (path, filename): rows without a name go, an absolute name wins,
    an empty folder leaves the name as it is, otherwise folder and name are joined."""
    folder = strip(F.coalesce("path", F.lit("")))
    name = strip(F.coalesce("filename", F.lit("")))
    joined = F.when(F.startswith(name, F.lit("/")) | (folder == ""), name).when(
        F.endswith(folder, F.lit("/")), F.concat(folder, name)
    ).otherwise(F.concat(folder, F.lit("/"), name))
    return rows.where(name != "").withColumn("full_path", joined)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(full_path) from a CSV with the headers path and filename in any case, else one path per line."""
    table = spark.read.option("header", True).csv(path)
    names = {c.lower(): c for c in table.columns}
    if {"path", "filename"} <= names.keys():
        rows = table.select(F.col(f"`{names['path']}`").alias("path"), F.col(f"`{names['filename']}`").alias("filename"))
        return manifest_paths(rows).select("full_path")
    return spark.read.text(path).select(strip("value").alias("full_path")).where("full_path <> ''")


def split_by_existence(manifest: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manifest rows whose ``full_path`` is among the existing ones, and the rest."""
    have = existing.select("full_path").distinct()
    return manifest.join(have, "full_path", "left_semi"), manifest.join(have, "full_path", "left_anti")


def read_csv(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """CSV with a header and quotes doubled inside quotes; all strings.

    With ``line_breaks`` values may hold line breaks, but then one task reads each file.
    """
    return spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').csv(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_no, TABLES): nested schema records from JSON lines or parquet, with a fixed schema.

    Records are numbered from 0 in each file, in the order in which they stand there.
    """
    if path.rstrip("/").endswith(".parquet"):
        table = spark.read.schema(RECORD).parquet(path)
        return table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("record_no"), "TABLES")
    from sqlloom.sources.jsonl import numbered_lines

    lines = numbered_lines(spark, path).where(~is_blank("line"))
    parsed = computed(lines, record=F.from_json("line", JSON_RECORD))
    return parsed.select("file", F.col("line_no").alias("record_no"), typed_defaults(F.col("record.TABLES")).alias("TABLES"))


def _split_folder(spark: SparkSession, path: str) -> str:
    """The sub-folder ``train`` of a dataset folder, else its first one, else the folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path) or not fs.getFileStatus(jvm_path).isDirectory():
        return path
    folders = sorted(
        s.getPath().getName() for s in fs.listStatus(jvm_path)
        if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))
    )
    if not folders or any("=" in f for f in folders):
        return path
    return f"{path.rstrip('/')}/{'train' if 'train' in folders else folders[0]}"


def load(spark: SparkSession, spec: str, kind: str | None = None, schema=None, line_breaks: bool = False) -> DataFrame:
    """A dataset by path: format from the suffix, the train split of a folder of splits.

    Give a ``schema`` for JSON, or Spark reads all of it once more to infer one.

    Downloading from a hub is not built; such a spec is refused.
    """
    if spec.startswith("hf:"):
        raise ValueError("hub downloads are not supported; give the path of a copy")
    path = _split_folder(spark, spec)
    if kind is None:
        endings = {"jsonl": "json", "ndjson": "json", "json": "json", "csv": "csv", "parquet": "parquet"}
        kind = endings.get(spec.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet")
    if kind == "csv":
        return read_csv(spark, path, line_breaks)
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_document(spark: SparkSession, source: str | dict | DataFrame) -> DataFrame:
    """(tables) rows of an analysis document given as an object, a JSON text or a path."""
    import json

    schema = "files array<struct<tables:array<string>>>"
    if isinstance(source, DataFrame):
        return source.select("tables")
    if isinstance(source, str) and not source.lstrip().startswith("{"):
        document = spark.read.schema(schema).option("multiLine", True).json(source)
    else:
        text = json.dumps(source) if isinstance(source, dict) else source
        document = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", schema).alias("d")).select("d.*")
    return document.select(F.explode("files").alias("f")).select("f.tables")
