"""JSON lines: scan, quarantine of malformed lines, physical line numbers, slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlloom.functions.text import col, computed, is_blank, strip
from sqlloom.sources.sinks import watched

CORRUPT = "_corrupt"


def numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, line_no, line): physical 0-based line numbers in each file, blank lines included.

    A line's number is its place in its block plus the lines of the file's earlier
    blocks.  Blocks are counted first; the lines themselves are never sorted.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(shifts, ["file", "_block"]).select(
        "file", (F.col("_id") - F.col("_first") + F.col("_shift")).alias("line_no"), "line"
    )


def is_json_object(line) -> Column:
    """Whether a line is one complete JSON object with nothing after it.

    Spark's JSON functions stop at the end of the first value, so the line is put into an
    array and into an object: text after the value breaks at least one of them.
    """
    text = col(line)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    closed = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit("}"))).isNotNull()
    return F.coalesce(F.startswith(text, F.lit("{")) & alone & closed, F.lit(False))


def good_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines that hold a JSON object; blank and malformed lines go."""
    return lines.where(~is_blank(line) & is_json_object(strip(line)))


def malformed_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The lines that :func:`good_lines` drops and that are not blank, with an error column."""
    bad = ~is_blank(line) & ~is_json_object(strip(line))
    return lines.where(bad).withColumn(line, strip(line)).withColumn("error", F.lit("not a JSON object"))


def tagged_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Every line that isn't blank with ``status``, good or malformed; each line is looked at once."""
    status = F.when(is_blank(line), "blank").when(is_json_object(strip(line)), "good").otherwise("malformed")
    return computed(lines, status=status).where("status <> 'blank'")


def split_lines(lines: DataFrame, path: str, line: str = "line") -> tuple[DataFrame, DataFrame, dict]:
    """Good lines, malformed lines with an error column, and their numbers: one scan writes both to folders below ``path``."""
    out, seen = watched(tagged_lines(lines, line), **{s: F.count_if(F.col("status") == s) for s in ("good", "malformed")})
    out.write.partitionBy("status").parquet(path)
    back = lines.sparkSession.read.schema(out.schema).parquet(path)
    good, bad = (back.where(F.col("status") == s).drop("status") for s in ("good", "malformed"))
    return good, bad.withColumn(line, strip(line)).withColumn("error", F.lit("not a JSON object")), {s: seen.get[s] for s in ("good", "malformed")}


def parsed(lines: DataFrame, schema: T.StructType, line: str = "line", rest: str | None = None) -> DataFrame:
    """Typed columns from good lines, in place of the text; rows that break the schema go too.

    A line is parsed once; only what has parsed is tested for text after the object.  With
    ``rest``, all other fields of the object come as one JSON text under that name, null if
    there are none; :func:`whole_lines` puts them back.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    columns = {"_record": F.from_json(strip(line), full, options)}
    if rest:
        known = [f.name for f in schema.fields]
        others = F.map_filter(F.from_json(strip(line), "map<string,variant>"), lambda k, _: ~k.isin(*known))
        columns["_rest"] = F.when(F.size(others) > 0, F.to_json(others))
    fits = F.col("_record").isNotNull() & F.col(f"_record.{CORRUPT}").isNull()
    read = computed(lines.where(~is_blank(line)), **columns).where(F.when(fits, is_json_object(strip(line))).otherwise(False))
    return read.select(
        *[c for c in lines.columns if c != line], *[F.col(f"_record.`{f.name}`") for f in schema.fields],
        *([F.col("_rest").alias(rest)] if rest else []),
    )


def whole_lines(df: DataFrame, rest: str) -> DataFrame:
    """(line): one JSON object for each row, the fields in ``rest`` at its top level."""
    own = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != rest]), {"ignoreNullFields": "false"})
    joined = F.concat(F.left(own, F.length(own) - 1), F.when(own != "{}", F.lit(",")).otherwise(F.lit("")), F.substring(rest, 2, 2**31 - 1))
    return df.select(F.when(F.col(rest).isNull(), own).otherwise(joined).alias("line"))


def read_jsonl(spark: SparkSession, paths, schema: T.StructType, rest: str | None = None) -> DataFrame:
    """Records of one or several JSON-lines files; blank and malformed lines are dropped."""
    return parsed(spark.read.text(paths).withColumnRenamed("value", "line"), schema, rest=rest)


def line_slice(lines: DataFrame, number: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Lines whose physical number is in [start, end), then only the good ones."""
    keep = F.col(number) >= start
    if end is not None:
        keep = keep & (F.col(number) < end)
    return good_lines(lines.where(keep))
