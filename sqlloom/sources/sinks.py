"""Writers: JSON lines, CSV, growth steps, quarantine, numbered folders, sharded publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sqlloom.functions import fixed_values as fv
from sqlloom.functions.text import computed
from sqlloom.operators.ranking import with_chunk
from sqlloom.session import run_folder, written


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line with all keys, nulls included; text stays UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_growth_steps(log: DataFrame, path: str, mode: str = "append") -> None:
    """What each round of growth added to each schema, in files by round.

    A file per schema and step would mean millions of tiny files that repeat the text so far;
    ``plans.growth.versions`` puts the whole texts of all steps together again.
    """
    log.select("round_no", "schema_file", "num_tables", "added").write.mode(mode).partitionBy("round_no").parquet(path)


def write_quarantine(rows: DataFrame, path: str, reason: str, mode: str = "append") -> None:
    """Rejected rows with their reason as a column, in folders by reason."""
    rows.write.mode(mode).partitionBy(reason).parquet(path)


def quarantine_text(text: str, error: str):
    """A rejected text with its error as a comment in front."""
    return F.concat(F.lit(fv.QUARANTINE_HEAD), F.coalesce(error, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def write_chunks(df: DataFrame, order: str, size: int, path: str, mode: str = "errorifexists") -> None:
    """Numbered folders chunk=1, 2, ... of ``size`` rows each in the order of a unique column."""
    chunked = with_chunk(df, order, size, "chunk", first=1)
    chunked.repartition("chunk").write.mode(mode).partitionBy("chunk").parquet(path)


# Rows are sized by the first bits of their hash: 65,536 cells, a bounded table.
CELLS = 1 << 16
# A cell above this part of a shard is split; its pieces are this much smaller again.
GRAINS = 8


def sized_shards(df: DataFrame, megabytes: float) -> DataFrame:
    """Add ``shard``: rows of a shard hold at most so many megabytes as JSON text.

    A size histogram in up to three levels: bytes are added up by the first bits of a row hash; cells that hold too
    much for a shard's grain are cut by the rest of the hash; pieces that still do hold equal rows, which are
    written with a row number and cut by that.  Cells and pieces follow each other in one order, prefix sums of
    their bytes give the shard.  A shard is larger only where a single row is.  The tables of cells and pieces grow with the number of
    shards, not of rows, and reach the rows by a join.
    """
    folder, limit = run_folder(df.sparkSession, "publish"), int(megabytes * 1_000_000)
    grain, none = max(1, limit // GRAINS), F.lit(-1).cast("bigint")
    columns = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = computed(df.select(columns.alias("_row")), _text=F.to_json("_row"))
    rows = rows.select("_row", F.octet_length("_text").alias("_bytes"), F.xxhash64("_text").alias("_hash"))
    rows = rows.withColumns({"_cell": F.shiftrightunsigned("_hash", 48), "_piece": none, "_turn": none})
    total = F.sum("_bytes").alias("_bytes")

    def too_large(sums, parts):
        return sums.where(F.col("_bytes") > grain).withColumn(parts, F.ceil(F.col("_bytes") * GRAINS / grain).cast("bigint")).drop("_bytes")

    sums = written(rows.groupBy("_cell").agg(total), f"{folder}/cells")
    large = too_large(sums, "_pieces")
    ends = sums.where(F.col("_bytes") <= grain).select("_cell", none.alias("_piece"), none.alias("_turn"), "_bytes")
    if not large.isEmpty():
        # At most CELLS rows.
        piece = F.coalesce(F.pmod(F.xxhash64("_hash"), F.col("_pieces")), none)
        rows = rows.join(F.broadcast(large), "_cell", "left").withColumn("_piece", piece).drop("_pieces")
        sums = written(rows.where("_piece >= 0").groupBy("_cell", "_piece").agg(total), f"{folder}/pieces")
        equal = too_large(sums, "_turns")
        ends = ends.unionByName(sums.where(F.col("_bytes") <= grain).select("_cell", "_piece", none.alias("_turn"), "_bytes"))
        if not equal.isEmpty():
            numbered = written(rows.join(equal, ["_cell", "_piece"]).withColumn("_number", F.monotonically_increasing_id()), f"{folder}/equal-rows")
            numbered = numbered.withColumn("_turn", F.pmod("_number", F.col("_turns"))).drop("_number", "_turns")
            ends = ends.unionByName(numbered.groupBy("_cell", "_piece", "_turn").agg(total))
            rows = rows.join(equal, ["_cell", "_piece"], "left_anti").unionByName(numbered)
    ends = written(ends, f"{folder}/ends")
    # Sums before a cell, of at most CELLS rows, and before a piece inside its cell.
    upto = Window.partitionBy(F.lit(0)).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.groupBy("_cell").agg(F.sum("_bytes").alias("_all")).select("_cell", F.coalesce(F.sum("_all").over(upto), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_cell").orderBy("_piece", "_turn").rowsBetween(Window.unboundedPreceding, -1)
    # A shard starts at a multiple of the step and ends with the piece that reaches the next one.
    step = max(1, limit - (ends.agg(F.max("_bytes")).first()[0] or 0))
    before = F.col("_start") + F.coalesce(F.sum("_bytes").over(inside), F.lit(0))
    shards = ends.join(starts, "_cell").select("_cell", "_piece", "_turn", F.floor(before / step).alias("shard"))
    placed = rows.join(written(shards, f"{folder}/shards"), ["_cell", "_piece", "_turn"])
    return placed.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], "shard")


def publish(
    df: DataFrame, path: str, split: str = "train", megabytes: float = 500, files: int | None = None,
    mode: str = "errorifexists",
) -> dict:
    """Sharded parquet below ``path/split``; rows and columns written.

    Folders shard=0, 1, ... of one file each keep the size limit; ``files`` deals out so many files of any size instead.
    """
    out, seen = watched(df.repartition(files) if files else sized_shards(df, megabytes).repartition("shard"))
    writer = out.write.mode(mode)
    (writer if files else writer.partitionBy("shard")).parquet(f"{path.rstrip('/')}/{split}")
    return {"rows": seen.get["rows"], "columns": df.columns}


def published(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """(shard, rows, bytes): what is in each shard of a publication, by the JSON text that the limit is about."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/{split}")
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "shard"]))
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(text)).alias("bytes"))


def watched(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that knows their number once they have been written.

    Totals come from the pass that writes the rows; nothing is counted again.
    """
    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), **metrics}
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen
