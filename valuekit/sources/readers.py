"""Reading raw season files and the tables made from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.scale import attach

LINE = "line_order"
FILE = "file_path"
CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, names: Sequence[str], glob: str = "*.csv", quoted_breaks: bool = False) -> DataFrame:
    """All CSV files of a folder under fixed positional names, as text.

    Headers of one or two rows are read as data (naming is by position) and removed later by their content.
    ``line_order`` gives the place of a line in its file, ``file_path`` the file. ``quoted_breaks`` reads line breaks inside quotes
    as text; a file is then read by one task, while otherwise large files are split.
    """
    fields = [T.StructField(n, T.StringType()) for n in [*names, CORRUPT]]
    raw = (
        spark.read.schema(T.StructType(fields))
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .option("multiLine", quoted_breaks)
        .csv(path)
    )
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return raw.withColumn(FILE, F.col("_metadata.file_path")).withColumn(LINE, line)


def split_short_files(raw: DataFrame, last_name: str) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): a file in which no line reaches the last expected column is rejected as a whole."""
    widths = raw.groupBy(FILE).agg(F.max(F.col(f"`{last_name}`").isNotNull()).alias("__wide"))
    marked = attach(raw, widths, [FILE])
    return marked.filter("__wide").drop("__wide", CORRUPT), marked.filter("NOT __wide").drop("__wide")


def read_header_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """CSV files with one header row; columns by name, all text, with file and line order."""
    raw = spark.read.option("header", True).option("pathGlobFilter", glob).csv(path)
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return raw.withColumn(FILE, F.col("_metadata.file_path")).withColumn(LINE, line)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One Parquet table; any other suffix is an error."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in name and not name.lower().endswith(".parquet"):
        raise ValueError(f"not a Parquet file or folder: {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; columns by name, gaps NULL."""
    if not tables:
        raise FileNotFoundError("no tables to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_tables(spark: SparkSession, folder: str, glob: str = "updated_*.parquet") -> DataFrame:
    """All matching Parquet files of a folder as one table, columns merged by name."""
    hadoop_glob = f"{folder.rstrip('/')}/{glob}"
    try:
        return spark.read.option("mergeSchema", True).parquet(hadoop_glob)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"{folder} holds nothing like {glob!r}") from error
        raise


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")


def season_grid(leagues: DataFrame, seasons: Sequence[str]) -> DataFrame:
    """Page address of every (league, base_url) in every listed season."""
    grid = leagues.withColumn("season", F.explode(F.array(*[F.lit(s) for s in seasons])))
    season, league = F.replace("season", F.lit("-"), F.lit("_")), F.replace("league", F.lit("-"), F.lit("_"))
    return grid.withColumn("url", F.concat("base_url", "season", F.lit("/stats/"), season, F.lit("-"), league, F.lit("-Stats")))
