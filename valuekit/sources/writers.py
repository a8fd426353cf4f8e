"""Writing tables as partitioned Parquet or as CSV with a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame



def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("league", "season"), rows_per_file: int = 5_000_000) -> None:
    """Replace only the partitions present in ``df``. The rebalance gathers each partition's rows in few
    files and lets a partition that is too large for one task be written by several."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)
