"""Partitioned tables in whole versions: files are written beside the table, one manifest put in place last makes them visible.

A version is a manifest file with a number; it names the folder that holds each partition. Readers take the highest number, so they see a
version whole or not at all, and a job that fails on the way leaves nothing but a folder that no manifest names. Two jobs that change one version can't both
name the next one: the later one learns of it and starts again from the new version. File systems must rename a file without replacing another, in one step, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from valuekit.scale import col

MANIFEST = "manifest-{:010d}.json"


class Conflict(RuntimeError):
    """Another job has committed a version in the meantime."""


@dataclass(frozen=True)
class Version:
    """``parts``: folder of each partition, by its path inside (``league=x/season=2020``)."""

    number: int
    parts: dict[str, str]
    schema: str


def _path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions there are, oldest first."""
    return [int(n[9:-5]) for n in _names(spark, path) if n.startswith("manifest-") and n.endswith(".json")]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or the one asked for; None if there is none."""
    known = versions(spark, path)
    if number is None:
        number = known[-1] if known else None
    elif number not in known:
        raise ValueError(f"no version {number} in {path}")
    if number is None:
        return None
    held = json.loads(spark.read.text(f"{path}/{MANIFEST.format(number)}", wholetext=True).first()[0])
    return Version(number, held["parts"], held["schema"])


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the newest or the given version."""
    version = current(spark, path, number)
    if version is None:
        raise ValueError(f"no version in {path}")
    schema = T.StructType.fromJson(json.loads(version.schema))
    folders: dict[str, list[str]] = {}
    for part, folder in sorted(version.parts.items()):
        folders.setdefault(folder, []).append(part)
    tables = []
    for folder, parts in folders.items():
        base = f"{path}/{folder}"
        tables.append(spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" if p else base for p in parts]))
    # Partition columns come last from files; the table keeps its own order.
    return reduce(DataFrame.unionByName, tables).select(*[col(c) for c in schema.names]) if tables else spark.createDataFrame([], schema)


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders that a write has made."""
    parts = [""]
    for _ in range(depth):
        parts = [f"{p}/{n}".lstrip("/") for p in parts for n in _names(spark, f"{path}/{p}" if p else path) if "=" in n]
    return parts


def commit(df: DataFrame, path: str, by: Sequence[str] = (), base: Version | None = None, whole: bool = True) -> Version:
    """Write ``df`` as the version after ``base``; without ``whole`` only the partitions that occur in it are replaced.

    Raises ``Conflict``, with the table as it was, if the next number is taken.
    """
    spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(f"{path}/{folder}")
    parts = {p: folder for p in _partitions(spark, f"{path}/{folder}", len(by))}
    if not whole and base is not None:
        parts = {**base.parts, **parts}
    version = Version((base.number if base else 0) + 1, parts, df.schema.json())
    _publish(spark, path, version)
    return version


def _publish(spark: SparkSession, path: str, version: Version) -> None:
    files, draft = _path(spark, f"{path}/_{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(json.dumps({"parts": version.parts, "schema": version.schema}).encode()))
    out.close()
    final = _path(spark, f"{path}/{MANIFEST.format(version.number)}")[1]
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
    try:
        fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(draft), files.makeQualified(final), options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        raise Conflict(f"version {version.number} of {path} is there already") from error


def update(spark: SparkSession, path: str, by: Sequence[str], change: Callable[[DataFrame], DataFrame], tries: int = 10) -> Version:
    """Replace the partitions that ``change`` of the newest version returns; starts again where another job was faster."""
    for _ in range(tries):
        base = current(spark, path)
        if base is None:
            raise ValueError(f"no version in {path}")
        try:
            return commit(change(read_version(spark, path, base.number)), path, by, base, whole=False)
        except Conflict:
            continue
    raise Conflict(f"{tries} tries to change {path} met other changes")


def clean_up(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions and the folders that none of them names; no job may be writing. Returns the deleted entries."""
    known = versions(spark, path)
    kept = [current(spark, path, n) for n in known[-keep:]]
    named = {MANIFEST.format(v.number) for v in kept} | {folder for v in kept for folder in v.parts.values()}
    gone = [n for n in _names(spark, path) if n not in named and n.startswith(("manifest-", "data-", "_"))]
    for name in gone:
        files, place = _path(spark, f"{path}/{name}")
        files.delete(place, True)
    return len(gone)
