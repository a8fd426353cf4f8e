"""Session defaults and the shared folder that cut lineage is written to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Batches to Python workers are bounded by bytes: rows may hold very long texts.
ARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Text aggregates (collect_set) keep hashing for more keys before they fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    **ARROW,
}


def build_session(app: str = "valuekit", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Make a session fit for this package, which is sent to the Python workers once per application: they may start anywhere."""
    context = spark.sparkContext
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    if not getattr(context, "_valuekit_sent", False):
        root = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="valuekit-"), "valuekit.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent).as_posix())
        context.addPyFile(archive)
        context._valuekit_sent = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for local sessions without one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="valuekit-")
    context.setCheckpointDir(folder)
    return folder


_WRITTEN: list[str] = []


def fresh_path(spark: SparkSession) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/valuekit-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what operators write to the shared folder inside the block. Results that are still needed have to be written elsewhere before it ends.

    Blocks may nest. Work that other threads do at the same time counts as the block's own.
    """
    before = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del _WRITTEN[before:]
