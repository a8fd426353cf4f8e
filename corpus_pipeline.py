"""Corpus pipeline: the stages that turn ``documents`` into training tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.llm.line_dedup import dedup_lines
from valuekit.llm.mixing import mix_sources
from valuekit.llm.ngram_join import BROADCAST_IDS, ngram_join
from valuekit.llm.pieces import round_trip
from valuekit.llm.quality import classify_quality
from valuekit.scale import positions, settle, settled_size
from valuekit.session import ship


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, doesn't reject."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return classify_quality(docs, labels).filter("predicted = 1").select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of lines once. Documents of which nothing is left go."""
    deduped = dedup_lines(docs)
    return deduped.filter((F.col("n_removed") == 0) | (F.trim("text") != "")).select(*docs.columns)


def _key_rows(docs: DataFrame) -> DataFrame:
    """``docs`` numbered in ``__key``, one row for each ``doc_id`` and text; in order of ``doc_id``, nulls last."""
    same = ["doc_id", "__a", "__b"]
    printed = docs.withColumn("__a", F.xxhash64("text")).withColumn("__b", F.xxhash64(F.lit("second"), "text"))
    first = Window.partitionBy(*same).orderBy(F.xxhash64(*docs.columns))
    single = printed.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").drop("__nth")
    return settle(positions(settle(single), [], [F.col("doc_id").asc_nulls_last(), F.col("__a"), F.col("__b")], "__key"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8; the one with the smallest id stays.

    Rows of one ``doc_id`` and text become one first. Different texts under one ``doc_id``, and texts without one, are documents of their own: each
    stays or goes by its own links. Of a group, documents without ``doc_id`` stay only if none has one; equal ids are told apart by a hash of their texts.
    """
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id IS NULL OR n > 1")
    plain = odd.isEmpty()
    keyed = docs.withColumn("__key", F.col("doc_id")) if plain else _key_rows(docs)
    groups = ngram_join(keyed.select(F.col("__key").alias("doc_id"), "text"), words=5, similarity=0.8)
    dropped = settle(groups.filter("doc_id != component_id").select(F.col("doc_id").alias("__key")).distinct())
    small = settled_size(dropped)[0] <= BROADCAST_IDS
    return keyed.join(F.broadcast(dropped) if small else dropped, "__key", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in random order; a document may occur several times."""
    return mix_sources(docs, tempering=0.7).select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    checked = docs.select("doc_id", "source", "text", round_trip(F.col("text")).alias("both")).select("doc_id", "source", "text", "both.*")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return checked.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("same"))


STAGES = [
    ("quality classifier", keep_quality), ("line dedup", cut_lines), ("n-gram jaccard join", drop_copies),
    ("mixing to target weights", mix), ("sentencepiece", to_pieces),
]

# Boosted trees, the join's components and the pieces can't be said in SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
