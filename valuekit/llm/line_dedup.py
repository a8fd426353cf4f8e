"""Remove passages of lines that occurred before, anywhere in the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.text import let
from valuekit.scale import BROADCAST_BYTES, BROADCAST_ROWS, attach, settle, settled_size


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column, width: int) -> Column:
    """``(at, hash_a, hash_b)`` of each run of ``width`` lines that aren't all blank; 128 bits per run."""

    def windows(lines: Column) -> Column:
        def window(at: Column) -> Column:
            inside = [F.get(lines, at + k) for k in range(width)]
            filled = F.concat(*[F.trim(x) for x in inside]) != ""
            hashes = F.xxhash64(*inside).alias("hash_a"), F.xxhash64(F.lit("second"), *inside).alias("hash_b")
            return F.struct(at.alias("at"), *hashes, filled.alias("filled"))

        starts = F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width))
        return F.filter(F.transform(starts, window), lambda w: w["filled"])

    return let(_lines(text), windows)


def dedup_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``n_removed``, the number of lines cut.

    Every ``width`` consecutive lines form a window. Of equal windows the first one in order of ``doc_id`` (nulls first) and position
    stays; all lines that any later one covers go, overlapping ones merged. Lines compare as they stand. Windows of blank lines
    only are ignored, and so are texts of fewer lines than a window. ``n_chars``, if there, is brought up to date.

    Rows that repeat both ``doc_id`` and text count as one document and stay alike. A null text stays null with ``n_removed`` 0.
    A column ``n_removed`` of the input is replaced; an empty table stays empty.
    """
    keyed = docs.drop("n_removed").withColumn("__text", F.xxhash64("text"))
    cells = keyed.select("doc_id", "__text", F.explode(_windows(F.col("text"), width)).alias("w"))
    placed = cells.select("w.hash_a", "w.hash_b", F.struct("doc_id", "__text", "w.at").alias("place"))
    counted = placed.groupBy("hash_a", "hash_b").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    repeated = settle(counted.filter("n > 1").drop("n"))
    rows, size = settled_size(repeated)
    small = rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    later = placed.join(F.broadcast(repeated) if small else repeated, ["hash_a", "hash_b"]).filter("place != first")
    covered = later.groupBy("place.doc_id", "place.__text").agg(F.collect_set("place.at").alias("__starts"))
    known = attach(keyed, covered, ["doc_id", "__text"], split_hot=False)
    starts = F.flatten(F.transform("__starts", lambda s: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: s + k)))
    marked = known.withColumn("__gone", F.array_distinct(starts))
    kept = let(
        _lines(F.col("text")),
        lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")), lambda i: F.get(lines, i)),
    )
    untouched = F.col("__gone").isNull()
    done = marked.withColumn("text", F.when(untouched, F.col("text")).otherwise(F.array_join(kept, "\n")))
    done = done.withColumn("n_removed", F.when(untouched, 0).otherwise(F.size("__gone")).cast("long"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns if c != "n_removed"], "n_removed")
