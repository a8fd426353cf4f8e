"""Repair the structure of conversations: cheapest edits that make roles alternate, by tables over blocks of rows.

Rows are put in order by one range shuffle of keys and digests; texts stay behind. A conversation is cut into segments of at most ``SEGMENT`` rows,
whose effect on cost vectors, and then on states, is a small map. Maps compose, so a conversation of any length is scanned level by level, and each
segment is traced on its own. Texts move once, to the task that streams through their conversation beside the letters of its edits.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuekit.llm.turn_blocks import AFTER, DELETE, DONE, INSERT, KEEP, MUST_GO, NAME, OTHER, REROLE, START, STATES, tables
from valuekit.scale import attach, null_safe_join, settle, settled_size

BLANK = " \t\n\x0b\x0c\r"
# Rows of a segment, and children of a node above, as powers of two.
SEGMENT_BITS = 12
FAN_BITS = 10
ROLES = ["s", "u", "a"]
FLAWS = ["blank", "duplicate", "truncated"]
KEY = ["turn", "role", "digest"]
ORDER = ["conv_id", *KEY]


def _plain(rows: DataFrame) -> DataFrame:
    """The four columns, null roles and texts as one space."""
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("digest")


def _placed(rows: DataFrame, segment_bits: int) -> DataFrame:
    """Rows without texts in global order: ``slot`` rises with it, and ``node`` names the segment."""
    bare = F.rtrim("text", F.lit(BLANK))
    keyed = rows.select(
        "conv_id", "turn", "role", _digest(), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.spark_partition_id().alias("from"),
    )
    # Equal rows may take any order, but must not pile up in one range: the partition they come from parts them.
    ranged = keyed.repartitionByRange(*ORDER, "from").sortWithinPartitions(*ORDER, "from").drop("from")
    placed = settle(ranged.withColumn("slot", F.monotonically_increasing_id()))
    told = ["conv_id", "role", "digest"]
    groups = placed.filter("NOT blank").groupBy(*told).agg(F.count("*").alias("n"), F.min("slot").alias("first"))
    seen = attach(placed, groups.filter("n > 1").drop("n"), told)
    initial = F.substring("role", 1, 1)
    role = sum((F.when(initial == r, k - OTHER).otherwise(0) for k, r in enumerate(ROLES)), F.lit(OTHER))
    flaw = F.when(F.col("blank"), "blank").when(F.col("first") < F.col("slot"), "duplicate").when(F.col("truncated"), "truncated")
    return seen.select("conv_id", *KEY, "slot", F.shiftright("slot", segment_bits).alias("node"), flaw.alias("flaw"), role.alias("class"))


def _symbols(cells: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(classes, symbols of the tables) of cells ``class + 4 * truncated + 8 * has to go``."""
    cells = np.asarray(cells, np.int64)
    return cells % 4, np.where(cells >= 8, MUST_GO, cells)


def _scan(maps: DataFrame, start: int, backward: bool, fan_bits: int) -> DataFrame:
    """``(conv_id, node, value)``: ``start`` taken through the maps of all nodes behind (``backward``) or in front of each node.

    ``map`` holds at each value the one that the node leads to. A task holds the children of one node, never a conversation.
    """
    children = F.array_sort(F.collect_list(F.struct(F.col("node").alias("child"), "map")))
    parents = settle(maps.groupBy("conv_id", F.shiftright("node", fan_bits).alias("node")).agg(children.alias("children")))

    @F.pandas_udf("array<int>")
    def composed(rows: pd.Series) -> pd.Series:
        def compose(children) -> np.ndarray:
            order = children[::-1] if backward else children
            at = np.arange(len(order[0]))
            for child in order:
                at = np.asarray(child)[at]
            return at

        return rows.map(compose)

    @F.pandas_udf("array<int>")
    def spread(rows: pd.Series, first: pd.Series) -> pd.Series:
        def run(children, value: int) -> list[int]:
            values = []
            for child in children[::-1] if backward else children:
                values.append(value)
                value = int(child[value])
            return values[::-1] if backward else values

        return pd.Series([run(c, int(v)) for c, v in zip(rows, first)], dtype=object)

    # Conversations that one node holds begin with ``start``; the others' nodes are scanned a level up.
    several = settle(parents.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    if settled_size(several)[0] == 0:
        begun = parents.withColumn("value", F.lit(start))
    else:
        inner = attach(parents, several.withColumn("more", F.lit(True)), ["conv_id"]).filter("more")
        above = _scan(inner.select("conv_id", "node", composed("children.map").alias("map")), start, backward, fan_bits)
        begun = attach(parents, above, ["conv_id", "node"], split_hot=False).withColumn("value", F.coalesce("value", F.lit(start)))
    cells = F.arrays_zip(F.col("children.child").alias("node"), spread("children.map", "value").alias("value"))
    return begun.select("conv_id", F.explode(cells).alias("cell")).select("conv_id", "cell.node", "cell.value")


# What a segment is entered with: the state, and the class of the row in front of it (4: none).
NONE = 4
ENTRIES = STATES * (NONE + 1)


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether a role may follow another: su, ua or au."""
    return ((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1))


INTS = T.ArrayType(T.IntegerType())
TRACED = T.StructType([T.StructField("letters", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("illegal", T.LongType())])


@F.pandas_udf(INTS)
def _vector_map(cells: pd.Series) -> pd.Series:
    return cells.map(lambda c: tables().backward(_symbols(c)[1]))


@F.pandas_udf(INTS)
def _state_map(cells: pd.Series, behind: pd.Series) -> pd.Series:
    def run(row, vector: int) -> list[int]:
        classes, symbols = _symbols(row)
        places, _, _ = tables().boundaries(symbols, vector)
        leaves = [tables().trace(places, q)[1] for q in range(STATES)]
        return [leaves[entry % STATES] + STATES * int(classes[-1]) for entry in range(ENTRIES)]

    return pd.Series([run(c, int(v)) for c, v in zip(cells, behind)], dtype=object)


@F.pandas_udf(TRACED)
def _traced(cells: pd.Series, behind: pd.Series, entry: pd.Series) -> pd.DataFrame:
    def run(row, vector: int, entry: int) -> tuple[str, int, int]:
        classes, symbols = _symbols(row)
        last, state = divmod(entry, STATES)
        places, front, cost = tables().boundaries(symbols, vector)
        first = last == NONE
        illegal = int((~_legal(classes[:-1], classes[1:])).sum()) + (not first and not _legal(last, classes[0]))
        # What the first vector holds beyond the rises is the cost of its state at the start.
        return tables().trace(places, state)[0], cost + (tables().vectors[front][state] if first else 0), illegal

    return pd.DataFrame([run(c, int(v), int(e)) for c, v, e in zip(cells, behind, entry)], columns=["letters", "cost", "illegal"])


def plan_repair(rows: DataFrame, segment_bits: int = SEGMENT_BITS, fan_bits: int = FAN_BITS) -> tuple[DataFrame, DataFrame]:
    """(one row per conversation, the letters of its edits by segment) for ``rows`` of ``(conv_id, turn, role, text)``.

    Rows stand in order of turn (nulls first), then role and a digest of the text. Each row's first flaw counts: blank, duplicate (role and text
    occurred before in the conversation), truncated (doesn't end with ``.``, ``!`` or ``?``). Edits: Keep, Rerole to user or assistant (3), Delete (4; blank
    and duplicate rows have to go), Insert an empty turn of either (3); a truncated row that stays costs 3 more. The cheapest edits after which
    role initials read ``(s?(ua)+)?`` win, ties by the least letters. A role is known by its first character; an empty one is illegal.

    The summary has ``conv_id, gaps`` (turns missing between the least and the greatest), ``blank, duplicate, truncated, illegal`` (neighbours
    whose initials aren't su, ua or au) and ``cost``. Null roles and texts read as one space, which is blank as a text. A null ``conv_id`` is a conversation like others; repeated rows
    are duplicates. Other columns take no part. An empty table gives empty tables.
    """
    placed = _placed(_plain(rows), segment_bits)
    cell = F.col("class") + F.when(F.col("flaw") == "truncated", 4).when(F.col("flaw").isNotNull(), 8).otherwise(0)
    ordered = F.array_sort(F.collect_list(F.struct("slot", cell.cast("int").alias("cell"))))
    segments = settle(
        placed.groupBy("conv_id", "node").agg(ordered["cell"].alias("cells"), F.min_by(F.struct(*KEY), "slot").alias("key"))
    )
    several = settle(segments.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select("conv_id", F.lit(True).alias("more")))
    if settled_size(several)[0] == 0:
        entered = segments.withColumns({"behind": F.lit(0), "entry": F.lit(START + STATES * NONE)})
    else:
        marked = attach(segments, several, ["conv_id"])
        long = settle(marked.filter("more").drop("more"))
        vectors = _scan(long.select("conv_id", "node", _vector_map("cells").alias("map")), 0, True, fan_bits)
        known = settle(attach(long, vectors.withColumnRenamed("value", "behind"), ["conv_id", "node"], split_hot=False))
        states = _scan(known.select("conv_id", "node", _state_map("cells", "behind").alias("map")), START + STATES * NONE, False, fan_bits)
        placed_in = attach(known, states.withColumnRenamed("value", "entry"), ["conv_id", "node"], split_hot=False)
        short = marked.filter("more IS NULL").drop("more").withColumns({"behind": F.lit(0), "entry": F.lit(START + STATES * NONE)})
        entered = short.unionByName(placed_in)
    traced = settle(entered.withColumn("t", _traced("cells", "behind", "entry")).select("conv_id", "node", "key.*", "t.*"))
    sums = traced.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = placed.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), *[F.count_if(F.col("flaw") == flaw).alias(flaw) for flaw in FLAWS]
    )
    return null_safe_join(counts, sums, ["conv_id"], "inner"), traced.select("conv_id", "node", *KEY, "letters")


class Editor:
    """Takes the rows of one conversation in order and gives the repaired ones."""

    def __init__(self):
        self.letters: deque[str] = deque()
        self.at, self.state = 0, START

    def learn(self, letters: str) -> None:
        self.letters.append(letters)

    def _next(self) -> str:
        while self.at == len(self.letters[0]):
            self.letters.popleft()
            self.at = 0
        self.at += 1
        return self.letters[0][self.at - 1]

    def _new(self) -> str:
        name, self.state = NAME[self.state], AFTER[self.state]
        return name

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) up to and with a row's own edit."""
        while (letter := self._next()) == INSERT:
            yield letter, self._new(), ""
        if letter == KEEP:
            self.state = 1 if role[:1] == "s" else AFTER[self.state]
            yield letter, role, text
        elif letter == REROLE:
            yield letter, self._new(), text
        else:
            yield DELETE, "", ""

    def close(self) -> Iterator[tuple[str, str, str]]:
        """Turns missing at the end."""
        while self.state not in DONE:
            yield INSERT, self._new(), ""


def _streamed(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """Letters and rows of each conversation in one task and in order; letters of a segment come before its first row."""
    first = letters.select("conv_id", *KEY, F.lit(0).alias("kind"), "node", F.col("letters").alias("value"))
    texts = _plain(rows).select("conv_id", "turn", "role", _digest(), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("node"), F.col("text").alias("value"))
    return first.unionByName(texts).repartition("conv_id").sortWithinPartitions(*ORDER, "kind", "node").select("conv_id", "role", "kind", "value")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, letter, role, text) for each edit, and (conversation, None, None, None) where one ends."""
    editor, current = None, None
    for batch in batches:
        for conv, role, kind, value in zip(*(column.to_pylist() for column in batch.columns)):
            if editor is None or conv != current:
                if editor is not None:
                    yield from ((current, *edit) for edit in editor.close())
                    yield current, None, None, None
                editor, current = Editor(), conv
            if kind == 0:
                editor.learn(value)
            else:
                yield from ((current, *edit) for edit in editor.take(role, value))
    if editor is not None:
        yield from ((current, *edit) for edit in editor.close())
        yield current, None, None, None


# Rows, and characters of them, that a task gathers before it hands them on.
OUT_ROWS, OUT_CHARS = 4096, 1 << 21


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def repaired_rows(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv_id, place, edit, role, text)``, places from 0; deleted rows are left out."""
    texts = [T.StructField(name, T.StringType()) for name in ("edit", "role", "text")]
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()), *texts])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for conv, letter, role, text in _events(batches):
            if letter is None:
                place = 0
            elif letter != DELETE:
                out.append((conv, place, letter, role, text))
                place, size = place + 1, size + len(text)
            if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                yield _batch(out, arrow)
                out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return _streamed(rows, letters).mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)``: the letters of all edits, and the digest of the repaired ``role:text`` lines.

    A digest is read off its text from start to end, so one task streams through a conversation; it holds a batch of rows and the letters.
    """
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(name, T.StringType()) for name in ("audit", "repaired_sha256")]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, audit, seen, lines = [], 0, [], hashlib.sha256(), 0
        for conv, letter, role, text in _events(batches):
            if letter is None:
                out.append((conv, "".join(audit), seen.hexdigest()))
                size += len(audit)
                audit, seen, lines = [], hashlib.sha256(), 0
                if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                    yield _batch(out, arrow)
                    out, size = [], 0
                continue
            audit.append(letter)
            if letter != DELETE:
                seen.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                lines += 1
        if out:
            yield _batch(out, arrow)

    return _streamed(rows, letters).mapInArrow(run, schema)
