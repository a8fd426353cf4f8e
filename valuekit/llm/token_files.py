"""Token ids in binary files of patched frame-of-reference blocks."""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuekit.scale import settle

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# Values of a block, and the share of them that its width must hold; the others are exceptions.
BLOCK = 4096
PERCENTILE = 90
# File: magic, then HEADER, then per document id and length, per block its INDEX row, then the payload of the blocks.
MAGIC = b"PFORTOK1"
HEADER = "<qqqq"  # documents, of these without id (they come first), tokens, blocks
INDEX = np.dtype([("at", "<i8"), ("least", "<u4"), ("width", "<u4"), ("exceptions", "<u4")])
EXCEPTION = np.dtype([("place", "<u2"), ("value", "<u4")])

# Texts that a task encodes at a time, words whose ids a worker remembers (the first ones it meets), and words joined for one call.
BATCH_CHARS = 1 << 21
CACHED_WORDS = 500_000
CACHED_LENGTH = 64
JOINED_WORDS = 512


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values in ``width`` bits each, as rows of 64-bit words."""
    lanes = values.astype(np.uint64).reshape(len(values), -1, 64)
    out = np.zeros((len(values), lanes.shape[1], width), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        out[:, :, word] |= lanes[:, :, lane] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= lanes[:, :, lane] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack_bits``."""
    groups = words.reshape(len(words), -1, width)
    out = np.empty((len(words), groups.shape[1], 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = groups[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | groups[:, :, word + 1] << np.uint64(64 - shift)
        out[:, :, lane] = value & mask
    return out.reshape(len(words), -1)


def encode_blocks(tokens: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, list[bytes]]:
    """Index rows (places relative to the first block) and payloads: packed offsets from the minimum, then the exceptions."""
    count = -(-len(tokens) // BLOCK)
    if not count:
        return np.zeros(0, INDEX), []
    # The last block is filled up with its own first value, so that filling is never an exception.
    padded = np.concatenate((tokens, np.full(count * BLOCK - len(tokens), tokens[(count - 1) * BLOCK], tokens.dtype))).reshape(count, BLOCK)
    least = padded.min(1)
    rest = padded - least[:, None]
    cut = np.sort(rest, axis=1)[:, min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)]
    width = np.array([int(c).bit_length() for c in cut.tolist()])
    outlier = rest >> width[:, None].astype(rest.dtype) > 0
    payload: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        low = np.where(outlier[mine], 0, rest[mine])
        packed = pack_bits(low, w) if w else np.zeros((len(mine), 0), np.uint64)
        for k, words in zip(mine.tolist(), packed):
            places = np.flatnonzero(outlier[k])
            found = np.empty(len(places), EXCEPTION)
            found["place"], found["value"] = places, rest[k, places]
            payload[k] = words.astype("<u8").tobytes() + found.tobytes()
    index = np.empty(count, INDEX)
    sizes = np.array([len(p) for p in payload])
    index["at"], index["least"], index["width"], index["exceptions"] = np.cumsum(sizes) - sizes, least, width, outlier.sum(1)
    return index, payload


def decode_blocks(index: np.ndarray, payload: memoryview, tokens: int) -> np.ndarray:
    """Inverse of ``encode_blocks``."""
    out = np.zeros((len(index), BLOCK), np.uint32)
    for w in np.unique(index["width"]).tolist():
        mine = np.flatnonzero(index["width"] == w)
        size = BLOCK * w // 8
        if w:
            words = np.stack([np.frombuffer(payload, "<u8", size // 8, at) for at in index["at"][mine].tolist()])
            out[mine] = unpack_bits(words, w)
        for k in mine[index["exceptions"][mine] > 0].tolist():
            found = np.frombuffer(payload, EXCEPTION, int(index["exceptions"][k]), int(index["at"][k]) + size)
            out[k, found["place"]] = found["value"]
    return (out + index["least"][:, None]).ravel()[:tokens]


class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct word once.

    The pre-tokenizer always cuts before a single space between two other characters, so such words can be encoded one by one. Texts with a
    space next to white space, or with what may be the special token, go to the library as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.whole = re.compile(r" \s|<\|| $")
        self.mark = "<|endoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, each with a space in front; the special token, which parts texts before anything else, keeps them apart."""
        learnt: dict[str, bytes] = {}
        groups = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        joined = [self.mark.join([" " + w for w in group]) for group in groups]
        for group, encoding in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(encoding.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark_id)
            starts, raw = np.concatenate(([0], ends + 1)).tolist(), ids.tobytes()
            for word, a, b in zip(group, starts, [*ends.tolist(), len(ids)]):
                learnt[word] = raw[4 * a : 4 * b]
        return learnt

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        plain, split, heads = [], [], []
        odd = [i for i, t in enumerate(texts) if self.whole.search(t)]
        for i, ids in zip(odd, self._encoded([texts[i] for i in odd])):
            out[i] = ids
        for i, text in enumerate(texts):
            if out[i] is None:
                head, *rest = text.split(" ")
                plain.append(i)
                heads.append(head)
                split.append(rest)
        needed = set().union(*split)
        missing = list(needed.difference(self.words))
        room = CACHED_WORDS - len(self.words)
        learnt = self._learn(missing)
        once = [w for k, w in enumerate(missing) if k >= room or len(w) > CACHED_LENGTH]
        self.words.update(learnt)
        for i, head, rest in zip(plain, self._encoded(heads), split):
            out[i] = head + b"".join(map(self.words.__getitem__, rest))
        for word in once:
            del self.words[word]
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write(folder: str, tokenizer: str | None, end_id: int, percentile: float):
    """One file per task, renamed into place when it is whole: a task that runs again puts the same file there."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER))
        end = np.array([end_id], "<u4").tobytes()
        ids, lengths, tails, index, payload, tokens, place, without = [], [], np.zeros(0, np.uint32), [], [], 0, 0, 0

        def close(values: np.ndarray) -> None:
            nonlocal place
            rows, blobs = encode_blocks(values, percentile)
            rows["at"] += place
            place += sum(map(len, blobs))
            index.append(rows)
            payload.extend(blobs)

        for frame in frames:
            missing = frame["doc_id"].isna()
            without += int(missing.sum())
            ids.append(frame["doc_id"].fillna(0).to_numpy("<i8"))
            texts = [t or "" for t in frame["text"]]
            sizes = np.cumsum([len(t) for t in texts])
            cuts = np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
                encoded = [x + end for x in encoder.encode(texts[a:b])]
                lengths.append(np.array([len(x) // 4 for x in encoded], "<i8"))
                values = np.concatenate((tails, np.frombuffer(b"".join(encoded), "<u4")))
                whole = len(values) // BLOCK * BLOCK
                close(values[:whole])
                tails, tokens = values[whole:], tokens + int(lengths[-1].sum())
        if not ids:
            return
        close(tails)
        ids, lengths, index = (np.concatenate(x) for x in (ids, lengths, index))
        shard = TaskContext.get().partitionId()
        where, root = fs.FileSystem.from_uri(folder)
        name = f"{root}/_{uuid.uuid4().hex}"
        with where.open_output_stream(name) as out:
            out.write(MAGIC + struct.pack(HEADER, len(ids), without, tokens, len(index)))
            for part in (ids, lengths, index):
                out.write(part.tobytes())
            for blob in payload:
                out.write(blob)
        final = f"{root}/shard-{shard:06d}.pfor"
        where.move(name, final)
        yield pd.DataFrame({"shard": [shard], "documents": [len(ids)], "tokens": [tokens]})

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, percentile: float = PERCENTILE) -> DataFrame:
    """Encode ``text`` and write the ids to ``folder``, in ascending order of ``doc_id``; returns the table of shards.

    Every document ends with ``end_id``. Null texts count as empty; documents without ``doc_id`` come first; rows that repeat one stay apart, in any order. Rows
    are range partitioned, a shard per partition. ``folder`` is a URI of shared storage. ``index.parquet`` in it lists the shards with the number of ids
    before each. An empty table makes no shard. ``tokenizer`` is the path of a tokenizers file that all workers can read.
    """
    where, root = fs.FileSystem.from_uri(folder)
    where.create_dir(root)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    written = settle(ranged.mapInPandas(_write(folder, tokenizer, end_id, percentile), "shard int, documents long, tokens long"))
    # One row per shard, so one task may number them.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    shards.write.parquet(f"{folder}/index.parquet")
    return docs.sparkSession.read.schema(shards.schema).parquet(f"{folder}/index.parquet")


def _documents(blob: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start inside the shard, ids)`` of every document of one file."""
    if blob[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    count, without, tokens, blocks = struct.unpack_from(HEADER, blob, len(MAGIC))
    at = len(MAGIC) + struct.calcsize(HEADER)
    ids = np.frombuffer(blob, "<i8", count, at)
    lengths = np.frombuffer(blob, "<i8", count, at + 8 * count)
    index = np.frombuffer(blob, INDEX, blocks, at + 16 * count)
    payload = memoryview(blob)[at + 16 * count + INDEX.itemsize * blocks :]
    # A task's blocks close with each batch's last one, so only the very last may be short.
    values = decode_blocks(index, payload, tokens)
    stops = np.cumsum(lengths)
    for i, (doc, stop, length) in enumerate(zip(ids.tolist(), stops.tolist(), lengths.tolist())):
        yield None if i < without else doc, stop - length, values[stop - length : stop]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in ``folder``; ``ids`` as little-endian unsigned 32-bit integers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.pfor").load(folder)
    numbered = files.select(F.regexp_extract("path", r"shard-(\d+)\.pfor$", 1).cast("int").alias("shard"), "content")
    shards = spark.read.schema("shard int, documents long, tokens long, start long").parquet(f"{folder}/index.parquet")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for blob, start in zip(frame["content"], frame["start"]):
                rows = [(doc, start + at, ids.astype("<u4").tobytes()) for doc, at, ids in _documents(blob)]
                for i in range(0, len(rows), 1024):
                    out = pd.DataFrame(rows[i : i + 1024], columns=["doc_id", "start", "ids"])
                    yield out.astype({"doc_id": "Int64"})

    # One short row per shard, so it may be broadcast.
    placed = numbered.join(F.broadcast(shards.select("shard", "start")), "shard")
    return placed.mapInPandas(read, "doc_id long, start long, ids binary")
