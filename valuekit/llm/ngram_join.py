"""Exact Jaccard join of documents on word shingles by T-occurrence search.

1. *Filter.* Under one order of all shingles (by hash), the first ``t`` shingles that two linked documents share lie
   within the first ``miss + t`` shingles of both, where ``miss`` is how many of its shingles a document may lack in a
   partner. Only these prefixes are counted: each block of documents sends its distinct prefix shingles with their local
   counts, and gets back those that occur elsewhere too. A document in which too few recur has no partner.
2. *Route.* Of the rest, one document per distinct set goes on. A link's ends share one of their rarest recurring prefix
   shingles, so many are taken of each. Of the documents that share one, only those are candidates whose bitmaps allow it: a
   bit per shingle's hash, the parity of how many fall there, so that two bitmaps differ in no more bits than the sets in
   shingles. Documents of one candidate component meet in one task. A component too large for that is cut into slices, and
   every two slices meet.
3. *Search.* A task keeps inverted lists and asks for each document which others share at least T shingles: occurrences
   in short lists are counted, long ones are probed by binary search for what the short ones left (DivideSkip).
   Lists hold only balls' centres: a document linked to a centre joins its ball. By the triangle inequality a link to any
   member of a ball implies a centre within twice the distance, so the search takes that wider bound, and members are
   compared only where their ball isn't connected yet. Every link is thus either found or joins documents already joined.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuekit.llm.graph import components
from valuekit.llm.shingles import batches, mix, shingle_sets
from valuekit.scale import settle, settled_size

# Share of a document's shingles by which the counted prefix exceeds what a partner may lack.
SPARE = 10
# Prefix shingles that a block of documents holds.
BLOCK_SHINGLES = 1 << 20
# Words of 64 bits that a bitmap has at most, and documents that share a shingle up to which all pairs of them are compared.
BITMAP_WORDS = 1 << 7
SHORT_SHARERS = 32
# Documents that meet in one task, and their shingles.
TASK_DOCUMENTS = 2000
TASK_SHINGLES = 1_000_000
# Lists above this length are probed, not counted, as far as the threshold allows.
SHORT_LIST = 4096
# Ids that may be broadcast to select documents by; beyond that the texts are shuffled.
BROADCAST_IDS = 1_000_000
SALTS = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x3C6EF372FE94F82B)


def _spare(n):
    return (n * SPARE + 99) // 100


def _prefix(n, percent: int):
    """Length of the counted prefix of a set of ``n``."""
    return np.minimum(n, n * (100 - percent) // 100 + np.maximum(1, _spare(n)))


def _needed(n, percent: int):
    """Prefix shingles that a linked partner must share: the spare of the smallest size a partner may have."""
    return np.maximum(1, _spare((n * percent + 99) // 100))


def _words(n):
    """Words of the bitmap of a set of ``n``: about a bit for each shingle."""
    return np.int64(1) << np.clip(np.frexp(np.maximum(n, 1) - 1)[1] - 6, 1, BITMAP_WORDS.bit_length() - 1)


def parities(shingles: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Bitmaps of sets that lie back to back: the parity of how many shingles fall on each bit."""
    words = _words(count)
    first = 64 * (np.cumsum(words) - words)
    cell = np.repeat(first, count) + (shingles & np.repeat(64 * words - 1, count).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(cell, minlength=64 * int(words.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) of the same sets with fewer words."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def _sketch(words: int, percent: int):
    """One row per block of documents: ids, set sizes, fingerprints, counted prefixes and bitmaps, back to back."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, made = [], 0, 0
        part = TaskContext.get().partitionId()

        def block() -> pd.DataFrame:
            columns = [np.concatenate(x).astype(kind).tobytes() for x, kind in zip(zip(*held), ("<i8", "<i8", "<u8", "<u8", "<u8", "<u8"))]
            row = (part << 33) + made, *columns
            return pd.DataFrame([row], columns=["block", "ids", "sizes", "fp_a", "fp_b", "prefixes", "bitmaps"])

        for frame in frames:
            ids = frame["doc_id"].to_numpy()
            for a, b, texts in batches(frame["text"]):
                shingles, count = shingle_sets(texts, words)
                stop = np.cumsum(count)
                start = stop - count
                # Sums of all mixed shingles, twice with different salts: equal for equal sets, else different but for 2**-128.
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ salt), dtype=np.uint64))) for salt in SALTS]
                inside = np.arange(len(shingles)) - np.repeat(start, count) < np.repeat(_prefix(count, percent), count)
                held.append((ids[a:b], count, *(x[stop] - x[start] for x in sums), shingles[inside], parities(shingles, count)))
                size += int(inside.sum())
                if size >= BLOCK_SHINGLES:
                    yield block()
                    held, size, made = [], 0, made + 1
        if held:
            yield block()

    return run


def _block_shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for block, blob in zip(frame["block"], frame["prefixes"]):
            values, counts = np.unique(np.frombuffer(blob, "<u8"), return_counts=True)
            yield pd.DataFrame({"block": block, "shingle": values.view(np.int64), "times": counts})


def _survivors(percent: int):
    """Documents of one block in which enough prefix shingles recur, with the rarest that a partner must share."""

    def run(key, block: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        out = {"doc_id": [], "n": [], "fp_a": [], "fp_b": [], "rare": [], "bitmap": []}
        if len(block):
            row = block.iloc[0]
            ids, sizes = (np.frombuffer(row[c], "<i8") for c in ("ids", "sizes"))
            prints = [np.frombuffer(row[c], "<i8") for c in ("fp_a", "fp_b")]
            prefixes, bitmaps = np.frombuffer(row["prefixes"], "<i8"), np.frombuffer(row["bitmaps"], "<u8")
            word_stop = np.cumsum(_words(sizes))
            seen = seen.sort_values("shingle")
            values, times = seen["shingle"].to_numpy(np.int64), seen["times"].to_numpy(np.int64)
            at = np.minimum(np.searchsorted(values, prefixes), max(0, len(values) - 1))
            often = np.where(values[at] == prefixes, times[at], 1) if len(values) else np.ones(len(prefixes), np.int64)
            length = _prefix(sizes, percent)
            stop = np.cumsum(length)
            shared = np.concatenate(([0], np.cumsum(often > 1)))
            enough = np.flatnonzero((sizes > 0) & (shared[stop] - shared[stop - length] >= _needed(sizes, percent)))
            for i in enough.tolist():
                part = slice(stop[i] - length[i], stop[i])
                # Fewest occurrences first; those that occur once take their places but connect nothing.
                order = np.lexsort((prefixes[part], often[part]))[: length[i] - _needed(sizes[i], percent) + 1]
                picked = order[often[part][order] > 1]
                out["doc_id"].append(ids[i])
                out["n"].append(sizes[i])
                out["fp_a"].append(prints[0][i])
                out["fp_b"].append(prints[1][i])
                out["rare"].append(prefixes[part][picked])
                out["bitmap"].append(bitmaps[word_stop[i] - _words(sizes[i]) : word_stop[i]].tobytes())
        # Objects even when empty: Arrow can't tell lists from numbers otherwise.
        return pd.DataFrame({**out, "rare": pd.Series(out["rare"], dtype=object)})

    return run


def _sets(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b, texts in batches(frame["text"]):
                shingles, count = shingle_sets(texts, words)
                stop = np.cumsum(count)
                blobs = [shingles[s - c : s].tobytes() for s, c in zip(stop.tolist(), count.tolist())]
                yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy()[a:b], "shingles": blobs})

    return run


class Search:
    """T-occurrence search over the sets of one task; ``links`` joins everything that is linked."""

    def __init__(self, percent: int):
        self.percent = percent
        self.near = max(1, 2 * percent - 100)
        self.lists: dict[int, array] = {}
        self.centres: list[int] = []
        self.sizes = array("q")
        self.balls: list[list[int]] = []
        self.sets: list[np.ndarray] = []
        self.parent: list[int] = []
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((x, y))

    def overlaps(self, query: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Centres that may reach the wider bound, each with the exact number of shingles shared."""
        size = len(query)
        least = -(-self.near * size // 100)
        lists = sorted((x for x in map(self.lists.get, query) if x is not None), key=len)
        nothing = np.zeros(0, np.int64)
        if len(lists) < least:
            return nothing, nothing
        short = max(len(lists) - least + 1, bisect_left(lists, SHORT_LIST + 1, key=len))
        long = lists[short:]
        times = np.bincount(np.concatenate([np.frombuffer(x, np.int64) for x in lists[:short]]))
        found = np.flatnonzero(times >= max(1, least - len(long)))
        total = times[found]
        for i, inverted in enumerate(long):
            alive = total + (len(long) - i) >= least
            if not alive.all():
                found, total = found[alive], total[alive]
            if not len(found):
                return nothing, nothing
            view = np.frombuffer(inverted, np.int64)
            at = np.minimum(np.searchsorted(view, found), len(view) - 1)
            total += view[at] == found
        alive = total >= least
        return found[alive], total[alive]

    def alike(self, overlap, a: int, b, percent: int):
        return 100 * overlap >= percent * (a + b - overlap)

    def add(self, shingles: np.ndarray) -> None:
        me, size, query = len(self.sets), len(shingles), shingles.tolist()
        self.sets.append(shingles)
        self.parent.append(me)
        balls, overlap = self.overlaps(query)
        sizes = np.frombuffer(self.sizes, np.int64)[balls]
        linked = self.alike(overlap, size, sizes, self.percent)
        for ball in balls[linked].tolist():
            self.join(self.centres[ball], me)
        home = int(balls[linked][0]) if linked.any() else None
        near = balls[~linked & self.alike(overlap, size, sizes, self.near)].tolist()
        for ball in near:
            for member in self.balls[ball][1:]:
                if self.root(member) == self.root(me):
                    break
                theirs = self.sets[member]
                overlap = len(np.intersect1d(shingles, theirs, assume_unique=True))
                if self.alike(overlap, size, len(theirs), self.percent):
                    self.join(member, me)
        if home is not None:
            self.balls[home].append(me)
            return
        for shingle in query:
            self.lists.setdefault(shingle, array("q")).append(len(self.centres))
        self.centres.append(me)
        self.sizes.append(size)
        self.balls.append([me])


def _search(percent: int):
    """Rows arrive sorted by block; each block is searched on its own."""

    def links(ids: list[int], sets: list[bytes]) -> pd.DataFrame:
        search = Search(percent)
        for blob in sets:
            search.add(np.frombuffer(blob, "<u8"))
        pairs = np.array(search.links, np.int64).reshape(-1, 2)
        ids = np.array(ids, np.int64)
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, sets = None, [], []
        for frame in frames:
            for key, doc, blob in zip(zip(frame["block"], frame["slice_a"], frame["slice_b"]), frame["doc_id"], frame["shingles"]):
                if key != block:
                    if len(ids) > 1:
                        yield links(ids, sets)
                    block, ids, sets = key, [], []
                ids.append(doc)
                sets.append(blob)
        if len(ids) > 1:
            yield links(ids, sets)

    return run


class Sharers:
    """Candidates among the documents that share a shingle, which come in order of their sizes.

    A document whose bitmap allows a link to a leader joins it, and any other one becomes a leader. The bits in which bitmaps differ obey the triangle
    inequality, so a link to a document that joined a leader shows in the distance from the leader; a pair with each such leader connects both ends of the link.
    """

    def __init__(self, percent: int):
        self.percent = percent
        # By number of words: leaders' bitmaps, ids, sizes and greatest distance of those that joined (-1 if none); the number of leaders.
        self.leaders: dict[int, list] = {}

    def add(self, me: int, size: int, bitmap: np.ndarray) -> list[int]:
        """Ids of the leaders that ``me`` is paired with."""
        over, under = 100 + self.percent, 100 - self.percent
        found, home, least = [], None, None
        for words, held in self.leaders.items():
            if words > len(bitmap):
                continue
            bitmaps, ids, sizes, reach, count = held
            low = int(np.searchsorted(sizes[:count], -(-self.percent * self.percent * size // 10000)))
            if low == count:
                continue
            own, theirs, far = folded(bitmap[None, :], words), sizes[low:count], reach[low:count]
            apart = np.bitwise_count(bitmaps[low:count] ^ own).sum(1, dtype=np.int64)
            joins = (apart * over <= (theirs + size) * under) & (theirs * 100 >= self.percent * size)
            meets = joins | ((far >= 0) & ((apart - far) * over <= 2 * size * under))
            found += ids[low:count][meets].tolist()
            if joins.any():
                at = int(np.where(joins, apart, np.iinfo(np.int64).max).argmin())
                if least is None or apart[at] < least:
                    home, least = (held, low + at), apart[at]
        if home is not None:
            held, at = home
            held[3][at] = max(held[3][at], least)
            return found
        words = len(bitmap)
        if words not in self.leaders:
            self.leaders[words] = [np.empty((4, words), np.uint64), np.empty(4, np.int64), np.empty(4, np.int64), np.empty(4, np.int64), 0]
        held = self.leaders[words]
        count = held[4]
        if count == len(held[1]):
            held[:4] = [np.concatenate((x, np.empty_like(x))) for x in held[:4]]
        held[0][count], held[1][count], held[2][count], held[3][count] = bitmap, me, size, -1
        held[4] += 1
        return found


def _pairs(percent: int):
    """Rows arrive sorted by shingle, then size. Documents of short lists are compared with each other, those of long ones with leaders."""

    def close(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, words: np.ndarray, place: np.ndarray, by_words: dict[int, np.ndarray]) -> np.ndarray:
        """Which of the rows ``first`` and the rows ``second``, as large or larger, may be linked."""
        allowed = (sizes[first] + sizes[second]) * (100 - percent) // (100 + percent)
        out = np.zeros(len(first), bool)
        fits = sizes[first] * 100 >= percent * sizes[second]
        for a, mine in by_words.items():
            for b, theirs in by_words.items():
                if b < a or not (some := np.flatnonzero(fits & (words[first] == a) & (words[second] == b))).size:
                    continue
                apart = mine[place[first[some]]] ^ folded(theirs[place[second[some]]], a)
                out[some] = np.bitwise_count(apart).sum(1, dtype=np.int64) <= allowed[some]
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, sharers = None, Sharers(percent)
        for frame in frames:
            ids, sizes, bitmaps = frame["doc_id"].to_numpy(np.int64), frame["n"].to_numpy(np.int64), frame["bitmap"].tolist()
            shared, row = frame["shingle"].to_numpy(np.int64), np.arange(len(frame))
            starts = np.flatnonzero(np.append(True, shared[1:] != shared[:-1])) if len(shared) else row
            stops = np.append(starts[1:], len(shared)).astype(np.int64)
            # A shingle may go on in the next frame, or come from the last one.
            short = stops - starts <= SHORT_SHARERS
            short[:1] = short[-1:] = False
            words, place, by_words = _words(sizes), np.zeros(len(row), np.int64), {}
            for w in np.unique(words).tolist():
                own = np.flatnonzero(words == w)
                place[own] = np.arange(len(own))
                by_words[w] = np.frombuffer(b"".join([bitmaps[i] for i in own.tolist()]), "<u8").reshape(-1, w)
            end = np.repeat(np.where(short, stops, 0), stops - starts)
            a, b = [], []
            for apart in range(1, int((stops - starts)[short].max(initial=1))):
                first = row[row + apart < end]
                first = first[close(first, first + apart, sizes, words, place, by_words)]
                a.append(ids[first])
                b.append(ids[first + apart])
            for k in np.flatnonzero(~short).tolist():
                if shared[starts[k]] != shingle:
                    shingle, sharers = shared[starts[k]], Sharers(percent)
                for i in range(starts[k], stops[k]):
                    met = sharers.add(int(ids[i]), int(sizes[i]), np.frombuffer(bitmaps[i], "<u8"))
                    a.append(np.array(met, np.int64))
                    b.append(np.full(len(met), ids[i]))
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    return run


def _candidates(reps: DataFrame, percent: int) -> DataFrame:
    """``(doc_id, block)``: documents that pairs connect, directly or not, which share a rare prefix shingle and whose bitmaps allow a link."""
    # A set that a single shingle more takes below the similarity is linked with no other one.
    linkable = reps.filter(F.col("n") * 100 >= (F.col("n") + 1) * percent)
    posted = linkable.select("doc_id", "n", "bitmap", F.explode("rare").alias("shingle"))
    pairs = posted.repartition("shingle").sortWithinPartitions("shingle", "n", "doc_id").mapInPandas(_pairs(percent), "a long, b long")
    return components(pairs).select(F.col("id").alias("doc_id"), F.col("component").alias("block"))


def ngram_join(docs: DataFrame, words: int = 3, similarity: float = 0.9) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per document: components of the exact Jaccard join on word shingles.

    Documents link when the Jaccard similarity of their sets of distinct ``words``-word shingles is at least
    ``similarity``, a multiple of 0.01. ``component_id`` is the smallest ``doc_id`` that links reach. A null or empty text, or
    one without words, has the empty set, links with nothing and is its own component. Texts of fewer words have one shingle
    of all their words. Exact copies of a set are one class and link always. Rows without ``doc_id`` come back with a null
    component; rows that repeat a ``doc_id`` keep their own sizes but count as one node, linked by what any of them links to.
    Only ``doc_id`` and ``text`` are read; other columns don't matter. An empty table gives no rows.
    """
    percent = round(similarity * 100)
    if not 50 < percent <= 100:
        raise ValueError("the similarity must be above 0.5 and at most 1")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    given = texts.filter("doc_id IS NOT NULL")
    schema = "block long, ids binary, sizes binary, fp_a binary, fp_b binary, prefixes binary, bitmaps binary"
    sketch = settle(given.mapInPandas(_sketch(words, percent), schema))
    sent = sketch.select("block", "prefixes").mapInPandas(_block_shingles, "block long, shingle long, times long")
    everywhere = Window.partitionBy("shingle")
    seen = sent.withColumn("times", F.sum("times").over(everywhere)).filter("times > 1")
    living = settle(
        sketch.groupBy("block").cogroup(seen.groupBy("block")).applyInPandas(
            _survivors(percent), "doc_id long, n long, fp_a long, fp_b long, rare array<long>, bitmap binary"
        )
    )
    classes = living.groupBy("fp_a", "fp_b", "n").agg(F.min(F.struct("doc_id", "rare", "bitmap")).alias("first"))
    reps = settle(classes.select("fp_a", "fp_b", "n", "first.doc_id", "first.rare", "first.bitmap"))
    routed = settle(_candidates(reps, percent))
    wanted = F.broadcast(routed) if settled_size(routed)[0] <= BROADCAST_IDS else routed
    chosen = given.join(wanted.select("doc_id"), "doc_id", "left_semi")
    sets = settle(chosen.mapInPandas(_sets(words), "doc_id long, shingles binary"))
    size = (F.octet_length("shingles") / 8).cast("long")
    placed = sets.join(routed, "doc_id")
    tasks = F.greatest(F.sum(size) / TASK_SHINGLES, F.count("*") / TASK_DOCUMENTS)
    slices = placed.groupBy("block").agg(F.ceil(tasks * 2).cast("int").alias("slices"))
    cut = placed.join(slices, "block").withColumn("mine", F.pmod(F.xxhash64("doc_id"), "slices").cast("int"))
    other = F.explode(F.when(F.col("slices") <= 2, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("slices") - 1)))
    met = cut.withColumn("other", other).filter("mine != other").select(
        "block", "doc_id", "shingles",
        F.when(F.col("other") < 0, 0).otherwise(F.least("mine", "other")).alias("slice_a"),
        F.when(F.col("other") < 0, 0).otherwise(F.greatest("mine", "other")).alias("slice_b"),
    )
    keys = ["block", "slice_a", "slice_b"]
    ordered = met.repartition(*keys).sortWithinPartitions(*keys, F.octet_length("shingles"), "doc_id")
    links = ordered.mapInPandas(_search(percent), "a long, b long")
    joined = components(links).withColumnRenamed("component", "joined")
    known = reps.join(joined, reps["doc_id"] == joined["id"], "left").select(
        "fp_a", "fp_b", "n", F.coalesce("joined", "doc_id").alias("component_id")
    )
    linked = living.select("doc_id", "fp_a", "fp_b", "n").join(known, ["fp_a", "fp_b", "n"]).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    sizes = sketch.select("ids", "sizes").mapInPandas(_id_sizes, "doc_id long, n_shingles long")
    found = sizes.join(linked, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    lost = texts.filter("doc_id IS NULL").mapInPandas(_lone_sizes(words), "doc_id long, n_shingles long").withColumn("component_id", F.lit(None).cast("long"))
    return found.unionByName(lost)


def _id_sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for ids, sizes in zip(frame["ids"], frame["sizes"]):
            yield pd.DataFrame({"doc_id": np.frombuffer(ids, "<i8"), "n_shingles": np.frombuffer(sizes, "<i8")})


def _lone_sizes(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, _, texts in batches(frame["text"]):
                yield pd.DataFrame({"doc_id": pd.array([None] * len(texts), "Int64"), "n_shingles": shingle_sets(texts, words)[1]})

    return run
