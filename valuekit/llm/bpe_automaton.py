"""BPE by a tokenization automaton: its arcs are tokens, its paths the token rows that the merges leave.

It is compiled merge by merge. At first every byte may follow every byte. The merge ``(u, v)`` bars ``v`` where ``u`` has just been read, and gives every state
that has an arc ``u`` an arc ``uv``, which leads where ``v`` led. All arcs of one token lead to one state, so a state is named by tokens. Each spelling
has exactly one path, so that encoding a word is following arcs, and decoding is reading off their labels.

A state is kept as what is barred in it. In a preorder of tokens by the token they start with, children of later merges first, a bar on ``v`` set by a merge is one interval:
``v`` and all tokens built on it since.
"""

from __future__ import annotations

import json
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tokenizers
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# Fixed value: the pattern that cuts texts into words before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces of texts that a worker remembers in each of two generations, and their greatest length.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 64


def byte_letters() -> dict[str, int]:
    """The byte that each letter of the vocabulary file stands for: printable ones themselves, the others the letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in letters.values()]
    return letters | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """States and arcs from ``merges`` of tokens given as bytes, in order. Each token comes from one merge at most, after its parts."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        names = [bytes([b]) for b in range(256)]
        number = {name: k for k, name in enumerate(names)}
        left, right, rank = [-1] * 256, [-1] * 256, [-1] * 256
        built: list[list[int]] = [[] for _ in names]  # tokens that start with a token, in order of merges
        rules: list[list[tuple[int, int]]] = [[] for _ in names]  # (rank, what is barred behind a token)
        for k, (a, b) in enumerate(merges):
            u, v = number[a], number[b]
            if a + b in number:
                raise ValueError("two merges make one token")
            number[a + b] = new = len(names)
            names.append(a + b)
            left.append(u)
            right.append(v)
            rank.append(k)
            built[u].append(new)
            built.append([])
            rules[u].append((k, v))
            rules.append([])
        self.place, sizes = self._preorder(built)
        # From the k-th latest child on: how far the interval of a token reaches over the children of later merges.
        reach = {}
        for v, children in enumerate(built):
            far = 1
            reach[v] = cuts = []
            for child in reversed(children):
                far += sizes[child]
                cuts.append((rank[child], far))

        def interval(v: int, k: int) -> tuple[int, int]:
            far = 1
            for when, upto in reach[v]:
                if when < k:
                    break
                far = upto
            return self.place[v], self.place[v] + far

        bars = [[interval(v, k) for k, v in rules[u]] for u in range(len(names))]
        row_of: dict[tuple, int] = {}
        self.rows: list[list[int]] = []
        self.state = [0] * len(names)
        for token in range(len(names)):
            # What bars behind a token: its own merges, and those of its last parts before they were merged.
            barred, part, until = [], token, len(merges)
            while part >= 0:
                barred += bars[part][: bisect_left(rules[part], (until,))]
                until, part = rank[part], right[part]
            row = self._joined(barred)
            self.state[token] = row_of.setdefault(tuple(row), len(self.rows))
            if self.state[token] == len(self.rows):
                self.rows.append(row)
        self.start = row_of.setdefault((), len(self.rows))
        if self.start == len(self.rows):
            self.rows.append([])
        # A merge whose second part is barred behind its first one never happens, and its token has no arc.
        dead = self._dead(left, right, rank)
        self.tokens = {name: k for k, name in enumerate(names) if k not in dead}
        self.id = [ids[name].to_bytes(4, "little") for name in names]
        # Longest token by its first two bytes.
        self.longest: dict[bytes, int] = {}
        for name in self.tokens:
            self.longest[name[:2]] = max(self.longest.get(name[:2], 1), len(name))

    @staticmethod
    def _preorder(built: list[list[int]]) -> tuple[list[int], list[int]]:
        """(place of each token, tokens at and below it); children of later merges come first."""
        sizes = [1] * len(built)
        for token in range(len(built) - 1, -1, -1):  # children have greater numbers
            sizes[token] += sum(sizes[c] for c in built[token])
        place, at = [0] * len(built), 0
        for token in range(256):
            place[token], at = at, at + sizes[token]
        for token in range(len(built)):
            at = place[token] + 1
            for child in reversed(built[token]):
                place[child], at = at, at + sizes[child]
        return place, sizes

    @staticmethod
    def _joined(spans: list[tuple[int, int]]) -> list[int]:
        """Ends of the union of intervals, in order: start, end, start, end ..."""
        out: list[int] = []
        for start, end in sorted(spans):
            if out and start <= out[-1]:
                out[-1] = max(out[-1], end)
            else:
                out += [start, end]
        return out

    @staticmethod
    def _dead(left: list[int], right: list[int], rank: list[int]) -> set[int]:
        """Tokens whose parts never stand side by side, as a merge of parts of theirs comes between."""
        merged = {(left[t], right[t]): rank[t] for t in range(256, len(left))}
        dead: set[int] = set()

        def parted(u: int, v: int, k: int) -> bool:
            until = k
            while u >= 0:
                first, upto, whole = v, k, True
                while first >= 0:
                    when = merged.get((u, first), k)
                    # Of two places for one merge, the left one comes first.
                    if when < until and (when < upto if whole else when <= upto):
                        return True
                    upto, first, whole = rank[first], left[first], False
                until, u = rank[u], right[u]
            return False

        for token in range(256, len(left)):
            if left[token] in dead or right[token] in dead or parted(left[token], right[token], rank[token]):
                dead.add(token)
        return dead

    def path(self, word: bytes) -> list[int]:
        """The tokens of the one path that spells ``word``: the longest arc first, back where none leads on."""
        tokens, place, state, rows = self.tokens, self.place, self.state, self.rows
        whole = tokens.get(word)
        if whole is not None:
            return [whole]
        size, longest = len(word), self.longest
        path: list[int] = []
        lengths: list[int] = []
        stuck = bytearray(size + 1)
        at, row = 0, rows[self.start]
        length = min(size, longest.get(word[:2], 1))
        while at < size:
            while length:
                token = tokens.get(word[at : at + length])
                if token is not None and not stuck[at + length] and not bisect_right(row, place[token]) & 1:
                    break
                length -= 1
            if length:
                path.append(token)
                lengths.append(length)
                at += length
                row = rows[state[token]]
                length = min(size - at, longest.get(word[at : at + 2], 1))
            else:
                # Whatever leads here is the same path, so this place is left for good.
                stuck[at] = 1
                path.pop()
                length = lengths.pop()
                at -= length
                row = rows[state[path[-1]]] if path else rows[self.start]
                length -= 1
        return path


class Memory(dict):
    """What ``make`` gave for the texts met of late, in two generations: the older one goes when the younger is full."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        made = self.older.get(text) or self.make(text)
        if len(text) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = made
        return made

    def all(self, texts: Iterable[str]) -> list[bytes]:
        return [self[t] for t in texts]


class Tokenizer:
    """A byte-level BPE file as an automaton: texts to ids and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        letters = byte_letters()
        spelled = lambda text: bytes(letters[c] for c in text)
        ids = {spelled(token): i for token, i in held["model"]["vocab"].items() if all(c in letters for c in token)}
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in held["model"]["merges"]]
        self.automaton = Automaton([(spelled(a), spelled(b)) for a, b in pairs], ids)
        self.marks = {mark["content"]: mark["id"] for mark in held["added_tokens"]}
        self.labels: dict[int, bytes] = {i: name for name, i in ids.items()} | {i: mark.encode() for mark, i in self.marks.items()}
        self.mark = regex.compile("|".join(map(regex.escape, self.marks))) if self.marks else None
        self.word = regex.compile(PATTERN)
        # White space behind a space: such texts aren't cut at single spaces.
        self.uneven = regex.compile(r" [\s\x1c-\x1f]| $")
        self.cutter = tokenizers.Tokenizer.from_file(path).pre_tokenizer
        self.pieces, self.words = Memory(self._spell), Memory(self._path)

    def cut(self, text: str) -> list[str]:
        """Words of a text. What newer versions of Unicode may call a letter or a number is left to the library."""
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.word.findall(text)
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]

    def _path(self, word: str) -> bytes:
        return b"".join([self.automaton.id[t] for t in self.automaton.path(word.encode())])

    def _spell(self, piece: str) -> bytes:
        return b"".join([self.words[w] for w in self.cut(piece)])

    def _plain(self, text: str) -> list[bytes]:
        # Words never hold a space but in front, so a space before a character parts them whatever stands before it.
        if self.uneven.search(text):
            return self.words.all(self.cut(text))
        first, *rest = text.split(" ")
        return self.pieces.all(([first] if first else []) + [" " + p for p in rest])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.mark is None or not (marks := list(self.mark.finditer(text))):
            return b"".join(self._plain(text))
        out, at = [], 0
        for found in marks:
            out += self._plain(text[at : found.start()])
            out.append(self.marks[found.group()].to_bytes(4, "little"))
            at = found.end()
        return b"".join(out + self._plain(text[at:]))

    def decode(self, ids: Iterable[int]) -> str:
        """Labels of the arcs in a row. Ids that no token has are left out; bytes that aren't UTF-8 read as U+FFFD."""
        labels = self.labels
        return b"".join([labels.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def _resolved(tokenizer: str | None) -> str:
    return tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER)


def encode_bpe(text: Column, tokenizer: str | None = None) -> Column:
    """Ids of each text, as binary of little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library that every worker can read; without it the packaged one is used. The strings of added
    tokens become their ids, as in the library. Null and empty texts have no ids. Texts are independent of each other: ties, repeated rows and other
    columns play no part.
    """

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        bpe = load(_resolved(tokenizer))
        return pd.Series([bpe.encode(t) for t in texts], index=texts.index, dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_bpe(ids: Column, tokenizer: str | None = None) -> Column:
    """Text of each row of ids that ``encode_bpe`` made; null as no ids."""

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        bpe = load(_resolved(tokenizer))
        return pd.Series([bpe.decode(np.frombuffer(r, "<u4").tolist()) for r in rows], index=rows.index, dtype=object)

    return decode(F.coalesce(ids, F.lit(b"")))
