"""SentencePiece encoding and decoding: a Viterbi search that one pass of an Aho-Corasick automaton drives."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# A character that no piece covers costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
# Words whose ids a worker remembers (the first ones it meets twice), and the length up to which it does.
CACHED_WORDS = 200_000
CACHED_LENGTH = 64
MET_SLOTS = 1 << 22


class Pieces:
    """The pieces of one model file: byte strings for decoding, and an automaton once something is encoded."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        self.bytes_to_id: dict[int, int] = {}
        self.texts: list[bytes] = []
        self.scored: list[tuple[str, float, int]] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_to_id[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.texts.append(b"")
            else:
                self.scored.append((piece, model.get_score(i), i))
                self.texts.append(piece.encode())
        self.worst = min((score for _, score, _ in self.scored), default=0.0) - UNKNOWN_PENALTY
        self.single = {piece for piece, _, _ in self.scored if len(piece) == 1}
        # If no piece crosses from a word into the next one's leading space, words can be encoded one by one.
        self.plain = all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", piece) for piece, _, _ in self.scored)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.plain else "(?s).+")
        # Two characters that stand side by side in no piece always part: what lies between such places is cached on its own.
        self.inner = {piece[k : k + 2] for piece, _, _ in self.scored for k in range(len(piece) - 1)}
        self.cache: dict[str, bytes] = {}
        self.met = bytearray(MET_SLOTS)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for piece, score, i in self.scored:
            automaton.add_word(piece, (len(piece), score, i))
        automaton.make_automaton()
        return automaton

    def viterbi(self, text: str) -> list[int]:
        """Best segmentation: each piece that ends at a position relaxes that position's score, longest first."""
        size = len(text)
        best, back = [0.0] + [-1e300] * size, [None] * (size + 1)
        if self.single.issuperset(text):
            for end, piece in self.automaton.iter(text):
                total = best[end + 1 - piece[0]] + piece[1]
                if total > best[end + 1]:
                    best[end + 1] = total
                    back[end + 1] = piece
        else:
            done = 0
            for end, piece in self.automaton.iter(text):
                while done < end:
                    done += 1
                    self._unknown(text, best, back, done)
                total = best[end + 1 - piece[0]] + piece[1]
                if total > best[end + 1]:
                    best[end + 1] = total
                    back[end + 1] = piece
            for end in range(done + 1, size + 1):
                self._unknown(text, best, back, end)
        out, at = [], size
        while at:
            piece = back[at]
            if piece[2] < 0:
                out.extend(reversed(self._spelled(text[at - 1])))
            else:
                out.append(piece[2])
            at -= piece[0]
        out.reverse()
        return out

    def _unknown(self, text: str, best: list[float], back: list, end: int) -> None:
        if text[end - 1] not in self.single:
            total = best[end - 1] + self.worst
            if total > best[end]:
                best[end], back[end] = total, (1, self.worst, -1)

    def _spelled(self, char: str) -> list[int]:
        """An unknown character byte by byte, where the model has bytes."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.bytes_to_id[b] for b in raw] if len(self.bytes_to_id) == 256 else [self.unknown]

    def _keep(self, word: str, ids: bytes) -> bytes:
        """Remember a word met for the second time; most words of a text of any size are met once."""
        slot = hash(word) % MET_SLOTS
        if not self.met[slot]:
            self.met[slot] = 1
        elif len(self.cache) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
            self.cache[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        return self.cache.get(part) or self._keep(part, array("i", self.viterbi(part)).tobytes())

    def ids(self, word: str) -> bytes:
        """Ids of a word that isn't cached."""
        # Letters rarely part, so that looking for places to cut doesn't pay; a sign at the end usually does.
        if word[1:].isalpha():
            return self._keep(word, array("i", self.viterbi(word)).tobytes())
        inner = self.inner
        if word[1:-1].isalpha() and word[-2:] not in inner:
            return self._keep(word, self._part(word[:-1]) + self._part(word[-1]))
        cuts = [0, *[k for k in range(1, len(word)) if word[k - 1 : k + 1] not in inner], len(word)]
        return self._keep(word, b"".join([self._part(word[a:b]) for a, b in zip(cuts, cuts[1:])]))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text: a space is put in front, spaces become visible; an empty text has no ids."""
        if not text:
            return np.empty(0, np.int32)
        spaced = SPACE + text.replace(" ", SPACE)
        words = self.words.findall(spaced)
        get, ids = self.cache.get, self.ids
        return np.frombuffer(b"".join([get(w) or ids(w) for w in words]), "<i4")

    def decode(self, ids: Iterable[int]) -> str:
        """Inverse of ``encode``: texts of the pieces, spaces restored, the one in front removed."""
        texts = self.texts
        text = b"".join([texts[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _resolved(model: str | None) -> str:
    return model or public_tokenizers.path(DEFAULT_MODEL)


def encode_pieces(text: Column, model: str | None = None) -> Column:
    """Array of piece ids of each text, by the best sum of piece scores (ties: the longer last piece).

    ``model`` is the path of a SentencePiece file that every worker can read; without it the packaged file is used. A space is put in front
    of a text, which decoding takes away again. A character that no piece covers is spelled in bytes. A null or empty text has an empty array.
    """

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        pieces = load(_resolved(model))
        return pd.Series([pieces.encode(t or "") for t in texts], index=texts.index, dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_pieces(ids: Column, model: str | None = None) -> Column:
    """Text of each array of piece ids. Exact for what ``encode_pieces`` made of texts without U+2581, which reads as a space.

    A null array gives an empty text; null ids, and control pieces, have no text.
    """

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        pieces = load(_resolved(model))
        return pd.Series([pieces.decode(_known(r)) for r in rows], index=rows.index, dtype=object)

    # What stands between keeps the two steps apart: nested directly, Spark would encode once for the ids and once more for decoding.
    return decode(F.coalesce(ids, F.array().cast("array<int>")))


def round_trip(text: Column, model: str | None = None) -> Column:
    """``(ids, decoded)`` of each text: its ids as from ``encode_pieces``, and the text that ``decode_pieces`` makes of them; in one worker, which holds the pieces once."""

    @F.pandas_udf("ids array<int>, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        pieces = load(_resolved(model))
        ids = [pieces.encode(t or "") for t in texts]
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([pieces.decode(i.tolist()) for i in ids], dtype=object)})

    return both(F.coalesce(text, F.lit("")))


def _known(ids: np.ndarray | None) -> list[int]:
    """Ids without nulls, which Arrow turns into NaN."""
    if ids is None:
        return []
    ids = np.asarray(ids)
    return (ids[~np.isnan(ids)].astype(int) if ids.dtype.kind == "f" else ids).tolist()
