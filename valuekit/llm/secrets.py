"""Find secrets: one automaton of all rules' signs reads every byte once, the automata of the rules it reports place the spans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.llm.automaton import Automaton


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ["password", "passwd", "secret", "token", "api_?key"]))
_GAP = f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?"
_VALUE = "[A-Za-z0-9+/_.=-]"


@dataclass(frozen=True)
class Rule:
    """``pattern`` gives the spans; ``sign`` is shorter and part of every span that counts; ``counts`` drops others."""

    kind: str
    pattern: str
    sign: str
    counts: Callable[[bytes], bool] = lambda span: True


def _assigned(span: bytes) -> bool:
    """Six characters of value or more. It is what follows the last quote, blank or separator the value can't hold."""
    return len(_value_of(span)) >= 6


def _value_of(span: bytes) -> bytes:
    name = next(n for n in (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey") if span.lower().startswith(n))
    rest = span[len(name) :]
    rest = rest[1:] if rest[:1] in (b'"', b"'") else rest
    rest = rest.lstrip(b" ")[1:].lstrip(b" ")
    return rest[1:] if rest[:1] in (b'"', b"'") else rest


RULES = [
    Rule("assign", f"{_GAP}{_VALUE}+", f"{_GAP}{_VALUE}", _assigned),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{4}", lambda s: len(s) >= 20),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{12}", lambda s: len(s) >= 24),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]", lambda s: len(s) >= 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9]", lambda s: len(s) >= 15),
    Rule("google", "AIza[0-9A-Za-z_-]+", "AIza[0-9A-Za-z_-]", lambda s: len(s) >= 39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "\\.eyJ[A-Za-z0-9_-]"),
    Rule("pem", "-----BEGIN\\x20([A-Z]+\\x20)*PRIVATE\\x20KEY-----", "-----BEGIN\\x20"),
]
BASE = ("assign", "access", "hex")


@lru_cache(maxsize=1)
def _compiled() -> tuple[Automaton, list[Automaton]]:
    return Automaton([r.sign for r in RULES], anywhere=True), [Automaton([r.pattern], anywhere=False) for r in RULES]


def secrets_in(text: str) -> list[tuple[int, int, int]]:
    """``(start, rule, end)`` of every span, sorted; code points, ends exclusive."""
    data = text.encode("utf-8", "surrogatepass")
    signs, places = _compiled()
    found = signs.rules_in(data)
    if not found:
        return []
    spans = []
    for k, rule in enumerate(RULES):
        if found >> k & 1:
            spans += [(a, k, b) for a, b in places[k].matches(data) if rule.counts(data[a:b])]
    if spans and len(data) != len(text):
        # Bytes that continue a character don't count.
        point = list(accumulate((byte & 0xC0 != 0x80 for byte in data), initial=0))
        spans = [(point[a], k, point[b]) for a, k, b in spans]
    return sorted(spans)


def find_secrets(docs: DataFrame, text: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` with an array of spans ``(start, end, kind)`` by start, then kind in the order of ``RULES``.

    Spans of a kind are leftmost, as long as possible and don't overlap; too short ones are dropped and not tried again further right.
    Starts and ends count code points, ends are exclusive. A null or empty text has an empty array. A column called like ``name`` is replaced; the
    others pass unread.
    """

    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def find(texts: pd.Series) -> pd.Series:
        rows = ([{"start": a, "end": b, "kind": RULES[k].kind} for a, k, b in secrets_in(t or "")] for t in texts)
        return pd.Series(list(rows), index=texts.index, dtype=object)

    return docs.withColumn(name, find(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()
