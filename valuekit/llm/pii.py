"""Find personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.text import let

# The patterns are written without backtracking, so that long runs of fitting characters cost linear time and no stack. A
# match can't begin inside such a run, except right behind the previous match (\G), since the run's first character
# would have matched as well.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"

# Characters of an account number by country.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}

# Characters before a span in which context words are looked for.
CONTEXT = 48


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Payment card numbers: 12 to 19 digits whose weighted sum ends in 0."""

    def valid(digits: Column) -> Column:
        def add(total: Column, k: Column) -> Column:
            digit = F.substr(digits, F.length(digits) - k, F.lit(1)).cast("int")
            twice = digit * (k % 2 + 1)
            return total + F.when(twice > 9, twice - 9).otherwise(twice)

        total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
        return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)

    return let(_digits(text), valid)


def _octets(text: Column) -> Column:
    """Four numbers of at most 255; leading zeros don't count, however many."""
    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(number) > 3, False).otherwise(F.coalesce(F.try_to_number(number, F.lit("999")).cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(text, r"\."), small)


def _dialled(text: Column) -> Column:
    return F.length(_digits(text)).between(9, 15)


def _mod97(text: Column) -> Column:
    """Length of the account number a text starts with: with its first four characters last and letters as 10 to 35, the rest by 97 is 1.
    Of the lengths that pass, blanks aside, its country's is taken, else the longest of 15 to 34. Null if there is none."""

    def value(char: Column) -> Column:
        return F.when(char >= "A", F.ascii(char) - 55).otherwise(F.ascii(char) - 48)

    def add(rest: Column, char: Column) -> Column:
        return (rest * F.when(char >= "A", 100).otherwise(10) + value(char)) % 97

    def longest(compact: Column) -> Column:
        chars = F.filter(F.split(compact, ""), lambda char: char != "")
        head, country = F.slice(chars, 1, 4), F.substr(compact, F.lit(1), F.lit(2))
        due = F.coalesce(*[F.when(country.isin(codes.split()), n) for n, codes in LENGTHS.items()], F.lit(0))

        def step(seen: Column, i: Column) -> Column:
            rest = add(seen["rest"], F.get(chars, i))
            fits = (i >= 14) & (F.aggregate(head, rest, add) == 1)
            return F.struct(rest.alias("rest"), F.when(fits & (seen["long"] != due), i + 1).otherwise(seen["long"]).alias("long"))

        start = F.struct(F.lit(0).alias("rest"), F.lit(-1).alias("long"))
        return F.aggregate(F.sequence(F.lit(4), F.least(F.size(chars), F.lit(34)) - 1), start, step)["long"]

    def cut(long: Column) -> Column:
        # So many characters with the blanks between them.
        def step(seen: Column, char: Column) -> Column:
            more = seen["left"] > 0
            return F.struct(
                F.when(more & (char != " "), seen["left"] - 1).otherwise(seen["left"]).alias("left"), (seen["size"] + more.cast("int")).alias("size")
            )

        start = F.struct(long.alias("left"), F.lit(0).alias("size"))
        size = F.aggregate(F.filter(F.split(text, ""), lambda char: char != ""), start, step)["size"]
        return F.when(long > 0, size)

    return let(longest(F.regexp_replace(text, " ", "")), cut)


# Kind, pattern, cheap test that a text may hold one, validator, score of a valid span, words that raise it.
Kind = tuple[str, str, Callable[[Column], Column], Callable[[Column], Column] | None, float, str]
KINDS: list[Kind] = [
    ("email", EMAIL, lambda t: t.contains("@"), None, 0.8, "mail|contact|write|schreib|écri|corre"),
    ("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _octets, 0.5, "address|host|server|adress|direcci"),
    ("card", CARD, lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _luhn, 0.6, "card|visa|master|credit|karte|carte|tarjeta|pay"),
    ("phone", PHONE, lambda t: t.contains("+"), _dialled, 0.5, "phone|call|tel|mobil|fax|ruf|appel|llam"),
    ("iban", IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), _mod97, 0.7, "iban|account|bank|konto|compte|cuenta"),
]
BASE = ["email", "ip", "card", "phone"]


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """Valid spans of one kind: ``(start, rank, kind, end, score)`` in code points."""
    name, pattern, likely, valid, score, words = kind

    def located(found: Column, between: Column) -> Column:
        """Each match with its place: the lengths of all texts between and all matches before it."""
        def step(seen: Column, i: Column) -> Column:
            start = seen["at"] + F.char_length(F.get(between, i))
            here = F.get(found, i)
            end = start + F.char_length(here)
            fits = F.lit(True) if valid is None else valid(here)
            upto = end
            if valid is _mod97:
                upto = start + fits
                fits = fits.isNotNull()
            spans = F.when(fits, F.concat(seen["spans"], F.array(F.struct(start.alias("start"), upto.alias("end"))))).otherwise(seen["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        none = F.array().cast("array<struct<start:int,end:int>>")
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]

    def all_of(found: Column) -> Column:
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda between: located(found, between)))

    spans = F.when(likely(text), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), all_of))

    def scored(span: Column) -> Column:
        first = F.greatest(span["start"] - CONTEXT, F.lit(0))
        before = F.lower(F.substr(text, first + 1, span["start"] - first))
        value = F.when(before.rlike(words), F.lit(score) + 0.2).otherwise(F.lit(score))
        return F.struct(
            span["start"].alias("start"), F.lit(order).alias("rank"), F.lit(name).alias("kind"), span["end"].alias("end"), value.alias("score")
        )

    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    return F.coalesce(F.transform(spans, scored), empty)


def find_pii(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with an array of spans ``(start, rank, kind, end, score)``, by start, then kind.

    Kinds in order of rank: mail addresses, IPv4 addresses with parts up to 255, card numbers that pass Luhn's test, international
    phone numbers of 9 to 15 digits, and account numbers that pass mod 97. Matches of a kind are leftmost and don't overlap; one that a
    validator refuses is dropped and not tried again further right. Of an account number with more capitals or digits behind it, the part of its country's
    length is taken if it passes, else the longest from the start that does; what follows in the same run is not searched again. Starts and ends count code points, ends are exclusive. Context words
    shortly before a span raise its score by 0.2; no span is dropped for its score.

    A null or empty text has an empty array. A column called like ``name`` is replaced; all others pass unread.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = [_spans(whole, i, kind) for i, kind in enumerate(KINDS)]
    return docs.withColumn(name, F.array_sort(F.concat(*parts)))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
