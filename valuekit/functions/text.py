"""Name repair, folding and spelling variants as built-in expressions (no Python workers)."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and "not a letter, number, underscore or space", spelled out for Java regexes.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
PUNCTUATION = r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"
# Anything but Latin characters that fold to one character at most. One test tells for ASCII characters: Java goes through the ranges of a class one by one.
NOT_PLAIN_LATIN = r"[[^\x00-\x7f]&&[^\x80-\xbb\xbf-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017f]]"
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Characters that fold to one character, those to delete (last), and those that fold to several."""
    single, deleted, several = {}, [], {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        if unicodedata.combining(char):
            deleted.append(char)
        elif unicodedata.decomposition(char):
            folded = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
            if len(folded) == 1:
                single[char] = folded
            else:
                several[char] = folded
    source = "".join(single) + "".join(deleted)
    return source, "".join(single.values()), several


def _char_class(chars: list[str]) -> str:
    """Regex class over code point ranges."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


def _jamo(first: int, n: int) -> Column:
    return F.split(F.lit(" ".join(chr(first + i) for i in range(n))), " ")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks.

    Characters that fold to a single one go through ``translate``. Only texts that hold a character
    which folds to several (ligatures, Hangul syllables, ...) are also taken apart character by character.
    """
    source, target, several = _folding()
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    hangul = [chr(HANGUL_FIRST), chr(HANGUL_LAST)]

    def unfold(char: Column) -> Column:
        index = F.ascii(char) - HANGUL_FIRST
        lead = F.get(_jamo(0x1100, 19), F.floor(index / 588).cast("int"))
        vowel = F.get(_jamo(0x1161, 21), F.floor(index % 588 / 28).cast("int"))
        tail = F.when(index % 28 > 0, F.get(_jamo(0x11A8, 27), (index % 28 - 1).cast("int"))).otherwise("")
        syllable = (char >= hangul[0]) & (char <= hangul[1])
        # ASCII characters, most of many texts, are not looked up.
        return F.when(F.ascii(char) < 128, char).when(syllable, F.concat(lead, vowel, tail)).otherwise(F.coalesce(F.element_at(table, char), char))

    wide = rf"[[^\x00-\x7f]&&[{_char_class(list(several))}\x{{{HANGUL_FIRST:x}}}-\x{{{HANGUL_LAST:x}}}]]"
    unfolded = F.array_join(F.transform(F.split(text, ""), unfold), "")
    # Cheap tests first: ASCII needs nothing, plain Latin letters never unfold.
    many = text.rlike(NOT_PLAIN_LATIN) & text.rlike(wide)
    folded = F.translate(F.when(many, unfolded).otherwise(text), source, target)
    return F.when(text.rlike(r"[^\x00-\x7f]"), folded).otherwise(text)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """Split on white space; empty for blank text."""
    return F.filter(F.split(text, rf"{SPACE}+"), lambda w: w != "")


def drop_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


# Curly quotes and what replaces them.
CURLY_QUOTES = "‘’‚‛“”„‟"
STRAIGHT_QUOTES = "'" * 4 + '"' * 4


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1, straighten quotes and drop control characters."""

    def repaired(x: Column) -> Column:
        latin = ~x.rlike(r"[^\x00-\xff]") & x.rlike(r"[\x80-\xff]")
        decoded = let(F.when(latin, F.encode(x, "ISO-8859-1")).cast("string"), lambda d: F.when(F.is_valid_utf8(d), d))
        straight = F.translate(F.coalesce(decoded, x), CURLY_QUOTES, STRAIGHT_QUOTES)
        fixed = F.regexp_replace(straight, r"[\x00-\x08\x0e-\x1f\x7f]", "")
        return F.when(x.rlike(r"[^\x09-\x0d\x20-\x7e]"), fixed).otherwise(x)

    return let(text, repaired)


def _key(fixed: Column) -> Column:
    folded = F.replace(strip_accents(fixed), F.lit("ß"), F.lit("ss"))
    return F.regexp_replace(F.lower(folded), rf"[-'{SPACE[1:-1]}]+", "")


def _spaced_key(fixed: Column) -> Column:
    folded = drop_punctuation(let(F.lower(fixed), strip_accents))
    return strip(F.regexp_replace(folded, rf"{SPACE}+", " "))


def name_key(name: Column) -> Column:
    """Repaired, unaccented, lower case, without hyphens, apostrophes or spaces."""
    return let(strip(repair_mojibake(name)), _key)


def name_key_spaced(name: Column) -> Column:
    """Repaired, unaccented, lower case, without punctuation, single spaces."""
    return let(strip(repair_mojibake(name)), _spaced_key)


def last_name(name: Column) -> Column:
    """Key of the last word; empty text for a blank name."""
    return F.when(name.isNotNull(), F.coalesce(name_key(F.try_element_at(words(name), F.lit(-1))), F.lit("")))


def _with_cases(text: Column) -> Column:
    return let(text, lambda x: F.array(x, F.lower(x), drop_punctuation(x), drop_punctuation(F.lower(x))))


def _hyphenated(parts: Column) -> Column:
    rest = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), " ")
    return F.when(F.size(parts) >= 3, F.concat(F.get(parts, F.lit(0)), F.lit("-"), F.get(parts, F.lit(1)), F.lit(" "), rest))


def _reversed(parts: Column) -> Column:
    return F.when(F.size(parts) == 2, F.concat_ws(" ", F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))


def _variants(fixed: Column) -> Column:
    def spelled(parts: Column) -> Column:
        last = F.try_element_at(parts, F.lit(-1))
        initial = F.when(F.size(parts) >= 2, F.concat(F.left(F.get(parts, F.lit(0)), F.lit(1)), F.lit(" "), last))
        texts = F.array(
            fixed, strip_accents(fixed), F.replace(fixed, F.lit("-"), F.lit(" ")), _reversed(parts), _hyphenated(parts), initial, last
        )
        keys = F.array(_key(fixed), _spaced_key(fixed))
        last_keys = let(last, lambda x: F.array(_key(x), _spaced_key(x)))
        return let(
            F.transform(texts, _with_cases),
            lambda cased: F.concat(F.flatten(F.slice(cased, 1, 3)), keys, F.flatten(F.slice(cased, 4, 4)), last_keys),
        )

    return F.array_distinct(F.array_compact(let(words(fixed), spelled)))


def name_variants(name: Column) -> Column:
    """Distinct spellings under which a name may be listed, most literal first."""
    return let(strip(repair_mojibake(name)), _variants)


def cascade_keys(name: Column) -> Column:
    """Search keys in the order they are tried: literal, respelled, reordered, lower case, all variants."""

    def tried(fixed: Column) -> Column:
        spaced = F.replace(fixed, F.lit("-"), F.lit(" "))
        lower = F.when(F.lower(fixed) != fixed, F.lower(fixed))
        texts = let(
            words(fixed),
            lambda parts: F.array(fixed, F.when(spaced != fixed, spaced), _hyphenated(parts), _reversed(parts), lower),
        )
        direct = F.flatten(F.transform(F.array_compact(texts), lambda x: F.array(x, drop_punctuation(x))))
        return F.array_distinct(F.concat(direct, let(strip(fixed), _variants)))

    return let(repair_mojibake(name), tried)


def slug(text: Column) -> Column:
    """ASCII letters, digits and single hyphens."""
    ascii_only = F.regexp_replace(strip_accents(text), r"[^\x00-\x7f]", "")
    kept = F.lower(F.trim(F.regexp_replace(ascii_only, r"[^\w\s-]", "")))
    return F.regexp_replace(kept, r"[-\s]+", "-")


def profile_url(name: Column, entity_id: Column, site: str) -> Column:
    return F.concat(F.lit(site.rstrip("/") + "/"), slug(name), F.lit("/profil/spieler/"), entity_id.cast("string"))


def parse_date(text: Column) -> Column:
    """ISO dates; anything else gives NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))
