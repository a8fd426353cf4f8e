import unicodedata

import pytest
from pyspark.sql import functions as F

from valuekit.functions import fuzzy, text


def fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def apply(frame, fn, values):
    df = frame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_accents_on_every_character(frame):
    chars = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    blocks = ["".join(chars[i : i + 256]) for i in range(0, len(chars), 256)]
    got = apply(frame, text.strip_accents, blocks)
    assert got == ["".join(map(fold, block)) for block in blocks]


@pytest.mark.parametrize(
    "name, key, spaced, last",
    [
        ("Müller", "muller", "muller", "muller"),
        ("MÃ¼ller", "muller", "muller", "muller"),
        ("Łukasz Piszczek", "łukaszpiszczek", "łukasz piszczek", "piszczek"),
        ("Strauß", "strauss", "strauß", "strauss"),
        ("O’Neil", "oneil", "oneil", "oneil"),
        (" Jean-Pierre  Da Silva ", "jeanpierredasilva", "jeanpierre da silva", "silva"),
        ("Ibišević Jr.", "ibisevicjr.", "ibisevic jr", "jr."),
        ("\u3000\xa0Jo\u2003Di\x1f\u2028 ", "jodi", "jo di", "di"),
        ("", "", "", ""),
        (None, None, None, None),
    ],
)
def test_name_keys(frame, name, key, spaced, last):
    got = [apply(frame, fn, [name])[0] for fn in (text.name_key, text.name_key_spaced, text.last_name)]
    assert got == [key, spaced, last]


def test_variants_and_cascade(frame):
    two, three, one, none = apply(frame, text.name_variants, ["José Da-Luz", "Ana Maria Braga", "Pelé", None])
    assert two[0] == "José Da-Luz" and {"Jose DaLuz", "José Da Luz", "josedaluz", "jose daluz", "Da-Luz José", "J Da-Luz", "Da-Luz", "daluz"} <= set(two)
    assert {"Ana-Maria Braga", "AnaMaria Braga", "A Braga", "braga", "anamariabraga"} <= set(three)
    assert one == ["Pelé", "pelé", "Pele", "pele"] and none == []
    assert len(two) == len(set(two)) and len(three) <= 28
    keys = apply(frame, text.cascade_keys, ["Jean-Luc Noir"])[0]
    assert keys[:8] == ["Jean-Luc Noir", "JeanLuc Noir", "Jean Luc Noir", "Noir Jean-Luc", "Noir JeanLuc", "jean-luc noir", "jeanluc noir", "jean luc noir"]


def test_slug_and_url(frame):
    assert apply(frame, text.slug, ["Ángel  Di María -- (10)!"]) == ["angel-di-maria-10"]
    url = apply(frame, lambda c: text.profile_url(c, F.lit(7), "https://example.org/"), ["Jo Ünal"])
    assert url == ["https://example.org/jo-unal/profil/spieler/7"]


def test_parse_date(frame):
    days = apply(frame, lambda c: text.parse_date(c).cast("string"), ["2023-07-01", "2023-7-1", "2023-02-30", "01/07/2023", "x", None, "2023-07-01T00:00"])
    assert days == ["2023-07-01", "2023-07-01", None, None, None, None, None]


def brute_ratio(a, b):
    def common(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for j, d in enumerate(y):
                new.append(row[j] + 1 if c == d else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    if not a or not b:
        return 100.0 if a == b else 0.0
    ways = [(a, b), (b, a)] if len(a) == len(b) else [sorted((a, b), key=len)]
    return max(
        100.0 * 2 * common(s, w) / (len(s) + len(w))
        for s, t in ways
        for w in {t[max(i, 0) : i + len(s)] for i in range(1 - len(s), len(t))}
    )


def test_partial_ratio_against_brute_force(frame):
    import random

    rng = random.Random(3)
    pairs = [("Manchester Utd", "Manchester United"), ("Arsenal", "Arsenal FC"), ("", ""), ("a", ""), ("Inter", "AC Milan")]
    pairs += [("".join(rng.choices("abc ", k=rng.randint(1, 9))), "".join(rng.choices("abcd ", k=rng.randint(1, 14)))) for _ in range(300)]
    df = frame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r.s for r in df.select("i", fuzzy.partial_ratio(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()]
    assert got == pytest.approx([brute_ratio(a.lower(), b.lower()) for a, b in pairs])
    back = [r.s for r in df.select("i", fuzzy.partial_ratio(F.col("b"), F.col("a")).alias("s")).orderBy("i").collect()]
    assert back == pytest.approx(got)


def test_strip_equals_python(frame):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    texts = [f"{c}{c}a{c}b{c}" for c in spaces] + ["\u200bx", "ab"]
    assert apply(frame, text.strip, texts) == [t.strip() for t in texts]
    assert apply(frame, text.words, texts) == [t.split() for t in texts]


def test_latin_texts_are_told_by_one_test_for_ascii_characters(spark):
    """A class of many ranges costs a test each for every ASCII character, of which long texts are made; every character is judged as by the plain ranges."""
    assert text.NOT_PLAIN_LATIN.startswith(r"[[^\x00-\x7f]&&")
    plain = r"[^\x00-\xbb\xbf-ıĴ-ľŁ-ňŊ-ſ]"
    codes = spark.range(0x110000).filter("id NOT BETWEEN 55296 AND 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    counted = codes.agg(F.count("*").alias("n"), F.count_if(F.col("c").rlike(plain)).alias("wide"), F.count_if(F.col("c").rlike(plain) != F.col("c").rlike(text.NOT_PLAIN_LATIN)).alias("unlike")).first()
    assert counted.n == 0x110000 - 2048 and counted.wide > 1_000_000 and counted.unlike == 0
