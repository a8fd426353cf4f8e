"""BPE by the automaton against the tokenizers library and against merging pair by pair."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from valuekit.llm import bpe_automaton, queries
from valuekit.llm.bpe_automaton import Automaton, decode_bpe, encode_bpe

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe_automaton.load(PATH)


def ids_of(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def merged(word, merges):
    """Tokens of a word, one merge after the other, the best pair first, leftmost on ties."""
    rank = {pair: k for k, pair in enumerate(merges)}
    parts = [bytes([b]) for b in word]
    while pairs := [(rank[pair], k) for k, pair in enumerate(zip(parts, parts[1:])) if pair in rank]:
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


@st.composite
def merge_lists(draw):
    """Merges over three letters, each of tokens that are there already."""
    tokens, merges = [b"a", b"b", b"c"], []
    for _ in range(draw(st.integers(0, 12))):
        u, v = draw(st.sampled_from(tokens)), draw(st.sampled_from(tokens))
        if u + v not in tokens and len(u + v) < 9:
            tokens.append(u + v)
            merges.append((u, v))
    return merges


@given(merge_lists(), st.lists(st.text("abc", max_size=24), max_size=12))
@settings(max_examples=400, deadline=None)
def test_paths_are_what_merging_leaves(merges, words):
    names = [bytes([b]) for b in range(256)] + [a + b for a, b in merges]
    automaton = Automaton(merges, {name: k for k, name in enumerate(names)})
    for word in words:
        path = automaton.path(word.encode()) if word else []
        assert [names[t] for t in path] == merged(word.encode(), merges)


def test_a_merge_that_never_happens_has_no_arc():
    automaton = Automaton([(b"a", b"b"), (b"b", b"c"), (b"a", b"bc")], {b: k for k, b in enumerate([*(bytes([x]) for x in range(256)), b"ab", b"bc", b"abc"])})
    assert b"abc" not in automaton.tokens and automaton.path(b"abc") == [256, ord("c")]


SAMPLES = [
    "", " ", "  ", "a", " a", "a  b", "a   b \n  c", "\n\n x", "don't I'll we'VE", "x<|endoftext|>y <|endoftext|>", "<|endoftext|", "tab\t\ttab \t end ", "١٢٣ numbers 123456",
    "naïve café ünïcödé", "日本語のテキスト", "👩‍👩‍👧‍👦 emoji 🏳️‍🌈", "՘࢏Ᲊx ᲊ", "\x00\x1c\x1d \x85  　z", "�￾", "a" * 5000, "=" * 3001, "ab" * 2000, "ü" * 3000, " " * 2000, "\n" * 999,
    "word\n" * 400, "x y " * 900,
]


def test_samples_match_the_library(own, library):
    for text in SAMPLES:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == want, text[:40]
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


@given(st.text(max_size=60) | st.text(" \n\t\x0b\x85　'sabé1.<|>", max_size=40))
@settings(max_examples=600, deadline=None)
def test_any_text_matches_the_library(own, library, text):
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_words_are_cut_as_the_library_does(own, library):
    """Every code point between letters, digits, signs and spaces."""
    for start in range(0, 0x110000, 256):
        block = [chr(c) for c in range(start, start + 256) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}2 .{c}. {c}{c} {c}x\n" for c in block)
        assert own.cut(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


@given(st.lists(st.integers(0, 50256), max_size=12))
@settings(max_examples=300, deadline=None)
def test_any_ids_decode_as_the_library_does(own, library, ids):
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_query_matches_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op12_bpe"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert set(got) == {r.doc_id for r in rows}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = got[doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None, "i", 5), (1, "", "i", 5), (None, "a  b", "i", 5), (2, "same", None, 5), (2, "same", None, 5), (3, "long " * 60_000, "i", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = df.select("*", encode_bpe(df.text).alias("new")).select("*", decode_bpe("new").alias("back")).collect()
    for (doc_id, text, *rest), row in zip(rows, got):
        assert (row.doc_id, row.text, row.ids, row.decoded) == (doc_id, text, *rest)
        assert np.frombuffer(row.new, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids and row.back == (text or "")
    assert df.limit(0).select(encode_bpe(df.text)).collect() == []


def test_memory_keeps_two_generations(monkeypatch):
    monkeypatch.setattr(bpe_automaton, "REMEMBERED", 3)
    made = []
    memory = bpe_automaton.Memory(lambda t: made.append(t) or t.encode())
    assert memory.all(list("abcdabcd" * 5)) == [c.encode() for c in "abcdabcd" * 5]
    assert len(memory) <= 3 and len(memory.older) <= 3 and memory["x" * 100] == b"x" * 100 and "x" * 100 not in memory
