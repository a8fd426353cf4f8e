import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import plain

from valuekit.llm import queries
from valuekit.llm.automaton import Automaton
from valuekit.llm.line_dedup import dedup_lines
from valuekit.llm.mixing import mix_sources
from valuekit.llm import ngram_join as join_module
from valuekit.llm.ngram_join import Search, Sharers, folded, ngram_join, parities
from valuekit.llm.pieces import SPACE, Pieces, decode_pieces, encode_pieces, round_trip
from valuekit.llm.pii import PHONE, find_pii, span_text
from valuekit.llm.quality import classify_quality, features, fit
from valuekit.llm.secrets import find_secrets, secrets_in
from valuekit.llm.shingles import mix, shingle_sets
from valuekit.llm.token_files import BLOCK, Encoder, decode_blocks, encode_blocks, read_tokens, write_tokens

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_removed string, pii int, secrets int, block int, label int"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "x " * 30_000), (8, "\n\n\n\n\n"), (9, "a\nb\nc\nd"), (10, "q\na\nb\nc\nd"),
    (11, "same words here again and again"), (12, "same words here again and again"), (13, "ü" * 5000 + " 1.2.3.4"), (14, "1" * 20_000), (15, "a@b" * 5000),
]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "s", "r", 1, 1, 1, 1) for i, t in rows], SCHEMA)


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


# --- n-gram Jaccard join


def found_groups(table):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in table.collect()}


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_join_matches_brute_force(spark, words, percent):
    rows = documents(spark)
    got = found_groups(ngram_join(spark.read.parquet(f"{FOLDER}/documents.parquet"), words, percent / 100))
    assert got == plain.jaccard_join(rows, words, percent)


def chained(n):
    """Texts of which neighbours are alike and the ends are not."""
    return [(i, " ".join(f"w{k}" for k in range(i, i + 40))) for i in range(n)]


def test_join_of_chains_and_odd_texts(spark):
    rows = [*ODD, *((100 + i, t) for i, t in chained(60))]
    got = found_groups(ngram_join(odd(spark, rows), 3, 0.9))
    assert got == plain.jaccard_join(rows, 3, 90)
    assert got[159][1] == 100 and got[1] == (0, 1) and got[12][1] == 11


def test_join_cuts_large_components(spark, monkeypatch):
    monkeypatch.setattr("valuekit.llm.ngram_join.TASK_SHINGLES", 200)
    monkeypatch.setattr("valuekit.llm.ngram_join.BROADCAST_IDS", 0)
    rows = [*chained(50), *((200 + i, t + " tail") for i, t in chained(50))]
    assert found_groups(ngram_join(odd(spark, rows), 3, 0.9)) == plain.jaccard_join(rows, 3, 90)


def test_join_routes_only_what_may_be_linked(spark, monkeypatch):
    """Half of the shingles are everybody's: too few for a link, though everyone shares rare ones with others."""
    routed, candidates = [], join_module._candidates
    monkeypatch.setattr(join_module, "_candidates", lambda *given: routed.append(candidates(*given)) or routed[0])
    head = " ".join(f"h{k}" for k in range(30))
    rows = [(i, f"{head} " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40)]
    rows += [(100 + i, f"{rows[i][1]} tail") for i in range(3)]
    assert found_groups(ngram_join(odd(spark, rows), 3, 0.9)) == plain.jaccard_join(rows, 3, 90)
    assert {r.doc_id for r in routed[0].collect()} <= {0, 1, 2, 100, 101, 102}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 300), min_size=1, max_size=200), min_size=1, max_size=12), st.sampled_from([60, 80, 90]), st.integers(0, 2**32))
def test_pairs_of_sharers_connect_every_link(bases, percent, seed):
    rng = np.random.default_rng(seed)
    sets = {frozenset(b) for b in bases} | {frozenset(x for x in b if rng.random() > 0.04) | {1000 + int(rng.integers(5))} for b in bases for _ in range(4)}
    ordered = sorted(sets, key=len)
    hashed = lambda s: np.unique(mix(np.array(sorted(s), np.uint64) + np.uint64(7)))
    bitmaps = [parities(hashed(s), np.array([len(s)])) for s in ordered]
    sharers, pairs = Sharers(percent), []
    for i, (s, bitmap) in enumerate(zip(ordered, bitmaps)):
        pairs += [(j, i) for j in sharers.add(i, len(s), bitmap)]
        for j in range(i):
            assert np.bitwise_count(bitmaps[j] ^ folded(bitmap[None, :], len(bitmaps[j]))[0]).sum() <= len(s ^ ordered[j])
    reach = plain.groups(range(len(ordered)), pairs)
    assert all(reach[i] == reach[j] for i, a in enumerate(ordered) for j, b in enumerate(ordered[:i]) if 100 * len(a & b) >= percent * len(a | b))


def test_join_compares_all_who_share_a_shingle_or_leaders(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = lambda: " ".join(f"w{k}" if rng.random() > 0.01 else f"x{rng.integers(10**6)}" for k in range(90))
    rows = [(i, text()) for i in range(60)]
    for most in (2, 100):
        monkeypatch.setattr(join_module, "SHORT_SHARERS", most)
        assert found_groups(ngram_join(odd(spark, rows), 3, 0.9)) == plain.jaccard_join(rows, 3, 90)


def test_join_keys_missing_or_repeated(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "e f g h"), (9, "e f g h")]
    got = sorted((r.doc_id is not None, r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(odd(spark, rows)).collect())
    assert got == [(False, None, 2, None), (True, 5, 2, 5), (True, 5, 2, 5), (True, 9, 2, 5)]
    assert ngram_join(odd(spark, [])).count() == 0
    with pytest.raises(ValueError):
        ngram_join(odd(spark), similarity=0.5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=2, max_size=40), st.sampled_from([60, 80, 90]))
def test_search_finds_every_link(sets, percent):
    search = Search(percent)
    for s in sorted(sets, key=len):
        search.add(np.array(sorted(s), np.uint64))
    ordered = sorted(sets, key=len)
    links = [(i, j) for i, a in enumerate(ordered) for j, b in enumerate(ordered[:i]) if 100 * len(a & b) >= percent * len(a | b)]
    want = plain.groups(range(len(ordered)), links)
    assert all((search.root(i) == search.root(j)) == (want[i] == want[j]) for i in want for j in want)


def test_shingle_counts_match_words():
    texts = ["", " ", "a", "A b", "a b a b a b", "x\ty\nz\x0bw\x0c", "É é ß"]
    _, count = shingle_sets([t.encode() for t in texts], 3)
    assert count.tolist() == [len(plain.shingles(t, 3)) for t in texts]


# --- line dedup


def test_lines_match_brute_force(spark):
    rows = ODD + [(20, "p\na\nb\nc\nz"), (21, "r\nr\nr\nr\nr\nr"), (22, "a\nb\nc\nd\na\nb\nc\nd")]
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(odd(spark, rows)).collect()}
    assert got == plain.dedup_lines(rows)
    assert got[20] == ("p\nz", 3) and got[8] == ("\n\n\n\n\n", 0)


def test_lines_keep_columns_and_twins(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc")]
    out = dedup_lines(odd(spark, rows))
    assert out.columns == [c for c in odd(spark).columns if c != "n_removed"] + ["n_removed"]
    got = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert sorted(got, key=str) == [(1, "", 0), (1, "", 0), (None, "a\nb\nc", 5)]
    assert dedup_lines(odd(spark, [])).count() == 0


# --- mixing


def test_mix_follows_weights(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "cold").alias("source"), F.lit("abcd").alias("text"),
    )
    mixed = mix_sources(docs, weights={"hot": 1.0, "cold": 3.0})
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["hot"] - 5000) < 250 and abs(counts["cold"] - 15_000) < 450 and None not in counts
    assert mixed.filter("copy > n_copies").count() == 0
    large = mix_sources(docs.limit(200), epochs=300.0).select("doc_id", "n_copies").distinct().agg(F.avg("n_copies"), F.var_samp("n_copies")).first()
    assert abs(large[0] - 300) < 8 and 180 < large[1] < 460
    keys = [r.shuffle_key for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_mix_odd_rows(spark):
    rows = spark.createDataFrame([(None, None, None), (1, "", "a"), (2, "xy", "a"), (2, "xy", "a")], "doc_id long, text string, source string").withColumn("copy", F.lit("clash"))
    got = mix_sources(rows, epochs=40.0).groupBy("doc_id").agg(F.max("n_copies").alias("n"), F.count("*").alias("rows")).collect()
    assert {r.doc_id for r in got} == {None, 1, 2} and all(r.rows == r.n * (2 if r.doc_id == 2 else 1) for r in got)
    assert mix_sources(rows.limit(0)).count() == 0


# --- token files


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 7):
        for high in (1, 2, 300, 1 << 32):
            values = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            values[rng.random(n) < 0.03] = 0xFFFFFFFF
            index, payload = encode_blocks(values)
            assert (decode_blocks(index, memoryview(b"".join(payload)), n) == values).all()


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, ours = Tokenizer.from_file(path), Encoder(path)
    texts = [
        "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a\n\n b", "a\n \nb", "don't stop", "x  y", "x 　y", "<|endoftext|> a <|endoftext|>",
        "é ü​ ß", "1 2 3", "tab\t tab", "long" * 60 + " " + "w" * 200, "end \n",
    ]
    want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert ours.encode(texts) == want and ours.encode(texts) == want


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*documents(spark), (None, "no id"), (10**12, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).repartition(5)
    folder = f"file://{tmp_path}/tokens"
    shards = write_tokens(table, folder)
    read = read_tokens(spark, folder).collect()
    assert sum(r.documents for r in shards.collect()) == len(read) == len(rows)
    texts, start = dict(rows), 0
    for r in sorted(read, key=lambda r: r.start):
        want = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, zlib.crc32(r.ids)) == (start, zlib.crc32(want.tobytes()))
        start += len(want)
    order = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    empty = f"file://{tmp_path}/none"
    write_tokens(table.limit(0), empty)
    assert read_tokens(spark, empty).count() == 0


# --- SentencePiece


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_are_the_best(spark, model):
    pieces, library = model
    scores = {library.id_to_piece(i): library.get_score(i) for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
    for word in {w for _, t in documents(spark)[:60] for w in (t or "").split(" ") if w} | {"一́x", "a\n", "\U0001f600!"}:
        text = SPACE + word
        got = [library.id_to_piece(i) for i in pieces.viterbi(text)]
        known = [p for p in got if p in scores]
        spelled = len("".join(c for c in text if c not in scores))
        total = sum(scores[p] for p in known) + pieces.worst * spelled
        assert total == plain.best_pieces(text, scores, pieces.worst)


def test_pieces_agree_with_the_library_on_byte_spelling(model):
    pieces, library = model
    assert pieces.encode("\U0001f9ff").tolist()[1:] == library.encode("\U0001f9ff")[1:]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(blacklist_characters=SPACE, blacklist_categories=["Cs"]), max_size=60))
def test_pieces_round_trip(model, text):
    pieces, _ = model
    ids = pieces.encode(text)
    assert pieces.decode(ids.tolist()) == text
    # Words one by one give what one pass over the whole gives.
    assert not text or ids.tolist() == pieces.viterbi(SPACE + text.replace(" ", SPACE))


def test_piece_columns(spark):
    done = odd(spark).withColumn("ids", encode_pieces(F.col("text"))).withColumn("back", decode_pieces(F.col("ids")))
    assert all(r.back == (r.text or "") and (len(r.ids) > 0) == bool(r.text) for r in done.collect())
    assert odd(spark, []).select(encode_pieces(F.col("text"))).count() == 0
    null = spark.createDataFrame([(None,), ([None, 272],)], "ids array<int>").select(decode_pieces(F.col("ids")).alias("t"))
    assert [r.t for r in null.collect()] == ["", "the"]


# --- secrets


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab c\n:='\"_.-AKI9é0", "token", "Secret", "api_key", "APIKEY", "passwd", "AKIA", "0123456789abcdef" * 2, "= abcdef"]), max_size=40))
def test_secret_spans(parts):
    text = "".join(parts)
    spans = [(a, k, kind, b) for a, k, b in secrets_in(text) for kind in [("assign", "access", "hex")[k] if k < 3 else ""] if kind]
    assert plain.joined(spans) == plain.joined(plain.secrets(text))


def test_secret_columns(spark):
    text = "é token = 'abc123xyz' ghp_" + "aZ1" * 13 + " -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890 AKIA" + "Z9" * 9
    got = {r.doc_id: [(s.kind, text[s.start : s.end]) for s in r.secrets] for r in find_secrets(odd(spark, [*ODD, (50, text)])).collect()}
    kinds = [kind for kind, _ in got[50]]
    assert kinds == ["assign", "github", "pem", "slack", "access"] and got[50][0][1] == "token = 'abc123xyz"
    assert got[1] == got[2] == got[4] == [] and len(got[14]) == 1
    assert find_secrets(odd(spark, [])).count() == 0


def test_automaton_is_minimal():
    both = Automaton(["a[bc]", "a(b|c)"], anywhere=False)
    assert both.states == 4  # start, after a, both rules, dead
    assert both.rules_in(b"ab") == 3 and list(Automaton(["ab*"], False).matches(b"xabbab")) == [(1, 4), (4, 6)]


# --- personal data


PARTS = ["a.b@c.de", "x@y.z_q@r.s", "10.0.0.1", "300.1.1.1", "1.2.3.4.5.6.7.8", "0000001.02.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+44 20 7946 0958", " ", "\n", "é", "7", "-", ".", "DE89 3704 0044 0532 0130 00"]


def test_personal_spans(spark):
    rng = np.random.default_rng(3)
    rows = [(100 + i, "".join(rng.choice(PARTS, 12))) for i in range(400)] + ODD + documents(spark)
    got = find_pii(odd(spark, rows).drop("pii")).select("doc_id", span_text(F.filter("pii", lambda s: s["rank"] < 4)).alias("spans")).collect()
    texts = dict((1000 + k, t or "") for k, (_, t) in enumerate(rows))
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.spans)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(plain.joined(plain.personal(t or "")))
    assert len(texts) == len(got) and {i: sorted(s) for i, s in by_id.items()} == {i: sorted(s) for i, s in want.items()}


def test_personal_scores_and_columns(spark):
    rows = [(1, "my card number is 4111 1111 1111 1111"), (2, "4111 1111 1111 1111"), (3, "IBAN DE89 3704 0044 0532 0130 00."), (4, None)]
    out = find_pii(odd(spark, rows))
    assert out.columns[:7] == odd(spark).columns[:7]
    got = {r.doc_id: r.pii for r in out.collect()}
    assert got[1][0].score > got[2][0].score and [s.kind for s in got[3]] == ["iban"] and got[4] == []
    assert "[0-9]" in PHONE and find_pii(odd(spark, [])).count() == 0


def test_account_numbers_end_before_other_capitals(spark):
    number = "DE89 3704 0044 0532 0130 00"
    rows = [(1, f"IBAN {number} BIC COBADEFFXXX"), (2, f"{number}"), (3, f"{number.replace(' ', '')}ABC"), (4, "DE89 3704 0044 0532 0130 01 BIC"), (5, "GB82 WEST 1234 5698 7654 32 X1")]
    rows += [(6, f"IBAN {number} and GB82WEST12345698765432 OK")]
    got = {r.doc_id: [(r.text[s.start : s.end]) for s in r.pii if s.kind == "iban"] for r in find_pii(odd(spark, rows)).collect()}
    assert got == {1: [number], 2: [number], 3: [number.replace(" ", "")], 4: [], 5: ["GB82 WEST 1234 5698 7654 32"], 6: [number, "GB82WEST12345698765432"]}


# --- quality


def test_trees_learn_and_score_alike():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 15)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = fit(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score > 0.5) == y[2000:]).mean() > 0.95
    for row, got in zip(x[2000:2020], score):
        total = trees.base
        for feature, above, value in zip(trees.feature, trees.above, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > above[node])
            total += value[node - len(feature)]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-9


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.QUERIES["op10_quality_classifier"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(r.predicted == 1 for r in got if r.quality == 1)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 0), (None, 1, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    got = classify_quality(odd(spark, [*ODD, (None, "x")]), labels).collect()
    assert len(got) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)
    assert classify_quality(odd(spark, []), labels.limit(0)).count() == 0
    assert features([b"", b"a a a\nb"]).shape == (2, 15)


def test_digest_of_nothing(spark):
    got = queries.QUERIES["op7_secrets"](spark, FOLDER).filter("spans = ''").first()
    assert got.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_round_trip_gives_what_both_steps_give(spark):
    df = odd(spark).unionByName(odd(spark, [(1, None), (None, "a  b"), (2, "日本 x"), (2, "日本 x")]))
    apart = df.select("*", encode_pieces(F.col("text")).alias("ids")).select("doc_id", "text", "ids", decode_pieces(F.col("ids")).alias("decoded"))
    at_once = df.select("doc_id", "text", round_trip(F.col("text")).alias("both")).select("doc_id", "text", "both.*")
    assert sorted(map(repr, at_once.collect())) == sorted(map(repr, apart.collect()))
    assert at_once.filter("decoded != coalesce(text, '')").isEmpty() and df.limit(0).select(round_trip(F.col("text"))).collect() == []
