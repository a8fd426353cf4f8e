"""The pipeline against a plain version, stage by stage, and the opN queries against their SQL."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import plain
from tools.check_oracle import compare, connect
from valuekit.llm.pieces import decode_pieces
from valuekit.llm.quality import classify_quality

FOLDER = "/root/testdata/sf0.001"
SQL = {n: sql for n, sql in entry.oracle_sql().items() if n.startswith("op") and n[2].isdigit()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_dealt_query_matches_sql(spark, name):
    assert compare(spark, FOLDER, name, entry.queries()[name], SQL[name], connect(FOLDER)).startswith("ok")


def held(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def cut(rows):
    """Documents are the different (id, text), in order of the id, nulls first."""
    keys = sorted({(i, t) for i, t, _ in rows}, key=lambda k: (k[0] is not None, k[0] or 0, k[1] or ""))
    done = plain.dedup_lines([(n, t) for n, (_, t) in enumerate(keys)])
    place = {key: n for n, key in enumerate(keys)}
    out = Counter()
    for (i, t, s), n in rows.items():
        text, gone = done[place[i, t]]
        if not gone or text.strip(" "):
            out[i, text, s] += n
    return out


def without_copies(rows):
    keys = sorted({(i, t) for i, t, _ in rows}, key=lambda k: (k[0] is None, k[0] or 0, k[1] or ""))
    joined = plain.jaccard_join([(n, t) for n, (_, t) in enumerate(keys)], 5, 80)
    return {key for n, key in enumerate(keys) if joined[n][1] == n}


def mixed(rows):
    sizes = defaultdict(int)
    for (_, t, s), n in rows.items():
        sizes[s] += n * len(t or "")
    sizes = {s: max(n, 1) for s, n in sizes.items()}
    weights = {s: n**0.7 for s, n in sizes.items()}
    out = Counter()
    for (i, t, s), n in rows.items():
        mean = weights[s] / sum(weights.values()) * sum(sizes.values()) / sizes[s]
        key = "draw:0:1" if i is None else f"draw:0:{i}:1"
        uniform = (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        k, p = 0, math.exp(-mean)
        upto = p
        while upto < uniform:
            k += 1
            p *= mean / k
            upto += p
        if k:
            out[i, t, s] += n * k
    return out


def test_stages_match_a_plain_version(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = given.filter("doc_id % 2 = 0 AND n_chars < 20000").collect()
    text = "\n".join(f"A sentence about number {i} in a row of sentences that say little more." for i in range(9))
    more = [(None, text), (None, text), (90001, text), (90002, text), (90003, None), (None, None), (90004, ""), (rows[0].doc_id, rows[0].text), (rows[1].doc_id, text + "\nOne more.")]
    rows = [tuple(r) for r in rows] + [tuple({**rows[0].asDict(), "doc_id": i, "text": t, "n_chars": len(t or "")}.values()) for i, t in more]
    spark.createDataFrame(rows, given.schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert docs.count() == len(rows)
    good, lines, copies, mix, pieces = (stage for _, stage in corpus_pipeline.STAGES)

    first = corpus_pipeline.settle(good(spark, docs, str(tmp_path)))
    scored = classify_quality(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert held(first) == held(scored.filter("predicted = 1")) and first.count() > 20
    docs = corpus_pipeline.settle(docs)  # from here on with what the classifier would drop
    second = corpus_pipeline.settle(lines(spark, docs, str(tmp_path)))
    assert held(second) == cut(held(docs))
    third = corpus_pipeline.settle(copies(spark, second, str(tmp_path)))
    left = held(third)
    assert {(i, t) for i, t, _ in left} == without_copies(held(second)) and set(left.values()) == {1}
    fourth = corpus_pipeline.settle(mix(spark, third, str(tmp_path)))
    assert held(fourth) == mixed(left)
    fifth = pieces(spark, fourth, str(tmp_path))
    decoded = fifth.select("doc_id", "source", "n_tokens", F.size("ids").alias("n"), decode_pieces(F.col("ids")).alias("text"), "same").collect()
    assert Counter((r.doc_id, r.text, r.source) for r in decoded) == sum((Counter({(i, t or "", s): n}) for (i, t, s), n in held(fourth).items()), Counter())
    assert all(r.same and r.n_tokens == r.n for r in decoded)


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, FOLDER))
    rows = lambda df: Counter((r.doc_id, r.source, tuple(r.ids), r.same) for r in df.collect())
    got = rows(corpus_pipeline.run(spark, FOLDER))
    assert got == rows(docs) and got
