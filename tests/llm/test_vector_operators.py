import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import plain

from valuekit.llm.graph import components
from valuekit.llm.near_vectors import linked_pairs, near_duplicates
from valuekit.llm.nearest import nearest

NAN, INF = float("nan"), float("inf")
ODD = [
    (1, None, 1), (2, [0.0, 0.0], 1), (3, [NAN, 1.0], 1), (4, [INF, 1.0], 1), (5, [None, 1.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1),
    (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [2.0, 0.01], 1), (12, [0.0, 1.0], 1), (13, [1.0, 0.0], 2),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 0) for i, v, label in rows], "vec_id long, embedding array<float>, label int, tile string, score int")


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 300), (7, 7), (None, 3), (900, 901), (901, 900)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 400: 300, 500: 300, 900: 900, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near(spark, rows, **options):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(table(spark, rows), **options).collect()}


def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16))
    vectors = centres[rng.integers(0, 20, 400)] + 0.25 * rng.standard_normal((400, 16))
    rows = [(i * 3, v.astype(np.float32).tolist(), int(rng.integers(0, 3))) for i, v in enumerate(vectors)]
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(30)]
    assert near(spark, rows, threshold=0.93, tile=32) == plain.near_vectors(rows, 0.93)


def test_near_vectors_odd_rows(spark):
    got = near(spark, ODD)
    assert got == plain.near_vectors([(i, v if i != 7 else None, label) for i, v, label in ODD], 0.93)
    assert got[9] == (2, 9, True) and got[10] == (2, 9, False)
    assert near_duplicates(table(spark, [])).count() == 0
    assert near_duplicates(table(spark, [(None, [1.0], 1)])).collect()[0].n_links == 0


def test_repeated_ids_are_vectors_of_their_own(spark):
    """One id under two labels, with two vectors and with equal ones: links and components of each row stay apart."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((4, 8))
    rows = [(k % 7, (base[k % 4] + 0.05 * rng.standard_normal(8)).astype(np.float32).tolist(), k % 2) for k in range(40)]
    rows += [rows[3], rows[3], (100, rows[5][1], 1), (2, [1.0] + [0.0] * 7, 1), (2, [1.0] + [0.0] * 7, 0)]
    # Places stand for ids; a component is the smallest id among its places.
    placed = plain.near_vectors([(k, v, label) for k, (_, v, label) in enumerate(rows)], 0.93)
    least = {}
    for k, (_, component, _) in placed.items():
        least[component] = min(least.get(component, rows[k][0]), rows[k][0])
    want = sorted((rows[k][0], rows[k][2], n, least[c], rows[k][0] == least[c]) for k, (n, c, _) in placed.items())
    got = near_duplicates(table(spark, rows), 0.93)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == sorted((i, n, c, kept) for i, _, n, c, kept in want)


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(6)
    for size in (2, 8, 64, 1500):
        x = rng.standard_normal((60, size)) * np.exp(rng.standard_normal(size) * 2)
        u = x / np.linalg.norm(x, axis=1)[:, None]
        for threshold in (0.2, 0.5, 0.93):
            got = set(zip(*(k.tolist() for k in linked_pairs(u, u, threshold))))
            assert got == set(zip(*(k.tolist() for k in np.nonzero(np.einsum("ik,jk->ij", u, u) >= threshold))))


def exact(rows, query, k):
    ids = np.array([i for i, _ in rows])
    scores = np.array([v for _, v in rows], float) @ np.array(query[1], float)
    others = np.flatnonzero(ids != query[0])
    return ids[others[np.lexsort((ids[others], -scores[others]))[:k]]].tolist()


def test_nearest_recall(spark):
    folder = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    found = {}
    for r in nearest(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    hits = [len(set(found[i]) & set(exact(rows, (i, v), 20))) for i, v in rows if i % 20 == 0]
    assert np.mean(hits) / 20 >= 0.9 and all(len(x) == 20 for x in found.values())


def test_nearest_in_blocks_with_unequal_norms(spark, monkeypatch):
    monkeypatch.setattr("valuekit.llm.nearest.BLOCK", 100)
    monkeypatch.setattr("valuekit.llm.nearest.QUERIES", 7)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(12) * rng.exponential()).tolist()) for i in range(400)]
    got = nearest(table(spark, [(i, v, 1) for i, v in rows]), F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    rows = [(i, np.float32(v)) for i, v in rows]
    hits = [len({r.vec_id for r in got if r.query_id == i} & set(exact(rows, (i, v), 5))) for i, v in rows if i % 20 == 0]
    assert np.mean(hits) / 5 >= 0.9
    by_id = dict(rows)
    assert all(abs(r.score - float(by_id[r.query_id].astype(float) @ by_id[r.vec_id].astype(float))) < 1e-12 for r in got)


UNEQUAL = {"unit": lambda n: np.ones(n), "one of 10": lambda n: np.where(np.arange(n) == 77, 10.0, 1.0), "0.1% of 2": lambda n: np.where(np.arange(n) % 1000 == 0, 2.0, 1.0), "log-normal": lambda n: np.exp(0.3 * np.random.default_rng(4).standard_normal(n))}


@pytest.mark.parametrize("norms", UNEQUAL)
def test_nearest_recall_in_a_full_block_of_unequal_norms(spark, norms):
    x = np.random.default_rng(3).standard_normal((8192, 64))
    x = np.float32(x / np.linalg.norm(x, axis=1)[:, None] * UNEQUAL[norms](len(x))[:, None])
    found = {}
    for r in nearest(table(spark, [(i, v, 1) for i, v in enumerate(x.tolist())]), F.col("vec_id") % 80 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x.astype(float)[::80] @ x.astype(float).T
    scores[np.arange(len(scores)), np.arange(0, len(x), 80)] = -np.inf
    hits = [len(found[80 * i] & set(np.argsort(-row)[:20].tolist())) for i, row in enumerate(scores)]
    assert np.mean(hits) / 20 >= 0.9


def test_nearest_odd_rows(spark):
    got = [(r.query_id, r.rank, r.vec_id) for r in nearest(table(spark, ODD), F.col("vec_id").isin(8, 3, 12), k=3).orderBy("query_id", "rank").collect()]
    assert got == [(8, 1, 11), (8, 2, 9), (8, 3, 10), (12, 1, 11), (12, 2, 8), (12, 3, 9)]
    assert nearest(table(spark, []), F.lit(True)).count() == 0
    assert nearest(table(spark, ODD), F.lit(False)).count() == 0
    twins = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 1.0], 1), (None, [1.0, 1.0], 1)]
    assert [(r.query_id, r.vec_id) for r in nearest(table(spark, twins), F.lit(True), k=5).orderBy("query_id", "rank").collect()] == [(1, 2), (2, 1), (2, 1)]


def test_every_length_counts(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(3 if i % 3 else 5).tolist(), 1) for i in range(90)]
    rows += [(100 + i, rows[i][1], 1) for i in range(10)]
    links = {i: v for size in (3, 5) for i, v in plain.near_vectors([r for r in rows if len(r[1]) == size], 0.93).items()}
    assert near(spark, rows, threshold=0.93, tile=8) == links
    got = nearest(table(spark, rows), F.col("vec_id") < 12, k=1).collect()
    assert {r.query_id: r.vec_id for r in got if r.query_id < 10}.keys() == set(range(10))
    size = {i: len(v) for i, v, _ in rows}
    assert len(got) == 12 and all(size[r.query_id] == size[r.vec_id] for r in got)
