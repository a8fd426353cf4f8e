import corpus_pipeline

LONG = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"x{i}" for i in range(60))
THIRD = " ".join(f"y{i}" for i in range(60))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.drop_copies(spark, docs, "")
    assert got.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)


def test_repeated_rows_and_rows_without_id_leave_one(spark):
    rows = [(5, LONG, "a"), (5, LONG, "a"), (None, OTHER, "a"), (None, OTHER, "a"), (7, f"{LONG} end", "b"), (None, f"{LONG} fin", "b"), (8, None, "c"), (8, None, "c")]
    assert kept(spark, rows) == sorted([(5, LONG), (None, OTHER), (8, None)], key=repr)


def test_texts_under_one_id_go_by_their_own_links(spark):
    rows = [(1, LONG, "a"), (4, f"{LONG} end", "a"), (4, OTHER, "a"), (9, THIRD, "a")]
    assert kept(spark, rows) == sorted([(1, LONG), (4, OTHER), (9, THIRD)], key=repr)
    assert kept(spark, [(3, LONG, "a"), (2, f"{LONG} end", "a")]) == [(2, f"{LONG} end")]
