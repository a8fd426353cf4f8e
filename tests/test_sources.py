import pytest
from pyspark.sql import functions as F

from valuekit.functions import paths
from valuekit.operators import analysis, correct
from valuekit.sources import html, readers, versions, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values(frame, fn, texts):
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    return [r.o for r in df.select("i", fn(F.col("p")).alias("o")).orderBy("i").collect()]


def test_path_functions(frame):
    assert values(frame, paths.updated_name, ["a/cleaned_x_2022-2023.parquet", "y.parquet", "d/z.tar.gz", "plain"]) == [
        "updated_x_2022-2023.parquet", "updated_y.parquet", "updated_z.gz", "updated_plain",
    ]
    assert values(frame, paths.season_end_year, ["x_2022-2023.csv", "x_2022.csv"]) == [2023, None]
    assert values(frame, lambda c: paths.league_and_season(c)[0], ["d/updated_La-Liga_2022-2023.parquet", "updated_x.parquet"]) == ["La-Liga", None]
    key = "La-Liga_2022-2023_no_feature_engineering"
    assert [values(frame, lambda c, i=i: paths.split_dataset_key(c)[i], [key, "a_b"]) for i in range(3)] == [["La-Liga", None], ["2022-2023", None], ["no_feature_engineering", None]]
    days = frame([("2023-06-30",), ("2023-07-01",), ("2024-01-31",)], "d string").select(paths.season_of(F.to_date("d")).alias("s"))
    assert [r.s for r in days.collect()] == [2023, 2024, 2024]
    first, last = frame([(2024,)], "y int").select(*paths.season_range(F.col("y"))).first()
    assert (str(first), str(last)) == ("2023-07-01", "2024-06-30")


def test_prediction_catalog(frame):
    files = ["/w/p/random_forest/fe/predicted_updated_A_2022-2023.parquet", "/w/p/xgboost/predicted_updated_B_x.parquet", "/w/p/else/other.txt"]
    rows = paths.prediction_catalog(frame([(f,) for f in files], "path string"), base="/w/").collect()
    assert {(r.model_name, r.fe_variant, r.league_season): r.link for r in rows} == {
        ("Random Forest", "fe", "A_2022-2023"): "p/random_forest/fe/predicted_updated_A_2022-2023.parquet",
        ("XGBoost", "predicted_updated_B_x.parquet", "B_x"): "p/xgboost/predicted_updated_B_x.parquet",
        ("Unknown Model", "Unknown", "other.txt"): "p/else/other.txt",
    }


def test_partitioned_round_trip_and_pruning(spark, frame, tmp_path):
    out = str(tmp_path / "t")
    df = frame([("A", "1", "x y", 1.0), ("A", "2", "z", 2.0), ("B", "1", "w", 3.0)], "league string, season string, `Player Name` string, `g+a` double")
    writers.write_partitioned(df, out)
    writers.write_partitioned(df.filter("league = 'A' AND season = '1'").withColumn("g+a", F.lit(9.0)), out)
    table = readers.scan_parquet(spark, out)
    assert {(r.league, str(r.season), r["g+a"]) for r in table.collect()} == {("A", "1", 9.0), ("A", "2", 2.0), ("B", "1", 3.0)}
    one = analysis.lookup(table, league="A")
    assert "PartitionFilters: [isnotnull(league" in plan(one) and one.count() == 2
    assert analysis.lookup_first([table.filter("league = 'none'"), table], league="B").count() == 1
    with pytest.raises(FileNotFoundError):
        analysis.lookup_first([table], league="C")
    files = readers.list_files(spark, out)
    assert files.count() == 3
    with pytest.raises(ValueError):
        readers.scan_parquet(spark, str(tmp_path / "t.csv"))


def test_one_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).select(F.lit("A").alias("league"), F.lit("1").alias("season"), F.col("id").cast("string").alias("v"))
    writers.write_partitioned(df, str(tmp_path / "hot"), rows_per_file=50_000)
    assert len(readers.scan_parquet(spark, str(tmp_path / "hot")).inputFiles()) >= 4


def test_read_tables_merges_columns(spark, frame, tmp_path):
    frame([(1, "a")], "x int, y string").coalesce(1).write.parquet(str(tmp_path / "updated_a.parquet"))
    frame([(2, 0.5)], "x int, z double").coalesce(1).write.parquet(str(tmp_path / "updated_b.parquet"))
    frame([(3,)], "x int").coalesce(1).write.parquet(str(tmp_path / "other.parquet"))
    got = readers.read_tables(spark, str(tmp_path))
    assert {(r.x, r.y, r.z) for r in got.collect()} == {(1, "a", None), (2, None, 0.5)}
    with pytest.raises(FileNotFoundError):
        readers.read_tables(spark, str(tmp_path), "absent_*.parquet")


def test_csv_round_trip(spark, frame, tmp_path):
    writers.write_csv(frame([("a,b", 1)], "player string, goals int"), str(tmp_path / "c"))
    back = readers.read_header_csv(spark, str(tmp_path / "c"))
    assert [(r.player, r.goals) for r in back.collect()] == [("a,b", "1")]


def test_season_grid(frame):
    grid = readers.season_grid(frame([("La-Liga", "https://x/12/")], "league string, base_url string"), ["2022-2023", "2023-2024"])
    assert grid.first().url == "https://x/12/2022-2023/stats/2022_2023-La_Liga-Stats" and grid.count() == 2


TABLE = '<table id="stats_standard"><tr><th colspan="2">Who</th><th rowspan=2>Gls</th></tr><tr><th>Player</th><th>Squad</th></tr><tr><td>Jo &amp; Al<br>x</td><td><b>Ajax</b> II</td><td>3</td></tr></table>'
GRID = [["Who", "Who", "Gls"], ["Player", "Squad", "Gls"], ["Jo & Alx", "Ajax II", "3"]]


def test_html_tables_in_all_places(frame):
    pages = {
        1: f"<html><table id=other><tr><td>no</td></tr></table>{TABLE}{TABLE}",
        2: f'<!-- stats_standard decoy --><div id="all_stats_standard"><div><p>x</p></div><!-- {TABLE} --></div>',
        3: f'<div id="all_stats_standard"></div><div><!-- {TABLE} --></div>',
        4: "<html><!-- nothing --><p>none</p></html>",
        5: None,
    }
    df = frame(list(pages.items()), "page_id long, html string")
    cells = html.html_tables(df, "stats_standard").collect()
    for page in (1, 2, 3):
        got = {(c.row_no, c.col_no): c.value for c in cells if c.page_id == page}
        assert got == {(r, c): v for r, row in enumerate(GRID) for c, v in enumerate(row)}
    assert {c.page_id for c in cells} == {1, 2, 3}
    made = html.html_tables(df, "stats_standard")
    assert {r.page_id for r in html.pages_without_table(df, made).collect()} == {4, 5}
    rows = html.table_rows(made.filter("page_id = 1"), ["player", "squad", "goals"]).orderBy("row_no").collect()
    assert [[r.player, r.squad, r.goals] for r in rows] == GRID
    assert {(r.page_id, r.comment.strip()[:5]) for r in html.html_comments(df, "stats_standard").collect()} == {(2, "stats"), (2, "<tabl"), (3, "<tabl")}


def test_worklist_and_paging(frame):
    rows = [("La-Liga", "2022-2023", "fe", "Ana", "Porto", None), ("La-Liga", "2022-2023", "fe", "Bo", None, " n/a "), (None, "x", "fe", "Cy", "X", ""), ("L", "s", "fe", "Di", "X", "5")]
    df = frame(rows, "league string, season string, variant string, Player string, squad string, `Market Value` string")
    work = correct.missing_worklist(df)
    got = {r.player: (r.dataset, r.team, r.closest_date, r.current_value) for r in work.collect()}
    assert got == {"Ana": ("La-Liga_2022-2023_fe", "Porto", "N/A", None), "Bo": ("La-Liga_2022-2023_fe", None, "N/A", " n/a ")}
    assert work.select(correct.shown_date(F.col("closest_date"), F.lit(2023)).alias("d")).first().d == "Approx. 2023"
    with pytest.raises(ValueError):
        correct.missing_worklist(df.drop("Market Value"))
    entries = frame([("d", i, f"p{i}") for i in range(25)] + [("e", 0, "q")], "dataset string, seq int, player string")
    pages = {(r.dataset, r.page): [e.player for e in r.entries] for r in correct.group_entries(entries, ["dataset"], [F.col("seq")], 10).collect()}
    assert pages == {("d", 0): [f"p{i}" for i in range(10)], ("d", 1): [f"p{i}" for i in range(10, 20)], ("d", 2): [f"p{i}" for i in range(20, 25)], ("e", 0): ["q"]}


def test_manual_values(frame):
    form = frame([("a", "2000000.0"), ("b", "-1000000.0"), ("c", "999999999.99"), ("d", ""), ("e", None), ("f", "  ")], "player string, manual_value string")
    assert {r.player: r.v for r in correct.parse_updates(form, "manual_value", "v").collect()} == {"a": 2000000.0, "b": -1000000.0, "c": 999999999.99}
    bad = form.union(frame([("g", "abc")], "player string, manual_value string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        correct.parse_updates(bad, "manual_value", "v").collect()
    good, rejected = correct.split_updates(bad, "manual_value", "v")
    assert good.count() == 3 and [r.player for r in rejected.collect()] == ["g"]
    empty = correct.parse_updates(form.filter("player = 'd'"), "manual_value", "v")
    assert empty.isEmpty()


def test_corrections(frame):
    df = frame([("Ana", "Porto", 1.0), ("ANA", "porto", 2.0), ("Bo", "X", 3.0), (None, "X", 4.0)], "player string, squad string, `Market Value` double")
    updates = frame([("ana", "PORTO", 9.0, 2), ("Ana", "Porto", 8.0, 1), ("Zoe", "X", 7.0, 3), ("Zoe", "X", 7.5, 4)], "player string, squad string, v double, seq int")
    fixed = correct.apply_corrections(df, updates, ["player", "squad"], "Market Value", "v", F.col("seq"))
    assert fixed.columns == df.columns
    assert {(r.player, r["Market Value"]) for r in fixed.collect()} == {("Ana", 9.0), ("ANA", 9.0), ("Bo", 3.0), (None, 4.0)}
    assert [r.v for r in correct.unmatched(df, updates, ["player", "squad"]).orderBy("v").collect()] == [7.0, 7.5]


def test_absurd_spans_end_with_the_table(frame):
    page = '<table id="t"><tr><td rowspan="999999999">a</td><td>b</td></tr><tr><td colspan="999999999">c</td></tr><tr><td>d</td></tr></table>'
    cells = html.html_tables(frame([(1, page)], "page_id long, html string"), "t")
    got = {(r.row_no, r.col_no): r.value for r in cells.filter("col_no < 3").collect()}
    assert got == {(0, 0): "a", (1, 0): "a", (2, 0): "a", (0, 1): "b", (1, 1): "c", (1, 2): "c", (2, 1): "d"}
    assert cells.count() == 5 + 1000


def test_corrections_of_texts(frame):
    df = frame([("x", "n/a"), ("Y", "5"), ("z", " - ")], "player string, v string")
    updates = frame([("X", 7.0, 1)], "player string, new_value double, seq int")
    got = {r.player: r.v for r in correct.apply_corrections(df, updates, ["player"], "v", "new_value", F.col("seq")).collect()}
    assert got == {"x": 7.0, "Y": 5.0, "z": None}


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n2,one\n')
    rows = readers.read_raw(spark, str(tmp_path), ["x", "y"], quoted_breaks=True).orderBy("line_order").collect()
    assert [(r.x, r.y) for r in rows] == [("x", "y"), ("1", "two\nlines"), ("2", "one")]


# --- versions


@pytest.fixture()
def versioned(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(i, f"l{i % 3}", 2020 + i % 2, float(i)) for i in range(60)], "id int, league string, season int, value double")
    versions.commit(rows, path, ["league", "season"])
    return path


def sums(df):
    return {(r.league, r.season): r.v for r in df.groupBy("league", "season").agg(F.sum("value").alias("v")).collect()}


def test_a_version_is_seen_whole_or_not_at_all(spark, versioned):
    """The second partition's rows fail on the way: readers keep the old version, and the next change works."""
    before = sums(versions.read_version(spark, versioned))

    def half(rows):
        broken = F.when(F.col("league") == "l2", F.raise_error(F.lit("lost"))).otherwise(F.col("value") + 1)
        return rows.filter("league <> 'l0'").withColumn("value", broken)

    with pytest.raises(Exception, match="lost"):
        versions.update(spark, versioned, ["league", "season"], half)
    assert versions.versions(spark, versioned) == [1] and sums(versions.read_version(spark, versioned)) == before
    versions.update(spark, versioned, ["league", "season"], lambda rows: rows.filter("league = 'l1'").withColumn("value", F.col("value") * 0))
    after = sums(versions.read_version(spark, versioned))
    assert after == {k: 0.0 if k[0] == "l1" else v for k, v in before.items()} and sums(versions.read_version(spark, versioned, 1)) == before


def test_two_correctors_at_once_lose_nothing(spark, versioned):
    before, met = sums(versions.read_version(spark, versioned)), []

    def slow(rows):
        if not met:
            met.append(1)
            versions.update(spark, versioned, ["league", "season"], lambda r: r.filter("league = 'l0'").withColumn("value", F.col("value") + 1000))
        return rows.withColumn("value", -F.col("value"))

    assert versions.update(spark, versioned, ["league", "season"], slow).number == 3
    # The slow one starts again from what the fast one has made.
    assert sums(versions.read_version(spark, versioned)) == {k: -(v + 10_000 if k[0] == "l0" else v) for k, v in before.items()}
    base = versions.current(spark, versioned, 1)
    with pytest.raises(versions.Conflict):
        versions.commit(versions.read_version(spark, versioned, 1), versioned, ["league", "season"], base)


def test_old_versions_go_and_empty_ones_stay_readable(spark, versioned, tmp_path):
    versions.update(spark, versioned, ["league", "season"], lambda rows: rows.filter("season = 2020").withColumn("value", F.lit(1.0)))
    now = sums(versions.read_version(spark, versioned))
    versions.commit(versions.read_version(spark, versioned).limit(0), str(tmp_path / "none"), ["league", "season"])
    empty = versions.read_version(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.columns == ["id", "league", "season", "value"]
    assert versions.clean_up(spark, versioned) > 0 and sums(versions.read_version(spark, versioned)) == now and versions.versions(spark, versioned) == [2]
    with pytest.raises(ValueError):
        versions.read_version(spark, versioned, 1)
    with pytest.raises(ValueError):
        versions.read_version(spark, str(tmp_path / "nothing"))
    flat = str(tmp_path / "flat")
    versions.commit(spark.range(5), flat)
    assert versions.commit(spark.range(7), flat, (), versions.current(spark, flat)).number == 2 and versions.read_version(spark, flat).count() == 7
