"""Sources, columns, cleaning and collapse operators bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuekit.functions import numbers, paths
from valuekit.operators import clean, collapse, correct, impute, quality, schema, windows
from valuekit.plans.registry import long, query, r4, sql_r4
from valuekit.session import fresh_path
from valuekit.sources import history, html, readers, writers

LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax",
]


def line_order():
    return [F.col(c) for c in LINE_ORDER]


SQL_LINE_ORDER = ", ".join(LINE_ORDER)


# ---- sources and paths ------------------------------------------------------------------------


@query(
    "scan_parquet",
    f"""SELECT l_returnflag, count(*) AS n_rows, {sql_r4('sum(l_quantity)')} AS quantity FROM lineitem GROUP BY l_returnflag""",
)
def scan_parquet(t):
    rows = readers.scan_parquet(t.spark, t.path("lineitem"))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), r4(F.sum("l_quantity")).alias("quantity"))


@query(
    "union_by_name",
    """SELECT o_orderkey AS key, o_totalprice AS amount, o_orderpriority AS priority, NULL::VARCHAR AS segment FROM orders
       UNION ALL SELECT c_custkey, c_acctbal, NULL, c_mktsegment FROM customer""",
)
def union_by_name(t):
    orders = t("orders").selectExpr("o_orderkey AS key", "o_totalprice AS amount", "o_orderpriority AS priority")
    customers = t("customer").selectExpr("c_mktsegment AS segment", "c_custkey AS key", "c_acctbal AS amount")
    return readers.union_by_name([orders, customers])


@query(
    "partitioned_round_trip",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders""",
)
def partitioned_round_trip(t):
    """Written by status and priority, then read back."""
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = fresh_path(orders.sparkSession)
    writers.write_partitioned(orders, path, ["o_orderstatus", "o_orderpriority"])
    return readers.scan_parquet(orders.sparkSession, path, orders.schema).select(*orders.columns)


@query("csv_round_trip", "SELECT c_custkey AS rank, c_name AS player, c_mktsegment AS squad FROM customer")
def csv_round_trip(t):
    """Written with a header, read by position, the repeated headers dropped by their content."""
    customers = t("customer").select("c_custkey", F.col("c_name").alias("player"), "c_mktsegment")
    path = fresh_path(customers.sparkSession)
    writers.write_csv(customers, path)
    raw = readers.read_raw(customers.sparkSession, path, ["rank", "player", "squad"])
    return clean.drop_header_rows(raw, "player").select(F.col("rank").cast("long").alias("rank"), "player", "squad")


SQL_SEASON = "(1995 + p_partkey % 7)::VARCHAR || '-' || (1996 + p_partkey % 7)::VARCHAR"


def part_paths(t):
    """A cleaned file path per part; every tenth has no season in it."""
    year = 1995 + F.col("p_partkey") % 7
    season = F.when(F.col("p_partkey") % 10 == 0, "latest").otherwise(F.concat_ws("-", year, year + 1))
    name = F.concat(
        F.when(F.col("p_partkey") % 2 == 0, "cleaned_").otherwise(""), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("_"), season, F.lit(".parquet")
    )
    return t("part").withColumn("path", F.concat(F.lit("data/cleaned/"), F.col("p_type"), F.lit("/"), name))


SQL_PART_PATH = f"""'data/cleaned/' || p_type || '/' || CASE WHEN p_partkey % 2 = 0 THEN 'cleaned_' ELSE '' END
    || replace(p_brand, '#', '') || '_' || CASE WHEN p_partkey % 10 = 0 THEN 'latest' ELSE {SQL_SEASON} END || '.parquet'"""


@query(
    "path_rename",
    f"""SELECT p_partkey, 'updated_' || replace(regexp_extract({SQL_PART_PATH}, '[^/]+$'), 'cleaned_', '') AS updated_name FROM part""",
)
def path_rename(t):
    return part_paths(t).select("p_partkey", paths.updated_name(F.col("path")).alias("updated_name"))


@query(
    "season_from_path",
    "SELECT p_partkey, (1996 + p_partkey % 7)::BIGINT AS season_end FROM part WHERE p_partkey % 10 <> 0",
)
def season_from_path(t):
    end = long(paths.season_end_year(F.col("path")))
    return part_paths(t).select("p_partkey", end.alias("season_end")).filter(F.col("season_end").isNotNull())


@query(
    "dataset_key",
    f"""WITH k AS (SELECT p_partkey, replace(p_brand, '#', '') AS league, {SQL_SEASON} AS season FROM part WHERE p_partkey % 4 <> 0)
        SELECT p_partkey, league, season, league || '_' || season || '_no_feature_engineering' AS dataset,
               'no_feature_engineering' AS variant FROM k
        UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 4 = 0""",
)
def dataset_key(t):
    year = 1995 + F.col("p_partkey") % 7
    brand = F.replace("p_brand", F.lit("#"), F.lit(""))
    name = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("updated_"), brand)).otherwise(
        F.concat_ws("_", F.lit("updated"), brand, F.concat_ws("-", year, year + 1))
    )
    league, season = paths.league_and_season(F.concat(F.lit("x/"), name, F.lit(".parquet")))
    keyed = t("part").select("p_partkey", paths.dataset_key(league, season, F.lit("no_feature_engineering")).alias("dataset"))
    again = paths.split_dataset_key(F.col("dataset"))
    return keyed.select("p_partkey", "dataset", *[c.alias(n) for c, n in zip(again, ("league", "season", "variant"))])


@query(
    "prediction_catalog",
    """WITH f AS (
         SELECT CASE p_partkey % 4 WHEN 0 THEN 'linear_regression' WHEN 1 THEN 'random_forest' WHEN 2 THEN 'xgboost' ELSE 'other' END AS folder,
                p_type AS variant, replace(p_brand, '#', '') || '_' || p_size::VARCHAR AS season FROM part)
       SELECT CASE folder WHEN 'linear_regression' THEN 'Linear Regression' WHEN 'random_forest' THEN 'Random Forest'
                          WHEN 'xgboost' THEN 'XGBoost' ELSE 'Unknown Model' END AS model_name,
              CASE folder WHEN 'other' THEN 'Unknown' ELSE variant END AS fe_variant, season AS league_season,
              max(folder || '/' || variant || '/predicted_updated_' || season || '.parquet') AS link
       FROM f GROUP BY 1, 2, 3""",
)
def prediction_catalog(t):
    folders = F.array(*[F.lit(f) for f in (*paths.MODEL_FOLDERS, "other")])
    folder = F.get(folders, (F.col("p_partkey") % 4).cast("int"))
    season = F.concat_ws("_", F.replace("p_brand", F.lit("#"), F.lit("")), "p_size")
    path = F.concat(F.lit("/data/predictions/"), folder, F.lit("/"), "p_type", F.lit("/predicted_updated_"), season, F.lit(".parquet"))
    return paths.prediction_catalog(t("part").select(path.alias("path")), base="/data/predictions")


def order_histories(t):
    """A JSON history of two entries per order; every seventh is empty, every eleventh has a bad date."""
    day = F.when(F.col("o_orderkey") % 11 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    entry = F.struct(day.alias("date"), F.col("o_orderpriority").alias("clubName"), F.col("o_totalprice").alias("marketValue"))
    later = F.struct(
        F.date_format(F.date_add(F.to_date("o_orderdate"), 200), "yyyy-MM-dd").alias("date"),
        F.col("o_orderstatus").alias("clubName"), (F.col("o_totalprice") * 2).alias("marketValue"),
    )
    nested = F.when(F.col("o_orderkey") % 7 == 0, "[]").otherwise(F.to_json(F.array(entry, later)))
    return t("orders").select("o_orderkey", nested.alias("history"))


@query(
    "history_explode",
    f"""SELECT o_orderkey AS id, 0::BIGINT AS position, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
               o_orderpriority AS club, {sql_r4('o_totalprice')} AS value FROM orders WHERE o_orderkey % 7 <> 0
        UNION ALL SELECT o_orderkey, 1, strftime(o_orderdate + INTERVAL 200 DAY, '%Y-%m-%d'), o_orderstatus, {sql_r4('o_totalprice * 2')}
        FROM orders WHERE o_orderkey % 7 <> 0""",
)
def history_explode(t):
    flat = history.explode_history(order_histories(t), "o_orderkey", "history")
    return flat.select("id", long(F.col("position")).alias("position"), F.col("date").cast("string").alias("day"), "club", r4(F.col("value")).alias("value"))


@query(
    "html_comment_extract",
    """SELECT page_id, (i - 1)::BIGINT AS comment_no, c[i] AS comment
       FROM (SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS c FROM pages), generate_series(1, len(c)) AS s(i)""",
)
def html_comment_extract(t):
    return html.html_comments(t("pages")).withColumn("comment_no", long(F.col("comment_no")))


@query(
    "html_table_rows",
    """SELECT page_id, 0::BIGINT AS row_no, 0::BIGINT AS col_no, 'id' AS value FROM pages
       UNION ALL SELECT page_id, 0, 1, 'url' FROM pages
       UNION ALL SELECT page_id, 1, 0, page_id::VARCHAR FROM pages WHERE page_id % 3 <> 2
       UNION ALL SELECT page_id, 1, 1, url FROM pages WHERE page_id % 3 <> 2
       UNION ALL SELECT page_id, 1, c, 'both' FROM pages, (VALUES (0), (1)) AS v(c) WHERE page_id % 3 = 2""",
)
def html_table_rows(t):
    """Every page gets a table: plain, in a comment inside its wrapper, or in a comment with a wide cell."""
    row = F.concat(F.lit("<td>"), F.col("page_id").cast("string"), F.lit("</td><td>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</td>"))
    row = F.when(F.col("page_id") % 3 == 2, '<td colspan="2">both</td>').otherwise(row)
    table = F.concat(F.lit('<table id="stats_standard"><thead><tr><th>id</th><th>url</th></tr></thead><tbody><tr>'), row, F.lit("</tr></tbody></table>"))
    commented = F.concat(F.lit("<!-- "), table, F.lit(" -->"))
    wrapped = F.concat(F.lit('<div id="all_stats_standard">'), commented, F.lit("</div>"))
    kind = F.col("page_id") % 3
    pages = t("pages").withColumn("html", F.concat("html", F.when(kind == 0, table).when(kind == 1, wrapped).otherwise(commented)))
    return html.html_tables(pages, "stats_standard").select("page_id", long(F.col("row_no")).alias("row_no"), long(F.col("col_no")).alias("col_no"), "value")


@query(
    "grid_url",
    """SELECT n_name AS league, s AS season,
              'https://' || lower(r_name) || '.example/' || s || '/stats/' || replace(s, '-', '_') || '-' || n_name || '-Stats' AS url
       FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES ('2022-2023'), ('2023-2024')) AS v(s)""",
)
def grid_url(t):
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    leagues = nations.select(
        F.replace("n_name", F.lit("_"), F.lit("-")).alias("league"),
        F.concat(F.lit("https://"), F.lower("r_name"), F.lit(".example/")).alias("base_url"), "n_name",
    )
    return readers.season_grid(leagues, ["2022-2023", "2023-2024"]).select(F.col("n_name").alias("league"), "season", "url")


SQL_RAW_PRICE = """CASE o_orderkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN '1d' WHEN 2 THEN ' ' || o_custkey::VARCHAR || ' ' WHEN 3 THEN '2,700'
    WHEN 4 THEN o_custkey::VARCHAR || '.5' WHEN 5 THEN '-' || o_custkey::VARCHAR || 'e2' WHEN 6 THEN NULL WHEN 7 THEN '' ELSE o_custkey::VARCHAR END"""


def raw_prices(t):
    """Order keys with numbers as text, some of them spoilt."""
    number = F.col("o_custkey").cast("string")
    cases = ["n/a", "1d", F.concat(F.lit(" "), number, F.lit(" ")), "2,700", F.concat(number, F.lit(".5")), F.concat(F.lit("-"), number, F.lit("e2")), None, ""]
    raw = F.lit(None).cast("string")
    for i, case in enumerate(cases):
        raw = F.when(F.col("o_orderkey") % 10 == i, case).otherwise(raw)
    return t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 >= 8, number).otherwise(raw).alias("raw"))


@query("reject_rows", f"SELECT o_orderkey, coalesce(raw, '(none)') AS raw FROM (SELECT o_orderkey, {SQL_RAW_PRICE} AS raw FROM orders) WHERE raw IS NULL OR raw IN ('n/a', '1d', '2,700', '')")
def reject_rows(t):
    _, bad = clean.reject_rows(raw_prices(t), numbers.to_number(F.col("raw")).isNotNull())
    return bad.select("o_orderkey", F.coalesce("raw", F.lit("(none)")).alias("raw"))


# ---- columns, types and filters ----------------------------------------------------------------


@query("normalize_names", "SELECT c_custkey AS customer_key, c_name AS full_name, c_acctbal AS balance FROM customer")
def normalize_names(t):
    return schema.normalize_names(t("customer").select("c_custkey", "c_name", "c_acctbal").toDF("Customer Key", "Full Name", "BALANCE"))


@query("positional_rename", "SELECT s_suppkey AS id, s_name AS name, s_nationkey::BIGINT AS nation FROM supplier")
def positional_rename(t):
    return schema.positional_rename(t("supplier"), ["id", "name", "nation"]).withColumn("nation", long(F.col("nation")))


@query(
    "coerce_numeric",
    f"""SELECT o_orderkey, CASE WHEN regexp_full_match(trim(raw), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN trim(raw)::DOUBLE END AS raw
        FROM (SELECT o_orderkey, {SQL_RAW_PRICE} AS raw FROM orders)""",
)
def coerce_numeric(t):
    return schema.coerce_numeric(raw_prices(t), ["raw"])


@query(
    "low_cardinality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct, (count(DISTINCT {c}) < 0.5 * count(*))::INT::BIGINT AS is_category FROM documents"
        for c in ("text", "lang", "source")
    ),
)
def low_cardinality(t):
    return schema.low_cardinality(t("documents"), ["text", "lang", "source"]).withColumn("is_category", long(F.col("is_category")))


@query("drop_header_rows", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 50 <> 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 100 = 0")
def drop_header_rows(t):
    name = F.when(F.col("c_custkey") % 100 == 0, None).when(F.col("c_custkey") % 50 == 0, "C_Name").otherwise(F.col("c_name"))
    return clean.drop_header_rows(t("customer").select("c_custkey", name.alias("c_name")), "c_name")


@query(
    "clean_code",
    """SELECT c_custkey, CASE WHEN c_custkey % 9 IN (0, 1) THEN NULL ELSE upper(n_name) END AS code
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def clean_code(t):
    code = F.when(F.col("c_custkey") % 9 == 0, "Nation").when(F.col("c_custkey") % 9 == 1, None).otherwise(
        F.concat(F.lit(" xx  "), F.lower("n_name"), F.lit(" "))
    )
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", numbers.clean_code(code).alias("code"))


@query("drop_redundant", "SELECT p_partkey, p_name, p_retailprice FROM part")
def drop_redundant(t):
    return clean.drop_columns(t("part"), ["p_brand", "p_type", "p_size", "not_there"])


def gappy_lines(t):
    """Line items with a discount known for a tenth of the lines (all of them for flag R) and a patchy tax."""
    known = (F.col("l_returnflag") == "R") | (F.col("l_orderkey") % 10 == 0)
    return t("lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_quantity",
        F.when(known, F.col("l_discount")).alias("l_discount"), F.when(F.col("l_orderkey") % 3 > 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_orderkey") % 4 > 0, F.col("l_linestatus")).alias("status"),
    )


SQL_GAPPY = """gappy AS (SELECT l_returnflag, l_linestatus, l_orderkey, l_quantity,
      CASE WHEN l_returnflag = 'R' OR l_orderkey % 10 = 0 THEN l_discount END AS l_discount,
      CASE WHEN l_orderkey % 3 > 0 THEN l_tax END AS l_tax,
      CASE WHEN l_orderkey % 4 > 0 THEN l_linestatus END AS status FROM lineitem),
    shares AS (SELECT l_returnflag, count(l_discount) < floor(0.3 * count(*)) AS no_discount, count(l_tax) < floor(0.3 * count(*)) AS no_tax FROM gappy GROUP BY 1),
    masked AS (SELECT g.* REPLACE (CASE WHEN no_discount THEN NULL ELSE l_discount END AS l_discount, CASE WHEN no_tax THEN NULL ELSE l_tax END AS l_tax), no_discount, no_tax
      FROM gappy g JOIN shares USING (l_returnflag))"""


def summary(df):
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("l_discount").alias("n_discount"), r4(F.sum("l_discount")).alias("discount"),
        F.count("l_tax").alias("n_tax"), r4(F.sum("l_tax")).alias("tax"),
    )


SQL_SUMMARY = f"""SELECT l_returnflag, l_linestatus, count(l_discount) AS n_discount, {sql_r4('sum(l_discount)')} AS discount,
    count(l_tax) AS n_tax, {sql_r4('sum(l_tax)')} AS tax"""


@query("drop_sparse", f"WITH {SQL_GAPPY} {SQL_SUMMARY} FROM masked GROUP BY 1, 2")
def drop_sparse(t):
    return summary(impute.drop_sparse(gappy_lines(t), 0.3, ["l_returnflag"], ["l_discount", "l_tax"]))


@query(
    "fill_zero",
    f"""WITH {SQL_GAPPY}, filled AS (SELECT * REPLACE (CASE WHEN no_discount THEN NULL ELSE coalesce(l_discount, 0) END AS l_discount,
        CASE WHEN no_tax THEN NULL ELSE coalesce(l_tax, 0) END AS l_tax) FROM masked) {SQL_SUMMARY} FROM filled GROUP BY 1, 2""",
)
def fill_zero(t):
    return summary(clean.fill_zero(impute.drop_sparse(gappy_lines(t), 0.3, ["l_returnflag"], ["l_discount", "l_tax"])))


@query("add_constant", "SELECT r_regionkey::BIGINT AS r_regionkey, 'La-Liga' AS r_name, '2023-2024' AS season FROM region")
def add_constant(t):
    return clean.add_constants(t("region"), {"r_name": "La-Liga", "season": "2023-2024"}).withColumn("r_regionkey", long(F.col("r_regionkey")))


@query("range_filter", "SELECT p_partkey, p_size::BIGINT AS p_size FROM part WHERE p_size BETWEEN 16 AND 45 AND p_retailprice >= 905 AND p_partkey % 10 <> 0")
def range_filter(t):
    size = F.when(F.col("p_partkey") % 10 == 0, None).otherwise(long(F.col("p_size")))
    parts = t("part").withColumn("p_size", size)
    return clean.range_filter(parts, {"p_size": (16, 45), "p_retailprice": (905, None), "absent": (0, 1)}).select("p_partkey", "p_size")


@query("missing_predicate", f"SELECT coalesce(raw, '(null)') AS raw, (raw IS NULL OR lower(trim(raw)) IN ('', 'n/a', 'na', 'null', 'none', 'nan', '-'))::INT::BIGINT AS missing, count(*) AS n_rows FROM (SELECT o_orderkey, {SQL_RAW_PRICE} AS raw FROM orders) GROUP BY 1, 2")
def missing_predicate(t):
    flagged = raw_prices(t).withColumn("missing", long(numbers.is_missing(F.col("raw"))))
    return flagged.groupBy(F.coalesce("raw", F.lit("(null)")).alias("raw"), "missing").agg(F.count("*").alias("n_rows"))


# ---- collapse, dedupe, impute ------------------------------------------------------------------


@query(
    "dedupe_first",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_partkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_LINE_ORDER}) = 1""",
)
def dedupe_first(t):
    first = clean.dedupe_first(t("lineitem"), ["l_orderkey", "l_linenumber"], line_order())
    return first.select("l_orderkey", long(F.col("l_linenumber")).alias("l_linenumber"), "l_suppkey", "l_partkey", "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


def part_seasons(t):
    """Line items as rows of a part's season: weights are quantities (0 for every twentieth part), discounts have gaps."""
    part = F.col("l_partkey")
    return t("lineitem").select(
        "l_partkey", long(F.year("l_shipdate")).alias("season"),
        F.when(part % 20 == 0, 0.0).otherwise(F.col("l_quantity")).alias("l_quantity"), "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.col("l_suppkey").cast("string").alias("squad"),
        F.concat_ws(", ", "l_returnflag", "l_linestatus").alias("position"),
        F.when(part % 7 > 0, F.col("l_linestatus")).alias("status"),
        *[F.col(c).alias(f"o_{i}") for i, c in enumerate(LINE_ORDER)],
    )


SQL_PART_SEASONS = """s AS (SELECT l_partkey, year(l_shipdate) AS season, CASE WHEN l_partkey % 20 = 0 THEN 0.0 ELSE l_quantity END AS w,
    l_extendedprice AS p, nullif(l_discount, 0) AS d, l_suppkey::VARCHAR AS squad, l_returnflag, l_linestatus,
    CASE WHEN l_partkey % 7 > 0 THEN l_linestatus END AS status FROM lineitem)"""
KEYS = ["l_partkey", "season"]


@query(
    "weighted_collapse",
    f"""WITH {SQL_PART_SEASONS} SELECT l_partkey, season, {sql_r4('sum(w)')} AS l_quantity,
        {sql_r4('CASE WHEN sum(w) > 0 THEN sum(p * w) / sum(w) ELSE avg(p) END')} AS l_extendedprice,
        {sql_r4('CASE WHEN sum(w) <= 0 THEN avg(d) WHEN count(d) = count(*) THEN sum(d * w) / sum(w) END')} AS l_discount FROM s GROUP BY 1, 2""",
)
def weighted_collapse(t):
    one = collapse.collapse(part_seasons(t), KEYS, "l_quantity", {"l_quantity": "sum", "l_extendedprice": "wmean", "l_discount": "wmean"})
    return one.select(*KEYS, *[r4(F.col(c)).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount")])


@query(
    "weighted_collapse_skip_nulls",
    f"""WITH {SQL_PART_SEASONS}, k AS (SELECT *, CASE WHEN d IS NOT NULL THEN w END AS kw FROM s)
        SELECT l_partkey, season, {sql_r4('CASE WHEN sum(kw) > 0 THEN sum(d * kw) / sum(kw) ELSE avg(d) END')} AS l_discount FROM k GROUP BY 1, 2""",
)
def weighted_collapse_skip_nulls(t):
    one = collapse.collapse(part_seasons(t), KEYS, "l_quantity", {"l_discount": "wmean"}, nulls="skip")
    return one.select(*KEYS, r4(F.col("l_discount")).alias("l_discount"))


@query(
    "distinct_join",
    f"""WITH {SQL_PART_SEASONS} SELECT l_partkey, season, string_agg(DISTINCT squad, '/' ORDER BY squad) AS squad,
        string_agg(DISTINCT status, '/' ORDER BY status) AS status FROM s GROUP BY 1, 2""",
)
def distinct_join(t):
    return collapse.collapse(part_seasons(t), KEYS, "l_quantity", {"squad": "join_blank", "status": "join"})


@query(
    "token_union",
    f"""WITH {SQL_PART_SEASONS}, k AS (SELECT l_partkey, season, unnest([l_returnflag, l_linestatus]) AS token FROM s)
        SELECT l_partkey, season, string_agg(DISTINCT token, ', ' ORDER BY token) AS position FROM k GROUP BY 1, 2""",
)
def token_union(t):
    return collapse.collapse(part_seasons(t), KEYS, "l_quantity", {"position": "tokens"})


@query(
    "sum_collapse",
    f"""SELECT l_partkey, year(l_shipdate) AS season, {sql_r4('sum(l_extendedprice)')} AS l_extendedprice,
        {sql_r4('sum(nullif(l_discount, 0))')} AS l_discount,
        arg_min(l_suppkey::VARCHAR, ({SQL_LINE_ORDER})) AS squad FROM lineitem GROUP BY 1, 2""",
)
def sum_collapse(t):
    order = [F.col(f"o_{i}") for i in range(len(LINE_ORDER))]
    one = collapse.collapse(part_seasons(t), KEYS, "l_quantity", {"l_extendedprice": "sum", "l_discount": "sum", "squad": "first"}, order=order)
    return one.select(*KEYS, *[r4(F.col(c)).alias(c) for c in ("l_extendedprice", "l_discount")], "squad")


@query(
    "impute_median",
    f"""WITH g AS (SELECT l_returnflag, l_linestatus, nullif(l_discount, 0) AS l_discount, CASE WHEN l_orderkey % 3 > 0 THEN l_tax END AS l_tax FROM lineitem),
        m AS (SELECT l_returnflag, median(l_discount) AS md, median(l_tax) AS mt FROM g GROUP BY 1),
        f AS (SELECT l_returnflag, l_linestatus, coalesce(l_discount, md) AS l_discount, coalesce(l_tax, mt) AS l_tax FROM g JOIN m USING (l_returnflag))
        {SQL_SUMMARY} FROM f GROUP BY 1, 2""",
)
def impute_median(t):
    lines = t("lineitem").select(
        "l_returnflag", "l_linestatus", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_orderkey") % 3 > 0, F.col("l_tax")).alias("l_tax"),
    )
    return summary(impute.impute(lines, ["l_discount", "l_tax"], by=["l_returnflag"]))


@query(
    "impute_mode",
    """WITH g AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS p FROM orders),
       m AS (SELECT o_orderstatus, p AS top FROM g WHERE p IS NOT NULL GROUP BY 1, 2
             QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, p) = 1)
       SELECT o_orderstatus, coalesce(p, top) AS o_orderpriority, count(*) AS n_rows FROM g JOIN m USING (o_orderstatus) GROUP BY 1, 2""",
)
def impute_mode(t):
    gaps = t("orders").select("o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    filled = impute.impute(gaps, text=["o_orderpriority"], by=["o_orderstatus"])
    return filled.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n_rows"))


@query(
    "group_first",
    f"""SELECT l_partkey, arg_min(l_suppkey, ({SQL_LINE_ORDER})) AS l_suppkey,
        arg_min(nullif(l_discount, 0), ({SQL_LINE_ORDER})) FILTER (nullif(l_discount, 0) IS NOT NULL) AS l_discount,
        arg_min(l_linestatus, ({SQL_LINE_ORDER})) FILTER (l_orderkey % 3 > 0) AS status FROM lineitem GROUP BY 1""",
)
def group_first(t):
    place = F.struct(*LINE_ORDER)
    rows = t("lineitem").select(
        "l_partkey", "l_suppkey", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_orderkey") % 3 > 0, F.col("l_linestatus")).alias("status"), place.alias("place"),
    )
    return clean.group_first(rows, ["l_partkey"], [F.col("place")]).drop("place")


@query("duplicate_report", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_report(t):
    return quality.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"]).withColumn("l_linenumber", long(F.col("l_linenumber")))


@query(
    "unmapped_codes",
    "SELECT DISTINCT 'NATION_' || (c_nationkey + c_custkey % 7)::VARCHAR AS code FROM customer WHERE 'NATION_' || (c_nationkey + c_custkey % 7)::VARCHAR NOT IN (SELECT n_name FROM nation)",
)
def unmapped_codes(t):
    """Some of the customers' codes have no nation."""
    codes = t("customer").select(F.concat_ws("_", F.lit("NATION"), F.col("c_nationkey") + F.col("c_custkey") % 7).alias("code"))
    return quality.unmapped(codes, "code", t("nation"), "n_name")


PROFILED = ["l_returnflag", "l_suppkey", "l_quantity"]


@query(
    "profile",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_known, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in PROFILED),
)
def profile(t):
    return quality.profile(t("lineitem"), PROFILED)


@query(
    "group_std",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, {sql_r4('stddev_samp(l_quantity) OVER (PARTITION BY l_partkey, year(l_shipdate), l_linestatus)')} AS spread FROM lineitem""",
)
def group_std(t):
    rows = t("lineitem").withColumn("season", F.year("l_shipdate"))
    spread = windows.group_std(rows, "l_quantity", ["l_partkey", "season", "l_linestatus"], "spread")
    return spread.select("l_orderkey", long(F.col("l_linenumber")).alias("l_linenumber"), "l_suppkey", r4(F.col("spread")).alias("spread"))


@query(
    "rank_in_group",
    "SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey, o_orderkey) AS rank FROM orders",
)
def rank_in_group(t):
    return windows.rank_in(t("orders").select("o_orderkey", "o_orderpriority", "o_custkey"), ["o_orderpriority"], [F.col("o_custkey"), F.col("o_orderkey")]).drop("o_custkey")


# ---- worklists and corrections -----------------------------------------------------------------


def valued_customers(t):
    """Customers as players of one league per market segment; some values are missing in various ways."""
    key = F.col("c_custkey")
    value = F.when(key % 10 == 0, "n/a").when(key % 10 == 1, " - ").when(key % 10 == 2, None).otherwise(key.cast("string"))
    return t("customer").select(
        F.col("c_mktsegment").alias("league"), F.lit("1997-1998").alias("season"), F.lit("no_feature_engineering").alias("variant"),
        F.col("c_name").alias("player"), value.alias("Market Value"), "c_custkey",
    )


SQL_WORKLIST = """w AS (SELECT c_mktsegment || '_1997-1998_no_feature_engineering' AS dataset, '1997-1998' AS season, c_name AS player, 'Unknown' AS team,
    'N/A' AS closest_date, CASE c_custkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN ' - ' END AS current_value, 'no_feature_engineering' AS fe_variant
    FROM customer WHERE c_custkey % 10 < 3)"""


@query("missing_worklist", f"WITH {SQL_WORKLIST} SELECT * FROM w")
def missing_worklist(t):
    return correct.missing_worklist(valued_customers(t))


@query(
    "group_entries",
    f"""WITH {SQL_WORKLIST}, n AS (SELECT *, (row_number() OVER (PARTITION BY dataset ORDER BY player) - 1) // 25 AS page FROM w)
        SELECT dataset, page, count(*) AS n_entries, string_agg(player, '|' ORDER BY player) AS players FROM n GROUP BY 1, 2""",
)
def group_entries(t):
    pages = correct.group_entries(correct.missing_worklist(valued_customers(t)), ["dataset"], [F.col("player")], page_rows=25)
    players = F.array_join(F.transform("entries", lambda e: e["player"]), "|")
    return pages.select("dataset", "page", long(F.size("entries")).alias("n_entries"), players.alias("players"))


SQL_UPDATES = """u AS (SELECT CASE WHEN c_custkey % 100 = 0 THEN 'nobody ' || c_custkey::VARCHAR ELSE upper(c_name) END AS player, c_mktsegment AS team,
    v AS attempt, c_custkey * v * 1.5 AS new_value FROM customer, (VALUES (1), (2)) AS x(v) WHERE c_custkey % 50 = 0)"""


def value_updates(t):
    """Two updates each for every fiftieth customer; half of the names are unknown."""
    key = F.col("c_custkey")
    name = F.when(key % 100 == 0, F.concat_ws(" ", F.lit("nobody"), key)).otherwise(F.upper("c_name"))
    return t("customer").filter(key % 50 == 0).select(
        name.alias("player"), F.col("c_mktsegment").alias("team"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"), key.alias("key"),
    ).select("player", "team", "attempt", (F.col("key") * F.col("attempt") * 1.5).alias("new_value"))


@query(
    "parse_updates",
    "SELECT c_custkey, (c_custkey * 10)::DOUBLE + 0.5 AS new_value FROM customer WHERE c_custkey % 4 <> 0",
)
def parse_updates(t):
    key = F.col("c_custkey")
    text = F.when(key % 8 == 0, "  ").when(key % 8 == 4, None).otherwise(F.concat(F.lit(" "), (key * 10).cast("string"), F.lit(".5")))
    return correct.parse_updates(t("customer").select("c_custkey", text.alias("manual_value")), "manual_value", "new_value").select("c_custkey", "new_value")


@query(
    "apply_updates",
    f"""WITH {SQL_UPDATES} SELECT c_custkey, c_name, {sql_r4('coalesce(new_value, c_acctbal)')} AS c_acctbal FROM customer
        LEFT JOIN (SELECT * FROM u WHERE attempt = 2) q ON lower(c_name) = lower(q.player) AND lower(c_mktsegment) = lower(q.team)""",
)
def apply_updates(t):
    customers = t("customer").withColumnsRenamed({"c_name": "player", "c_mktsegment": "team"})
    changed = correct.apply_corrections(customers, value_updates(t), ["player", "team"], "c_acctbal", "new_value", F.col("attempt"))
    return changed.select("c_custkey", F.col("player").alias("c_name"), r4(F.col("c_acctbal")).alias("c_acctbal"))


@query("unmatched_updates", f"WITH {SQL_UPDATES} SELECT player, team, attempt::BIGINT AS attempt, {sql_r4('new_value')} AS new_value FROM u WHERE player LIKE 'nobody%'")
def unmatched_updates(t):
    customers = t("customer").withColumnsRenamed({"c_name": "player", "c_mktsegment": "team"})
    return correct.unmatched(customers, value_updates(t), ["player", "team"]).select("player", "team", long(F.col("attempt")).alias("attempt"), r4(F.col("new_value")).alias("new_value"))
