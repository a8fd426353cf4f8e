"""Folders, names, types, publishing and stored models bound to the driver's tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from valuekit.ml import prep, train
from valuekit.ml.models import LOG_LABEL, Ridge, log_pipeline
from valuekit.operators import clean, collapse, correct, schema
from valuekit.plans import players
from valuekit.plans.model_queries import GROUP, TARGET
from valuekit.plans.registry import long, query, r4, sql_r4
from valuekit.plans.table_queries import valued_customers
from valuekit.session import fresh_path
from valuekit.sources import readers, versions, writers


@query("read_folder", "SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status FROM orders")
def read_folder(t):
    """A folder of CSV files per status, read in one go; the status comes from the path."""
    orders = t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    path = fresh_path(t.spark)
    writers.write_csv(orders, path, ["o_orderstatus"])
    raw = readers.read_raw(t.spark, path, ["key", "priority"])
    rows = clean.drop_header_rows(raw.withColumn("player", F.when(F.col("key") == "o_orderkey", "Player").otherwise("")), "player")
    status = F.regexp_extract(F.col(readers.FILE), "o_orderstatus=([^/]+)", 1)
    return rows.select(F.col("key").cast("long").alias("o_orderkey"), "priority", status.alias("status"))


@query("flatten_names", "SELECT n_nationkey AS key_id, n_name AS name_of_nation, n_regionkey AS nan_region FROM nation")
def flatten_names(t):
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    return nation.toDF(*schema.flatten_names([(" key ", "id"), ("name", "", "of", "nan", "nation "), ("nan_region", None)]))


@query("rename_if_absent", "SELECT n_nationkey, n_name AS nation, n_regionkey FROM nation")
def rename_if_absent(t):
    """The second rename would repeat a name, and the third has nothing to rename: both leave the table as it is."""
    nation = schema.rename_if_absent(t("nation").select("n_nationkey", "n_name", "n_regionkey"), "n_name", "nation")
    return schema.rename_if_absent(schema.rename_if_absent(nation, "n_regionkey", "nation"), "absent", "other")


@query(
    "columns_by_type",
    """SELECT c_custkey, 'numeric' AS kind, 'c_acctbal' AS column_name, c_acctbal::VARCHAR AS value FROM customer
       UNION ALL SELECT c_custkey, 'text', 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'text', 'c_name', c_name FROM customer""",
)
def columns_by_type(t):
    rows = t("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    kinds = {"numeric": schema.numeric_columns(rows, ["c_custkey"]), "text": schema.text_columns(rows)}
    cells = [
        F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for kind, names in kinds.items() for c in names
    ]
    return rows.select("c_custkey", F.explode(F.array(*cells)).alias("cell")).select("c_custkey", "cell.*")


@query("value_column", "SELECT c_custkey, c_acctbal AS value FROM customer")
def value_column(t):
    named = t("customer").withColumnsRenamed({"c_acctbal": "Market_Value", "c_name": "old market value"})
    return named.select("c_custkey", F.col(schema.resolve_value_column(named.columns)).alias("value"))


@query("essential_columns", "SELECT o_orderkey, o_custkey FROM orders")
def essential_columns(t):
    orders = schema.require_columns(t("orders"), ["o_orderkey", "o_custkey"])
    try:
        schema.require_columns(orders, ["player"])
    except ValueError:
        return orders.select("o_orderkey", "o_custkey")
    raise AssertionError("a missing column was let through")


def seasons(t):
    return t("orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("league"), F.concat(F.year("o_orderdate"), F.lit("-"), F.year("o_orderdate") + 1).alias("season")
    )


@query(
    "publish_variants",
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS league, year(o_orderdate)::VARCHAR || '-' || (year(o_orderdate) + 1)::VARCHAR AS season, v.variant,
         CASE WHEN v.variant = 'feature_engineering' THEN o_totalprice * 2 END AS twice
       FROM orders, (VALUES ('feature_engineering'), ('no_feature_engineering')) v(variant)""",
)
def publish_variants(t):
    """Two variants in one table, whose files hold neither league nor season: the folders do."""
    rows, path = seasons(t), fresh_path(t.spark)
    players.publish({"feature_engineering": rows.withColumn("twice", F.col("o_totalprice") * 2), "no_feature_engineering": rows}, path)
    published = t.spark.read.option("mergeSchema", True).parquet(path)
    return published.select("o_orderkey", "o_totalprice", "league", "season", "variant", "twice")


@query(
    "corrections_round_trip",
    f"""SELECT c_custkey, c_mktsegment AS league, {sql_r4("CASE WHEN c_custkey % 20 = 0 AND c_mktsegment = 'BUILDING' THEN 1000 + c_custkey WHEN c_custkey % 10 > 2 THEN c_custkey END")} AS value FROM customer""",
)
def corrections_round_trip(t):
    """Values as text, some missing, published; corrections of one league written back; then all leagues read."""
    path = fresh_path(t.spark)
    key = F.col("c_custkey")
    text = F.when(key % 10 == 0, "n/a").when(key % 10 == 1, " - ").when(key % 10 == 2, None).otherwise(key.cast("string"))
    rows = t("customer").select(
        "c_custkey", F.col("c_name").alias("player"), F.lit("club").alias("squad"), correct.to_number(text).alias("Market Value"),
        F.col("c_mktsegment").alias("league"), F.lit("2020-2021").alias("season"), F.lit("enhanced_feature_engineering").alias("variant"),
    )
    writers.write_partitioned(rows, path, ["variant", "league", "season"])
    found = t.spark.read.parquet(path)
    work = players.worklist(found).join(found.select("player", "c_custkey", "league"), "player")
    updates = work.filter("league = 'BUILDING' AND c_custkey % 20 = 0").select(
        "dataset", F.upper("player").alias("player"), "team", (F.col("c_custkey") + 1000.0).alias("manual_transfer_value"), F.lit(1).alias("seq")
    )
    players.publish_corrections(t.spark, path, updates, F.col("seq"))
    return t.spark.read.parquet(path).select("c_custkey", "league", r4(F.col("Market Value")).alias("value"))


@query(
    "apply_updates_to_text",
    f"""SELECT c_custkey, {sql_r4("CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 0.5 WHEN c_custkey % 10 > 2 THEN c_custkey END")} AS value FROM customer""",
)
def apply_updates_to_text(t):
    """The value column is text and holds the sentinels that worklists name."""
    rows = valued_customers(t)
    value = schema.resolve_value_column(rows.columns)
    updates = rows.filter("c_custkey % 7 = 0").select("player", (F.col("c_custkey") + 0.5).alias("new_value"), F.lit(1).alias("seq"))
    return correct.apply_corrections(rows, updates, ["player"], value, "new_value", F.col("seq")).select("c_custkey", r4(F.col(value)).alias("value"))


@query(
    "collapse_text_fallback",
    """SELECT l_partkey, CASE WHEN l_partkey % 3 = 0 THEN string_agg(DISTINCT l_returnflag || '-' || l_linestatus, '/' ORDER BY l_returnflag || '-' || l_linestatus)
         ELSE round(sum(l_linenumber * l_quantity) / sum(l_quantity) * 1000)::BIGINT::VARCHAR END AS born FROM lineitem GROUP BY l_partkey""",
)
def collapse_text_fallback(t):
    """A column that holds numbers for some keys and texts for others."""
    born = F.when(F.col("l_partkey") % 3 == 0, F.concat_ws("-", "l_returnflag", "l_linestatus")).otherwise(F.col("l_linenumber").cast("string"))
    rows = t("lineitem").select("l_partkey", "l_quantity", born.alias("born"))
    one = collapse.collapse(rows, ["l_partkey"], "l_quantity", {"born": "wmean_or_join"})
    number = F.round(F.expr("try_cast(born AS double)") * 1000).cast("long").cast("string")
    return one.select("l_partkey", F.coalesce(number, "born").alias("born"))


@query(
    "assemble_vector",
    f"""WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS d FROM lineitem)
        SELECT l_linestatus, (i - 1)::BIGINT AS slot, {sql_r4("sum(CASE i WHEN 1 THEN (l_quantity - m) / d WHEN 2 THEN (l_returnflag = 'A')::INT WHEN 3 THEN (l_returnflag = 'N')::INT ELSE (l_returnflag = 'R')::INT END)")} AS total
        FROM lineitem, s, generate_series(1, 4) AS g(i) GROUP BY 1, 2""",
)
def assemble_vector(t):
    """Scaled numbers first, then an indicator per level."""
    rows = t("lineitem").select("l_linestatus", "l_quantity", "l_returnflag")
    encoded = Pipeline(stages=prep.prep_stages(rows, ["l_linestatus"])).fit(rows).transform(rows)
    slots = encoded.select("l_linestatus", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.groupBy("l_linestatus", long(F.col("slot")).alias("slot")).agg(r4(F.sum("value")).alias("total"))


@query("model_round_trip", "SELECT l_partkey, count(*) AS n_rows, count(*) AS n_same FROM lineitem GROUP BY 1")
def model_round_trip(t):
    """A model that was saved and loaded predicts what it did before, row by row."""
    rows = t("lineitem").select("l_orderkey", "l_linenumber", GROUP, TARGET, "l_quantity", "l_returnflag")
    model = log_pipeline(rows, Ridge(labelCol=LOG_LABEL), TARGET, [GROUP, "l_orderkey", "l_linenumber"]).fit(rows)
    path = fresh_path(t.spark)
    train.save_model(model, path)
    before = train.score(model, rows, TARGET, "before")
    both = train.score(PipelineModel.load(path), before.withColumnRenamed("before", "__before"), TARGET, "after")
    return both.groupBy(GROUP).agg(F.count("*").alias("n_rows"), F.count_if(F.col("__before").eqNullSafe(F.col("after"))).alias("n_same"))


@query(
    "versioned_updates",
    f"""SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS n_rows, {sql_r4("sum(o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)")} AS total
        FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 3 > 0 GROUP BY 1, 2""",
)
def versioned_updates(t):
    """Orders committed by priority; one priority's prices raised, rows of another one dropped, each as a version; the last one read."""
    path = fresh_path(t.spark)
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    versions.commit(orders, path, ["o_orderpriority"])
    raised = lambda rows: rows.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    versions.update(t.spark, path, ["o_orderpriority"], raised)
    versions.update(t.spark, path, ["o_orderpriority"], lambda rows: rows.filter("o_orderpriority = '5-LOW' AND o_orderkey % 3 > 0"))
    rows = versions.read_version(t.spark, path).groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return rows.agg(F.count("*").alias("n_rows"), r4(F.sum("o_totalprice")).alias("total"))
