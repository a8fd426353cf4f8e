"""Every registered query against its SQL, and the shape of the plans."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
SLOW = {"halving_search", "halving_search_boosted", "forest_fit_score", "gbt_fit_score"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# The similarity score and the page parser run in Python; models may.
# The dealt operators have tests of their own.
DEALT = {n for n in QUERIES if n == "pipeline" or n.startswith("op") and n[2].isdigit()}
PYTHON = {"model_round_trip", "assemble_vector", "html_table_rows", "partial_ratio", "nearest_value", "lastname_fuzzy", "enrich_left", "full_history", "score_table", "one_hot", "ridge_fit_score", "forest_stump_score", "boosted_stump_score"}


def check_plan(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    assert name in PYTHON or "Python" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4]), "window over one partition"


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW | DEALT])
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    check_plan(name, df)
    verdict = compare(spark, FOLDER, name, lambda *_: df, SQL.get(name), con)
    assert verdict.startswith(("ok", "rows only"))


@pytest.mark.parametrize("name", sorted(SLOW))
def test_trained_models_have_sane_metrics(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows and all(r.rmse >= r.mae >= 0 and r.r2 <= 1 for r in rows)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def test_all_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = QUERIES["scan_parquet"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    lookup = QUERIES["partition_lookup"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" in lookup.split("PartitionFilters: [")[1].split("]")[0]


def test_workers_find_the_package_from_anywhere(tmp_path):
    """A session in another folder, without the package on its workers' path."""
    code = f"""
import os, sys
sys.path.insert(0, {str(Path(entry.__file__).parent)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", e.queries()["partial_ratio"](spark, {FOLDER!r}).count() > 0, e.queries()["html_table_rows"](spark, {FOLDER!r}).count() >= 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows True True" in done.stdout, done.stderr[-2000:]


def test_the_rest_works_without_the_training_data_package(tmp_path):
    """A copy without those folders and the pipeline imports, registers the other queries and collects the other tests."""
    root = Path(entry.__file__).parent
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json")
    shutil.copytree(root, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e; print('queries', len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert f"queries {len(QUERIES) - len(DEALT)} {len(set(SQL) - DEALT)}" in done.stdout, done.stderr[-2000:]
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stdout[-2000:]
