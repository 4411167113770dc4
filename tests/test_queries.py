"""Every registered query beside its SQL on the smallest tables."""

import re

import pytest

from checks import fixtures

# No cell of the smallest tables reaches the usual minimums: lower ones, before the SQL is built from them, so that no
# comparison is empty against empty.
fixtures.MIN_SAMPLES, fixtures.MIN_VALUES = 6, 4

import __spark_entry__ as entry  # noqa: E402
from checks.compare import TABLES, connect, difference  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
#: A draw with a minimum of 50 samples a stratum, and cells of 40.
MAY_BE_EMPTY = {"q_subsample"}
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert difference(spark, con, SF_DIR, QUERIES[name], SQL[name], allow_empty=name in MAY_BE_EMPTY) is None
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 240


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of all rows on one sample, site, group, contig and interval."""
    import duckdb

    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    hot = {
        "customer": "CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE c_nationkey END::INTEGER AS c_nationkey, "
        "CASE WHEN c_custkey % 3 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment",
        "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey",
        "lineitem": "CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 77 ELSE l_partkey END AS l_partkey, "
        "CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey",
        "part": "CASE WHEN p_partkey % 3 = 0 THEN 77 ELSE p_partkey END AS p_partkey, "
        "CASE WHEN p_partkey % 3 = 0 THEN 'SMALL' ELSE p_type END AS p_type, "
        "CASE WHEN p_partkey % 3 = 0 THEN 7 ELSE p_size END::INTEGER AS p_size",
    }
    for table in TABLES:
        change = f"REPLACE ({hot[table]})" if table in hot else ""
        con.execute(f"COPY (SELECT * {change} FROM '{SF_DIR}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [
    "q_subsample", "q_membership", "q_membership_shuffled", "q_sample_counts", "q_group_summaries", "q_flagship",
    "q_distributions", "q_interval_summary", "q_downsample_strat", "q_downsample_uniform", "q_vcf_metrics",
])
def test_query_on_skewed_tables(spark, skewed, name):
    assert difference(spark, connect(skewed), skewed, QUERIES[name], SQL[name], allow_empty=True) is None


@pytest.mark.parametrize("name", ["q_sample_counts", "q_vcf_metrics", "q_flagship"])
def test_generated_code_stays_compilable(spark, name):
    """The JVM leaves methods above 8,000 bytecodes to the interpreter, an order of magnitude slower."""
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("name", ["q_sample_counts", "q_membership_shuffled", "q_downsample_uniform", "q_pairwise_d"])
def test_no_nested_loops(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
