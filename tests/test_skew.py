"""One key, and one group of equal rows, holds a third of every table."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import difference, duck_tables
from leakscope.operators import copies, quantiles
from leakscope.operators.keys import number_keys, number_rows
from leakscope.plans import core
from leakscope.sources.schemas import TEST_TABLES

HOT = {
    "customer": "SELECT * FROM t",
    # A third of the claims under one policy and, by their keys, one adjuster.
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey, "
              "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey // 10 * 10 ELSE o_orderkey END AS o_orderkey) FROM t",
    # A third of the payments on one claim and vendor, a sixth of them one and the same row.
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_suppkey END AS l_suppkey, "
                "CASE WHEN l_partkey % 6 = 0 THEN 6 ELSE l_partkey END AS l_partkey, "
                "CASE WHEN l_partkey % 6 = 0 THEN 900.0 ELSE l_extendedprice END AS l_extendedprice, "
                "CASE WHEN l_partkey % 6 = 0 THEN 0.5 ELSE l_discount END AS l_discount, "
                "CASE WHEN l_partkey % 6 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber, "
                "CASE WHEN l_partkey % 6 = 0 THEN 'A' ELSE l_returnflag END AS l_returnflag, "
                "CASE WHEN l_partkey % 6 = 0 THEN 'O' ELSE l_linestatus END AS l_linestatus, "
                "CASE WHEN l_partkey % 6 = 0 THEN TIMESTAMP '2001-07-01' ELSE l_shipdate END AS l_shipdate) FROM t",
    "supplier": "SELECT * FROM t",
    # A third of the notes on one claim.
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 30 ELSE event_id END AS event_id) FROM t",
}


@pytest.fixture(scope="module")
def hot(tmp_path_factory, small):
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in TEST_TABLES:
        source = HOT[name].replace("FROM t", f"FROM read_parquet('{small}/{name}.parquet')")
        duckdb.sql(f"COPY ({source}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture
def tiny_limits(spark, monkeypatch):
    """Limits so low that the hot keys of the small tables are split."""
    monkeypatch.setattr(copies, "CHUNK", 3)
    monkeypatch.setattr(quantiles, "WIDTHS", (12, 5, 0))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NAMES = (
    "core_claims", "core_payments", "core_notes", "core_counts", "qc_rejected_rows", "clue1_severity_qoq",
    "clue2_leakage_scores", "clue3_duplicate_payments", "clue4_vendor_outliers", "clue5_adjuster_hierarchy",
    "clue6_notes_flags", "clue7_executive_rollup_ids", "mart_claim_risk_signals",
    "mart_claim_risk_signals_collapsed", "bi_leakage_flags",
)


@pytest.mark.parametrize("name", NAMES)
def test_whole_results(spark, hot, tiny_limits, name):
    assert difference(spark, duck_tables(hot), hot, name) is None


def test_hot_claim_is_split_in_the_join(spark, hot, tiny_limits):
    """Adaptive execution splits the partition of the hot claim."""
    tables = entry.Tables(spark, hot)
    payments = core.with_claim(tables.payments, tables.claims_with_id)
    payments.collect()
    assert "isSkewJoin=true" in payments._jdf.queryExecution().executedPlan().toString() or "skew=true" in (
        payments._jdf.queryExecution().executedPlan().toString())


def test_copies_are_expanded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(copies, "CHUNK", 4)
    rows = spark.createDataFrame([("a", 1), ("b", 4), ("c", 5), ("d", 13)], "k string, n bigint")
    found = copies.expand_copies(rows, "n")
    counted = {r.k: sorted(r.all) for r in found.groupBy("k").agg(F.collect_list("_copy").alias("all")).collect()}
    assert counted == {"a": [1], "b": [1, 2, 3, 4], "c": list(range(1, 6)), "d": list(range(1, 14))}


def test_numbers_are_dense_and_ordered(spark):
    rows = spark.range(0, 3000, 1, 7).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS k", "id % 2 AS v")
    rows = rows.selectExpr("nullif(k, '7') AS k", "v")
    found = number_rows(rows, ["k", "v"], "n").orderBy("n").collect()
    assert [r.n for r in found] == list(range(1, 3001))
    expected = sorted(((r.k, r.v) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.k, r.v) for r in found] == expected


def test_keys_have_dense_numbers_and_keep_them(spark):
    keys = spark.range(0, 500, 1, 5).selectExpr("concat(if(id % 2 = 0, 'CLM', 'x/'), id div 3 * 3) AS key")
    numbers, repeated = number_keys(keys.unionByName(spark.sql("SELECT CAST(NULL AS string) AS key")))
    expected = sorted({r.key for r in keys.collect()})
    assert {r.key: r.number for r in numbers.collect()} == {k: at for at, k in enumerate(expected, 1)}
    assert repeated == min(r.key for r in keys.groupBy("key").count().where("count > 1").collect())
    more = spark.createDataFrame([("CLM0",), ("A",), ("zz",)], "key string")
    again, repeated = number_keys(more, numbers)
    found = {r.key: r.number for r in again.collect()}
    assert found == {**{k: at for at, k in enumerate(expected, 1)}, "A": len(expected) + 1, "zz": len(expected) + 2}
    assert repeated is None and number_keys(more.limit(0))[0].count() == 0


@pytest.mark.parametrize("widths", [(0,), (7, 0), (30, 20, 10, 0), ()])
def test_quantiles_equal_brute_force(spark, widths):
    random = np.random.default_rng(3)
    groups = {
        "hot": random.integers(-5_000, 5_000, 2000), "same": np.full(500, 77), "one": np.array([5]),
        "two": np.array([-3, 9]), "wide": random.integers(-10**12, 10**12, 301),
    }
    rows = [(name, str(v / 100)) for name, values in groups.items() for v in map(int, values)]
    frame = spark.createDataFrame(rows, "g string, t string").selectExpr("g", "cast(t AS decimal(18,2)) AS v")
    wanted = {"low": 0.1, "q1": 0.25, "mid": 0.5, "q3": 0.75, "top": 1.0}
    frame = frame.unionByName(frame.limit(1).selectExpr("'none' AS g", "cast(NULL AS decimal(18,2)) AS v"))
    found = {r.g: r for r in quantiles.quantiles(frame, ["g"], "v", 2, wanted, widths).collect()}
    assert set(found) == set(groups)
    for name, values in groups.items():
        for column, p in wanted.items():
            assert found[name][column] == pytest.approx(np.quantile(values / 100, p), rel=1e-12, abs=1e-9)
