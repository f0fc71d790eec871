"""Work that is done once: code short enough to be compiled, no filter that cleans a second time, tables read once."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from leakscope.plans import core, quality
from leakscope.sources import staging
from leakscope.sources.schemas import TEST_TABLES

DAY = datetime(2001, 3, 4)
ROWS = {
    # The first policy number is there twice.
    "customer": [(1, "a"), (1, "b"), (2, "c")],
    "supplier": [(0, "s"), (1, "t")],
    "orders": [(key, key % 2 + 1, "O", 120.0 + key, DAY) for key in range(60)],
    "lineitem": [(key % 70, key, 1, key % 7, 90.5 + key, 0.5, "A", "O", DAY) for key in range(300)],
    "events": [(key, DAY, key, kind) for key, kind in enumerate(("signup", "error", "click", "view") * 20)],
}


@pytest.fixture(scope="module")
def own(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("own"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, TEST_TABLES[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", staging.StagedTables.NAMES)
def test_stage_code_can_be_compiled(spark, own, name):
    """The JVM never compiles a method of over 8000 bytes."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        stages = staging.StagedTables(spark, own)[name]._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert stages.size() and all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))


def test_payments_are_cleaned_once(spark, own):
    """Neither the check of parsed values nor the join's check of keys goes below the dealing of rows."""
    cleaned = core.conform_payments(staging.StagedTables(spark, own)["staged_payments"])
    known = core.with_claim(cleaned.where(core.is_readable()), spark.range(3).selectExpr("id claim_id", "string(id) claim_key"))
    plain, joined = (str(df._jdf.queryExecution().optimizedPlan().toString()) for df in (cleaned, known))
    assert joined.count("gettimestamp") == plain.count("gettimestamp") > 0
    assert "Filter" in joined and "Filter" not in joined.split("RebalancePartitions")[1].split("Range")[0]


def test_constraints_read_tables_once(spark, own):
    checks = entry.queries()["qc_constraints"](spark, own)
    raw = {file.split("/")[-2] for file in checks.inputFiles() if f"{own}/" in file}
    assert raw == {"lineitem.parquet"}
    found = {row.check: row.cnt for row in checks.collect()}
    assert len(found) == 14
    assert {name: cnt for name, cnt in found.items() if cnt} == {"unique_policy_number": 1, "unique_policy_id": 1} | {
        name: cnt for name, cnt in found.items() if name in ("unique_claim_number", "unique_claim_id")}
    plain = quality.qc_constraints(core.build_core(staging.StagedTables(spark, own), numbered=False))
    assert found == {row.check: row.cnt for row in plain.collect()}


def test_orphans_are_counted_by_row(spark, own):
    """Three payments of one unknown claim are three violations, though they are matched as one value."""
    built = core.build_core(staging.StagedTables(spark, own), numbered=False)
    strays = built["core_payments"].limit(1).withColumn("claim_id", F.lit(99_999).cast("bigint"))
    built["core_payments"] = built["core_payments"].unionByName(strays.unionByName(strays).unionByName(strays))
    found = {row.check: row.cnt for row in quality.qc_constraints(built).collect()}
    assert found["payment_claim_reference"] == 3
