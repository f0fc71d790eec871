"""Stored layers, views, extracts, sampling."""

from __future__ import annotations

import csv
import glob
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import ORDERS, difference, out_of_order
from leakscope.config import FIXTURE_AS_OF as AS_OF
from leakscope.operators.sampling import one_in, random_top
from leakscope.plans import clues, core, extracts, mart
from leakscope.sources import schemas, staging, storage


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("base"))
    core.load_core(staging.StagedTables(spark, small, AS_OF), base)
    return base, storage.read_layer(spark, base, "core")


def _same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(*left.columns).collect()))


def test_load_keeps_declared_schemas_and_values(spark, small, stored):
    _, tables = stored
    for name, table in tables.items():
        month, date = schemas.MONTHS.get(name, (None, None))
        assert [f.name for f in table.schema] == schemas.CORE[name].fieldNames() + [month] * (month is not None)
        if month:
            assert table.where(~F.trunc(date, "MM").eqNullSafe(F.col(month))).count() == 0
            table = table.drop(month)
        own = {"core_payments": "payment_id", "core_notes": "note_id"}.get(name)
        if own:  # numbers of places, not of an order
            assert table.select(own).distinct().count() == table.count()
            table = table.drop(own)
        assert _same(table, entry.queries()[name](spark, small))


def test_keys_keep_their_numbers_over_loads(spark, small, tmp_path):
    staged = {name: staging.StagedTables(spark, small, AS_OF)[name] for name in schemas.STAGED}
    before = core.load_core({**staged, "staged_claims": staged["staged_claims"].where("crc32(loss_date) % 5 = 0")},
                            str(tmp_path))["core_claims"]
    old = {r.claim_number.upper(): r.claim_id for r in before.collect()}
    after = {r.claim_number.upper(): r.claim_id for r in core.load_core(staged, str(tmp_path))["core_claims"].collect()}
    assert len(after) > len(old) > 100 and len(set(after.values())) == len(after)
    assert all(after[number] == claim_id for number, claim_id in old.items() if number in after)


def test_keys_of_any_form_load(spark, tmp_path):
    """Two numbers that read alike, and one that is no number, are three claims."""
    from tests import frames

    numbers = ["CLM000012", "CLM000000012", "12/x"]
    claim = {"policy_number": "P", "adjuster_ext_id": "A", "loss_date": "2000-01-01"}
    staged = {
        "staged_policies": frames.staged(spark, "staged_policies", {"policy_number": "P"}),
        "staged_adjuster": frames.staged(spark, "staged_adjuster", {"adjuster_ext_id": "A"}),
        "staged_claims": frames.staged(spark, "staged_claims", *[{**claim, "claim_number": n} for n in numbers]),
        "staged_payments": frames.staged(spark, "staged_payments", *[
            {"claim_number": n.lower() + " ", "payment_date": "2000-02-01", "amount": str(at)}
            for at, n in enumerate([*numbers, "12"])]),
        "staged_notes": frames.staged(spark, "staged_notes", {"claim_number": "12/X", "note_text": "a"}),
    }
    tables = core.load_core(staged, str(tmp_path))
    claims = {r.claim_id: r.claim_number for r in tables["core_claims"].collect()}
    assert sorted(claims.values()) == sorted(numbers)
    paid = {claims[r.claim_id]: int(r.amount) for r in tables["core_payments"].collect()}
    assert paid == {"CLM000012": 0, "CLM000000012": 1, "12/x": 2}
    assert [claims[r.claim_id] for r in tables["core_notes"].collect()] == ["12/x"]


def test_a_load_that_dies_leaves_the_old_state(spark, small, tmp_path):
    staged, base = staging.StagedTables(spark, small, AS_OF), str(tmp_path)
    opened = core.load_core(staged, base)
    before = {name: table.count() for name, table in opened.items()}
    broken = {name: staged[name] for name in schemas.STAGED}
    broken["staged_policies"] = broken["staged_policies"].limit(20)
    broken["staged_notes"] = broken["staged_notes"].withColumn(
        "note_text", F.expr("if(note_text LIKE 'S%', raise_error('disk full'), note_text)"))
    with pytest.raises(Exception, match="disk full"):
        core.load_core(broken, base)
    assert {name: table.count() for name, table in storage.read_layer(spark, base, "core").items()} == before
    fewer = core.load_core({**broken, "staged_notes": staged["staged_notes"]}, base)
    assert fewer["core_policies"].count() == 20
    assert {name: table.count() for name, table in opened.items()} == before  # readers keep their version
    assert storage.read_layer(spark, base, "core")["core_policies"].count() == 20
    core.load_core(staged, base)
    assert len(storage.published(spark, base, "core")) == 3
    storage.drop_versions(spark, base, "core", keep=1)
    assert len(storage.published(spark, base, "core")) == 1
    assert storage.read_layer(spark, base, "core")["core_policies"].count() == before["core_policies"]


def test_a_load_writes_payments_once_and_sorts_no_rows(spark, stored):
    """No range exchange but for the distinct keys, and no written copy of the payments."""
    base, tables = stored
    staged = staging.StagedTables(spark, "/root/testdata/sf0.001", AS_OF)
    payments = core._placed(core.with_claim(core.conform_payments(staged["staged_payments"]), tables["core_claims"]), "n")
    plan = payments.where(core.is_readable())._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("transform(array(trim(payment_date") == 1  # parsed once


def test_load_can_be_repeated(spark, small, stored, tmp_path):
    staged = staging.StagedTables(spark, small, AS_OF)
    for _ in range(2):
        again = core.load_core(staged, str(tmp_path))
    assert {name: table.count() for name, table in again.items()} == {
        name: table.count() for name, table in stored[1].items()}


def test_analyses_of_stored_tables_equal_those_of_raw_tables(spark, small, stored):
    _, t = stored
    claims, policies, payments = t["core_claims"], t["core_policies"], t["core_payments"]
    analyses = {
        "clue1_severity_qoq": clues.clue1_severity_qoq(claims, policies, AS_OF),
        "clue2_reserve_flags": clues.clue2_reserve_flags(claims, payments, AS_OF),
        "clue3_duplicate_payments": clues.clue3_duplicate_payments(claims, payments),
        "clue4_vendor_outliers": clues.clue4_vendor_outliers(payments),
        "clue5_adjuster_hierarchy": clues.clue5_adjuster_hierarchy(t["core_adjuster"], claims),
        "clue6_notes_flags": clues.clue6_notes_flags(t["core_notes"], claims),
        "clue7_executive_rollup": clues.clue7_executive_rollup(policies, claims),
        "mart_claim_risk_signals": mart.mart_claim_risk_signals(claims, policies, payments, AS_OF),
    }
    for name, found in analyses.items():
        assert _same(entry.queries()[name](spark, small), found), name


def test_filters_and_columns_reach_the_stored_files(stored):
    _, t = stored
    recent = clues.leakage_scores(t["core_claims"], t["core_payments"], AS_OF)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(payment_date,2001-05-04)" in plan
    assert "ReadSchema: struct<claim_id:bigint,payment_date:date,amount:decimal(18,2)>" in plan
    trend = clues.clue1_severity_qoq(t["core_claims"], t["core_policies"], AS_OF)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(loss_date,1999-08-02)" in plan
    assert "ReadSchema: struct<policy_id:bigint,lob:string>" in plan


def test_filters_skip_whole_months(spark, stored):
    """Only folders from the first wanted month on are read, and no other filter changes."""
    base, t = stored
    for name, day in (("core_payments", date(2001, 5, 4)), ("core_claims", date(1999, 8, 2))):
        month, column = schemas.MONTHS[name]
        found = storage.from_day(t[name], column, day)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^]]*{month}#\d+ >= {day.replace(day=1)}", plan)
        assert _same(found, t[name].where(F.col(column) >= F.lit(day)))
        months = {str(r[0]) for r in t[name].select(month).distinct().collect()}
        read = {re.search(rf"{month}=([^/]+)/", f)[1] for f in found.inputFiles()}
        assert read and read <= {m if m != "None" else "__HIVE_DEFAULT_PARTITION__" for m in months}
    for plan in (clues.leakage_scores(t["core_claims"], t["core_payments"], AS_OF),
                 clues.clue1_severity_qoq(t["core_claims"], t["core_policies"], AS_OF)):
        assert "_month" in "".join(re.findall(r"PartitionFilters: \[([^]]*)\]", str(
            plan._jdf.queryExecution().executedPlan().toString())))


def test_claims_without_a_date_are_stored(spark, tmp_path):
    from tests import frames

    claims = frames.claims(spark, {"claim_id": 1, "loss_date": None}, {"claim_id": 2, "loss_date": date(1500, 2, 3)})
    version = storage.Version(spark, str(tmp_path), "core")
    found = version.write("core_claims", claims)
    assert {(r.claim_id, r.loss_date, r.loss_month) for r in found.collect()} == {
        (1, None, None), (2, date(1500, 2, 3), date(1500, 2, 1))}
    assert [r.claim_id for r in storage.from_day(found, "loss_date", date(1400, 1, 1)).collect()] == [2]


def test_staged_layer_round_trip(spark, small, tmp_path):
    tables = staging.StagedTables(spark, small, AS_OF)
    storage.write_layer(spark, tables, str(tmp_path), "staged")
    again = storage.read_layer(spark, str(tmp_path), "staged")
    assert all(_same(tables[name], again[name]) for name in tables)


def test_the_risk_view_outlives_a_load(spark, small, tmp_path):
    staged, base = {n: staging.StagedTables(spark, small, AS_OF)[n] for n in schemas.STAGED}, str(tmp_path)
    core.load_core({**staged, "staged_claims": staged["staged_claims"].where("crc32(loss_date) % 9 = 0")}, base)
    storage.register_layer(spark, base, "core")
    mart.create_risk_view(spark, AS_OF)
    other = spark.newSession()
    few = other.table("mart.claim_risk_signals_live").count()
    core.load_core(staged, base)
    storage.register_layer(spark, base, "core")
    found = other.table("mart.claim_risk_signals_live")
    assert 0 < few < found.count()
    assert _same(found, entry.queries()["mart_claim_risk_signals"](spark, small))
    assert [f.name for f in found.schema] == schemas.MART["claim_risk_signals"].fieldNames()
    mart.create_risk_view(spark)  # at the time of the read
    assert other.table("mart.claim_risk_signals_live").count() == found.count()
    for name in ("core", "mart"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_the_stored_mart_outlives_a_new_load(spark, small, tmp_path):
    staged, base = staging.StagedTables(spark, small, AS_OF), str(tmp_path)
    mart.load_mart(core.load_core(staged, base), base, AS_OF)
    core.load_core(staged, base)
    found = storage.read_layer(spark.newSession(), base, "mart")["claim_risk_signals"]
    assert _same(found, entry.queries()["mart_claim_risk_signals"](spark, small))
    assert [f.name for f in found.schema] == schemas.MART["claim_risk_signals"].fieldNames()


def test_catalog_names_follow_the_last_version(spark, stored):
    base, tables = stored
    storage.register_layer(spark, base, "core")
    for name, table in tables.items():
        found = spark.newSession().table(f"core.{name}")
        assert found.schema == table.schema and found.count() == table.count()
    spark.sql("DROP DATABASE core CASCADE")


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        storage.read_layer(spark, str(tmp_path), "core")


def _file(folder):
    (path,) = glob.glob(f"{folder}/part-*.csv")
    with open(path, "rb") as file:
        return file.read()


def test_extract_format(stored, tmp_path):
    _, tables = stored
    extracts.export_extracts(tables, AS_OF, str(tmp_path))
    expected = {
        "clue1_severity_hotspots_top5.csv": (5, "lob,loss_state,qstart,avg_severity,prev_q,qoq_change"),
        "clue2_reserve_flags_top100.csv": (
            100, "claim_id,claim_number,loss_date,status,loss_age_days,paid_total,reserve_total,total_paid_90,"
                 "leakage_score"),
        "clue4_vendor_outliers_high_top50.csv": (50, "vendor_id,amount,q1,q3"),
        "clue6_notes_flags_top50.csv": (50, "claim_id,missed_subrogation,missed_FNOL,dup_billing,incurred"),
        "claim_risk_signals_top50.csv": (
            50, "claim_number,lob,loss_state,paid_total,reserve_total,dup_hits,reserve_flag,risk_score"),
    }
    for name, (count, header) in expected.items():
        content = _file(tmp_path / name)
        assert content.startswith(b"\xef\xbb\xbf" + header.encode() + b"\r\n"), content[:200]
        assert content.endswith(b"\r\n") and content.count(b"\n") == content.count(b"\r\n") == count + 1
    top = list(csv.DictReader(io.StringIO(_file(tmp_path / "clue1_severity_hotspots_top5.csv").decode("utf-8-sig"))))
    assert all(len(row["avg_severity"].split(".")[1]) == 6 and len(row["qoq_change"].split(".")[1]) == 4 for row in top)
    high = list(csv.DictReader(io.StringIO(_file(tmp_path / "clue4_vendor_outliers_high_top50.csv").decode("utf-8-sig"))))
    assert all("E" not in row["q1"] and not row["q1"].endswith(".0") for row in high)
    risk = list(csv.DictReader(io.StringIO(_file(tmp_path / "claim_risk_signals_top50.csv").decode("utf-8-sig"))))
    assert all(float(row["risk_score"]) == int(row["dup_hits"]) + int(row["reserve_flag"]) for row in risk)


def test_samples_repeat(spark):
    rows = spark.range(20_000).withColumn("key", F.concat(F.lit("K"), "id"))
    picked = one_in(rows, ["key"], 50, seed=1)
    assert 300 < picked.count() < 500
    assert _same(picked, one_in(rows.repartition(7), ["key"], 50, seed=1))
    assert not _same(picked, one_in(rows, ["key"], 50, seed=2))
    assert _same(random_top(rows, ["key"], 9), random_top(rows.repartition(5), ["key"], 9))


def test_comparison_finds_differences(spark, duck, small, monkeypatch):
    sql = entry.oracle_sql()
    monkeypatch.setattr(entry, "oracle_sql", lambda: {"core_policies": sql["core_policies"] + " LIMIT 149"})
    assert "150 rows instead of 149" in difference(spark, duck, small, "core_policies")


@pytest.mark.parametrize("name", [
    "clue1_severity_qoq", "clue2_reserve_flags", "clue3_duplicate_payments", "clue4_vendor_outliers",
    "clue5_adjuster_hierarchy", "clue6_notes_flags", "clue7_executive_rollup"])
def test_comparison_finds_a_missing_sort(spark, small, name):
    found = entry.queries()[name](spark, small)
    assert out_of_order(found.collect(), ORDERS[name]) is None
    assert out_of_order(found.orderBy(F.xxhash64(*found.columns)).collect(), ORDERS[name]) is not None


def test_a_repeated_key_stops_the_load_before_anything_is_replaced(spark, small, tmp_path):
    staged = staging.StagedTables(spark, small, AS_OF)
    tables = {name: staged[name] for name in schemas.STAGED}
    before = core.load_core(tables, str(tmp_path))["core_policies"].count()
    again = tables["staged_policies"].limit(1).withColumn("policy_number", F.lower("policy_number"))
    with pytest.raises(ValueError, match="staged_policies.policy_number POL"):
        core.load_core({**tables, "staged_policies": tables["staged_policies"].unionByName(again)}, str(tmp_path))
    assert storage.read_layer(spark, str(tmp_path), "core")["core_policies"].count() == before


def test_a_load_leaves_no_intermediate_tables(spark, small, tmp_path):
    folder = storage.shared_folder(spark).removeprefix("file:") + "/leakscope"
    before = set(glob.glob(f"{folder}/*"))
    core.load_core(staging.StagedTables(spark, small, AS_OF), str(tmp_path))
    assert set(glob.glob(f"{folder}/*")) == before
