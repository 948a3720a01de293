"""Stand-in facts hold every row of the tables they are made from."""

from __future__ import annotations

import datetime as dt

import pytest

from activation_mart import checks
from activation_mart.sources.standin import RAW_SCHEMAS, StandinTables


@pytest.mark.parametrize(
    "name, rows",
    [("src_quiz", "true"), ("src_activation_activity", "true"), ("src_refund", "l_returnflag = 'R'"), ("src_risk", "true")],
)
def test_no_fact_is_left_out(spark, name, rows):
    tables = StandinTables(spark, "/root/testdata/sf0.01")
    assert tables[name].count() == tables["lineitem"].filter(rows).count() > 0


@pytest.mark.parametrize(
    "name", ["customer", "identity_validation", "identity_validation_customer", "identity_validation_status", "account_address"]
)
def test_no_order_is_left_out(spark, name):
    tables = StandinTables(spark, "/root/testdata/sf0.01")
    assert tables[f"src_{name}"].count() == tables["orders"].count() > 0


def test_gaps_are_there_without_cuts(spark):
    tables = StandinTables(spark, "/root/testdata/sf0.01")
    keys = tables["src_customer"].select("CustomerKey")
    links = tables["src_identity_validation_customer"]
    assert 0 < links.join(keys, "CustomerKey", "left_anti").count() < links.count()
    risks = tables["src_risk"].groupBy("IdentityValidationKey").count()
    assert risks.filter("count > 1").count() > 0


def test_internal_checks_reach_the_master_of_the_look_up(spark, tmp_path):
    keys = range(1, 3001)
    rows = {
        "region": [(i, f"R{i}") for i in range(5)],
        "nation": [(i, f"N{i}", i % 5) for i in range(25)],
        "orders": [(k, k, "O", 1.0, dt.datetime(1997, 1, 1), "1-URGENT") for k in keys],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, RAW_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    found = checks.queries()["d20_internal_lookup"](spark, str(tmp_path)).collect()
    # Vendor 4, status 1, approved twice over, and no value so far.
    tagged = {
        k for k in keys
        if k % 5 == 4 and k % 2 == 1 and k % 9 <= 3 and k % 7 == 1 and k % 4 in (0, 3) and k % 101
    }
    assert {r.LastIdentityValidationKey - 1000000 for r in found if r.LastAttemptValue == "Int"} == tagged != set()
    assert len(found) == sum(k % 101 > 0 for k in keys)
    assert all(r.LastIdentityValidationKey for r in found)
