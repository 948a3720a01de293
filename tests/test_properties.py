"""Properties of the jobs, on the stand-in tables and on skewed rows."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from world import DAY, RETAIL_TEMP, VERIFICATION, WINDOW, World, by_account

from activation_mart import config
from activation_mart.functions import RunWindow
from activation_mart.operators import latest_one, latest_with_ties, rows_at_latest, with_attempt
from activation_mart.plans import run_add, run_update
from activation_mart.plans.checks import quiz_facts
from activation_mart.plans.online import failure_facts, failure_flags, online_steps
from activation_mart.plans.retail import (
    TRACKER,
    retail_candidates,
    retail_quiz_override,
    retail_steps,
    retail_waterfall,
)
from activation_mart.sources.standin import ADD_WINDOW, CONFIG, UPDATE_WINDOW, StandinTables

SCALE = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SCALE), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def tables(spark):
    return StandinTables(spark, SCALE)


@needs_data
def test_runs_keep_one_row_per_account(tables):
    added = run_add(tables.sources, tables.master, ADD_WINDOW, CONFIG)
    assert set(by_account(added)) > set(by_account(tables.master))
    updated = run_update(tables.sources, tables.master, UPDATE_WINDOW, CONFIG)
    assert set(by_account(updated)) == set(by_account(tables.master))


@needs_data
def test_split_windows_add_the_same_accounts(tables):
    src, master = tables.sources, tables.master
    middle = datetime(1999, 3, 1)
    once = run_add(src, master, ADD_WINDOW, CONFIG)
    first = run_add(src, master, RunWindow(ADD_WINDOW.start, middle), CONFIG)
    second = run_add(src, first, RunWindow(middle, ADD_WINDOW.end), CONFIG)
    assert set(by_account(once)) == set(by_account(second))


@needs_data
def test_online_ladder_is_total_and_reaches_every_rung(tables):
    online = tables.master.filter("Channel = 'Online'")
    steps = by_account(online_steps(online, tables.sources))
    assert set(steps) == set(by_account(online))
    assert {row["Activation_step"] for row in steps.values()} == {
        "Approved", "Ident_Verify", "Addr_Verify", "Card_Limit", "OOW", "Neg_Match", "Incomplete",
    }


@needs_data
def test_retail_steps_are_the_smallest_rung_of_the_rows(tables):
    retail = tables.master.filter("Channel = 'Retail'")
    rows = retail_quiz_override(
        retail_waterfall(retail_candidates(retail, tables.sources)), tables.sources
    ).select("AccountKey", TRACKER).collect()
    order = ["Missing_Info", "Incomplete", "Approved", "Neg_Match", "Card_Limit", "Ident_Verify", "OOW"]
    smallest = {}
    for account, step in rows:
        best = smallest.get(account)
        if best is None or (step and order.index(step) < order.index(best)):
            smallest[account] = step
    steps = {k: row["Activation_step"] for k, row in by_account(retail_steps(retail, tables.sources)).items()}
    assert steps == smallest
    # A row that is incomplete always lacks information first.
    assert set(steps.values()) == set(order) - {"Incomplete"} | {None}


@needs_data
def test_row_order_does_not_matter(spark, tables):
    names = ("customer", "refund", "quiz", "identity_validation", "rating_history")
    from activation_mart.sources import Sources

    frames = {n: tables.sources[n] for n in config.SOURCE_SCHEMAS}
    shuffled = {n: f.orderBy(F.rand(7)) if n in names else f for n, f in frames.items()}
    runs = [
        by_account(run_update(Sources.from_frames(spark, s), tables.master, UPDATE_WINDOW, CONFIG))
        for s in (frames, shuffled)
    ]
    assert runs[0] == runs[1]


@needs_data
def test_surrogate_numbers_go_on(spark, tables):
    numbered = tables.master.withColumn("Tablekey", F.monotonically_increasing_id())
    last = numbered.agg(F.max("Tablekey")).first()[0]
    out = run_add(tables.sources, numbered, ADD_WINDOW, CONFIG)
    news = sorted(r[0] for r in out.select("Tablekey").collect() if r[0] > last)
    assert news == list(range(last + 1, last + 1 + len(news))) and news


# --- One key holding most rows -------------------------------------------------


def hot(spark, rows=30_000):
    """Key 0 holds two thirds of the rows."""
    return spark.range(rows).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 0 ELSE id END AS k", "id % 1000 AS t", "id AS v",
        "id % 5 = 0 AS blocking",
    )


def test_hot_key_latest(spark):
    rows = [tuple(r) for r in hot(spark).collect()]
    latest = {}
    for k, t, v, _ in rows:
        latest[k] = max(latest.get(k, (-1, -1)), (t, v))
    one = {r["k"]: (r["t"], r["v"]) for r in latest_one(hot(spark), "k", ["t", "v"]).collect()}
    assert one == latest
    ties = {(r["k"], r["v"]) for r in latest_with_ties(hot(spark), "k", "t").collect()}
    assert ties == {(k, v) for k, t, v, _ in rows if t == latest[k][0]}


def test_hot_key_rows_at_latest(spark):
    rows = [tuple(r) for r in hot(spark).collect()]
    latest = {}
    for k, t, _, blocking in rows:
        if blocking:
            latest[k] = max(latest.get(k, -1), t)
    out = {r["v"] for r in rows_at_latest(hot(spark), "k", "t", F.col("blocking")).collect()}
    assert out == {v for k, t, v, _ in rows if latest.get(k) == t}


def test_hot_customer_becomes_one_row_of_flags(spark):
    w = World()
    w.card(10, 1)
    w.validation(1001, 10)
    for _ in range(500):
        w.failure(10, VERIFICATION)
        w.quiz(1001, "accept")
    src = w.sources(spark)
    assert failure_flags(src).count() == 1
    assert quiz_facts(src).count() == 1
    w.held(1, VCustomerkey=10, LastIdentityValidationKey=1001, VerificationStatusType="Declined")
    assert by_account(online_steps(w.master(spark), src))[1]["Activation_step"] == "Ident_Verify"


@pytest.fixture
def small_splits(spark):
    """Adaptive skew join thresholds low enough for a few thousand rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512B",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def hot_world():
    w = World()
    for i in range(1, 60):
        w.card(i, i, RETAIL_TEMP if i % 2 else 1)
        w.held(i, VCustomerkey=i, Channel="Retail" if i % 2 else "Online")
        w.refund(i, i)
        w.failure(i, VERIFICATION)
    for i in range(4000):
        w.add("refund", CustomerKey=3, refundreasonkey=i, comment=f"refund {i * 7919}")
        w.failure(2, VERIFICATION, on=DAY + timedelta(days=i * 7919 % 90_000))
    return w


def final_plan(df):
    execution = df._jdf.queryExecution()
    rows = len(df.collect())
    return rows, execution.executedPlan().toString()


def test_hot_refunds_are_split(small_splits):
    w = hot_world()
    retail = w.master(small_splits).filter("Channel = 'Retail'")
    rows, plan = final_plan(retail_candidates(retail, w.sources(small_splits)))
    assert rows == 30 + 4000
    assert "skew=true" in plan


def test_hot_activities_are_split(small_splits):
    w = hot_world()
    online = w.master(small_splits).filter("Channel = 'Online'")
    facts = failure_facts(online, w.sources(small_splits))
    rows, plan = final_plan(facts)
    assert rows == 29 + 4000
    assert "skew=true" in plan


def test_runs_do_not_depend_on_broadcasts(spark):
    w = World()
    for i in range(1, 30):
        w.card(i, i, RETAIL_TEMP, CreateDate=DAY + timedelta(hours=i))
        w.validation(1000 + i, i, "Declined" if i % 2 else None)
        w.refund(i, 8 if i % 5 == 0 else None)
    src, master = w.sources(spark), w.master(spark)
    few = by_account(run_add(src, master, WINDOW))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert by_account(run_add(src, master, WINDOW)) == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(few) == 29


def test_a_hot_key_of_one_moment_is_split(small_splits):
    rows = [(1, DAY, f"row {i * 7919}") for i in range(5000)] + [(i, DAY + timedelta(hours=i % 5), "x") for i in range(2, 300)]
    df = small_splits.createDataFrame(rows, "k int, t timestamp_ntz, v string").repartition(4)
    found = with_attempt(df, "k", "t")
    rows, plan = final_plan(found)
    assert rows == 5000 + 298
    assert "skew=true" in plan


def test_an_update_returns_rows_without_a_key(spark):
    w = World()
    w.card(1, 1, RETAIL_TEMP)
    w.held(1, VCustomerkey=1)
    master = w.master(spark)
    keyless = master.withColumn("AccountKey", F.lit(None).cast(master.schema["AccountKey"].dataType))
    out = run_update(w.sources(spark), master.unionByName(keyless), WINDOW)
    assert sorted(str(row["AccountKey"]) for row in out.collect()) == ["1", "None"]
