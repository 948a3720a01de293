"""What the physical plans must not, and must, contain once tables are too large to broadcast."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from activation_mart import checks
from activation_mart.functions import RunWindow
from activation_mart.sources import Sources
from activation_mart.operators import (
    latest_one,
    left_lookup,
    null_aware_anti,
    rows_at_latest,
    spread_lookup,
    with_attempt,
)
from activation_mart.plans.block import block_attribution
from activation_mart.plans.cards import balance_patch, card_resolution, winning_cards
from activation_mart.plans.changes import all_changes
from activation_mart.plans.online import failure_flags
from activation_mart.plans.extract import latest_signups
from activation_mart.plans.runs import assemble
from world import VERIFICATION, WINDOW, World

SCALE = "/root/testdata/sf0.001"
QUERIES = checks.queries()


@pytest.fixture
def large(spark):
    """As if no table could be broadcast by its size."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "10000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SCALE), reason="needs the driver's tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_gathers_or_crosses(large, name):
    plan = plan_of(QUERIES[name](large, SCALE))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
    # One task may gather the partial results of an aggregate without keys, one row from
    # each task (a global count, the counts of a NOT IN, whether a row exists), and a limit.
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate(keys=[], functions=[partial_" in below or (name == "l01_limit" and "Limit" in below)


@pytest.mark.skipif(not os.path.isdir(SCALE), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["d08_failures", "d11_all_failures", "d12_online_waterfall", "d20_internal_lookup"])
def test_rows_are_not_dealt_by_a_single_value(large, name):
    plan = plan_of(QUERIES[name](large, SCALE))
    for key in ("ActivationTypeKey", "IdentityValidationVendorKey", "IdentityValidationStatusTypeKey"):
        assert f"hashpartitioning({key}" not in plan


def test_window_filter_reaches_the_scan(large):
    plan = plan_of(QUERIES["p02_time_window"](large, SCALE))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_history_reads_only_its_columns(large):
    plan = plan_of(QUERIES["a01_group_max"](large, SCALE))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in plan


def test_ties_are_cut_before_the_shuffle(large):
    plan = plan_of(QUERIES["w01_latest_with_ties"](large, SCALE))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")


def test_latest_one_combines_before_the_shuffle(large):
    df = large.range(10).selectExpr("id % 2 AS k", "id AS t", "'x' AS v")
    plan = plan_of(latest_one(df, "k", ["t"]))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_rows_at_latest_spreads_by_key_and_moment(large):
    df = large.range(10).selectExpr("id % 2 AS k", "id AS t", "true AS c")
    plan = plan_of(rows_at_latest(df, "k", "t", df["c"]))
    assert "partial_max" in plan
    assert "Exchange hashpartitioning(k" in plan and "Window" not in plan


def test_lookups_share_one_shuffle_of_the_left_side(large):
    left = large.range(10).selectExpr("id", "id % 3 AS k")
    facts = [large.range(3).selectExpr("id AS f", f"id AS v{i}") for i in range(3)]
    plan = plan_of(left_lookup(left, facts, "k", "f", "id"))
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning(k") == 1
    assert "__left_spread" in plan.split("Exchange hashpartitioning(k", 1)[1].split("\n")[0]


def test_fact_aggregates_need_no_second_shuffle(large):
    w = World()
    w.failure(1, VERIFICATION)
    src = w.sources(large)
    accounts = large.range(4).selectExpr("id AS AccountKey", "nullif(id, 3) AS VCustomerkey")
    flags = failure_flags(src)
    joined = left_lookup(accounts, [flags], "VCustomerkey", "CustomerKey", "AccountKey")
    shuffles = plan_of(joined).count("Exchange") - plan_of(flags).count("Exchange")
    assert shuffles == 1  # the accounts


def test_assembly_joins_on_the_aggregates_partitioning(large):
    w = World()
    w.card(1, 1)
    w.validation(1001, 1)
    w.rating(1, "B5")
    src = w.sources(large)
    rows = assemble(latest_signups(src, WINDOW), src, RunWindow.parse("1/1/2012", "1/1/2013"))
    plan = plan_of(rows)
    # One shuffle by account each for sign-ups, checks, blocks, cards, and the balance of a second card.
    assert plan.count("Exchange hashpartitioning(AccountKey") == 5


@pytest.fixture
def tables(large, tmp_path):
    """Sources that lie in files, so that plans tell how often each is read."""
    w = World()
    w.card(1, 1)
    w.card(2, 1, 6)
    w.validation(1001, 1)
    w.rating(1, "B5")
    w.add("card_status_history", SerialNbr="S1", StartDate=WINDOW.start)
    src = w.sources(large)
    for name in w.rows:
        src[name].write.parquet(str(tmp_path / name))
    return Sources.from_parquet(large, str(tmp_path))


def scans(plan: str, table: str) -> int:
    return plan.count(f"/{table}]")


@pytest.fixture
def unsettled(monkeypatch):
    """Frames as they would be settled, in a row; plans go on from the frame itself."""
    held = []
    for module in ("operators.latest", "operators.keys", "operators.lookup", "plans.block", "plans.cards"):
        monkeypatch.setattr(f"activation_mart.{module}.settle", lambda df, label: held.append(df) or df)
    return held


def test_changes_read_customers_once(tables):
    plan = plan_of(all_changes(tables, WINDOW))
    assert scans(plan, "customer") == 1
    assert all(scans(plan, t) == 1 for t in ("identity_validation", "rating_history", "card_status_history"))
    assert "partial_bool_or" in plan.replace("partial_max(check_changed", "partial_bool_or")


def test_balances_read_customers_once(tables):
    accounts = tables.spark.range(3).selectExpr("id AS AccountKey", "1L AS PCustomerkey", "2L AS TCustomerkey")
    plan = plan_of(balance_patch(accounts, tables))
    assert scans(plan, "customer") == 1
    assert plan.count("Exchange hashpartitioning(CustomerKey") == 2  # the customers, and the accounts' cards
    assert "ReadSchema: struct<CustomerKey:bigint,CreditRatingKey:string,CurrBalance:decimal(19,4)>" in plan


def test_cards_are_chosen_by_a_hash_aggregate(tables, unsettled):
    plan = plan_of(winning_cards(tables))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert "ReadSchema: struct<CustomerKey:bigint,AccountKey:bigint,ProductKey:int,CreateDate:timestamp_ntz>" in plan
    card_resolution(tables)
    fetched = plan_of(unsettled[-1])
    assert "SortAggregate" not in fetched and "ShuffledHashJoin" in fetched
    assert scans(fetched, "customer") == 2  # the keys, then the wide columns
    # The wide side streams: nothing sorts it.
    assert "Sort [CustomerKey" not in fetched


def test_signups_are_chosen_on_keys(tables):
    plan = plan_of(latest_signups(tables, WINDOW))
    assert "SortAggregate" not in plan and scans(plan, "customer") == 1 and "partial_max_by" in plan


def test_wide_columns_are_fetched_for_winners(large, unsettled):
    df = large.range(10).selectExpr("id % 2 AS k", "id AS t", "id AS row", "repeat('x', 99) AS wide")
    plan = plan_of(latest_one(df, "k", ["t"], row_id="row"))
    assert "SortAggregate" not in plan and "LeftSemi" in plan
    assert "SortAggregate" in plan_of(latest_one(df, "k", ["t"]))


def test_attempts_read_their_rows_once(tables):
    plan = plan_of(block_attribution(tables))
    assert scans(plan, "rating_history") == scans(plan, "customer") == 0  # settled before


def test_blocks_read_each_table_once(tables, monkeypatch):
    """One scan of each until the ranks, which read the settled rows alone."""
    settled = []
    from activation_mart.session import settle

    def noted(df, label):
        settled.append((label, plan_of(df)))
        return settle(df, label)

    for module in ("operators.latest", "operators.keys", "plans.block"):
        monkeypatch.setattr(f"activation_mart.{module}.settle", noted)
    last = plan_of(block_attribution(tables))
    plans = "".join(plan for _, plan in settled) + last
    assert [label for label, _ in settled] == ["block-changes", "rows", "positions"]
    assert scans(plans, "rating_history") == scans(plans, "customer") == scans(plans, "sys_user") == 1
    assert "Window" not in settled[-1][1] and "rangepartitioning(__key" in settled[-1][1]


def test_a_hot_key_is_ranked_in_many_tasks(large):
    large.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = large.range(4000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "timestamp_ntz '2012-01-01' + make_dt_interval(0, 0, 0, id) AS t")
        out = with_attempt(df, "k", "t")
        assert "SortMergeJoin [coalesce(k#" in plan_of(out) and "coalesce(t#" in plan_of(out)
        spread = out.filter("k = 7").groupBy(F.spark_partition_id()).count()
        assert spread.count() == int(large.conf.get("spark.sql.shuffle.partitions"))
        assert out.filter("k = 7").agg(F.max("attempt"), F.count_distinct("attempt")).first() == (1335, 1335)
    finally:
        large.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_frequent_product_is_split(large):
    large.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = large.range(3000).selectExpr("id AS AccountKey", "CASE id % 3 WHEN 0 THEN 5 WHEN 1 THEN id END AS ProductKey")
        banks = large.range(10).selectExpr("id AS p", "id + 100 AS bank")
        out = spread_lookup(left, banks, "ProductKey", "p", "AccountKey")
        assert "SortMergeJoin" in plan_of(out) and "__salt" in plan_of(out)
        for rows, bank in (("ProductKey = 5", 105), ("ProductKey IS NULL", None)):
            counts = [r["count"] for r in out.filter(rows).groupBy(F.spark_partition_id()).count().collect()]
            assert len(counts) >= 6 and max(counts) < 500  # 1,000 rows in 8 tasks
            assert [r[0] for r in out.filter(rows).select("bank").distinct().collect()] == [bank]
        assert out.count() == 3000
    finally:
        large.conf.set("spark.sql.adaptive.enabled", "true")


def test_not_in_reads_the_right_side_once(large, tmp_path, monkeypatch):
    large.range(5).selectExpr("nullif(id, 9) AS k").write.parquet(str(tmp_path / "right"))
    right, left = large.read.parquet(str(tmp_path / "right")), large.range(9).selectExpr("id AS k")
    plans = []
    from activation_mart.session import settle

    monkeypatch.setattr("activation_mart.operators.lookup.settle", lambda df, label: plans.append(plan_of(df)) or settle(df, label))
    out = null_aware_anti(left, right, "k")
    assert scans("".join(plans) + plan_of(out), "right") == 1 and "LeftAnti" in plan_of(out)
    assert sorted(r[0] for r in out.collect()) == [5, 6, 7, 8]


def test_an_update_reads_customers_four_times(tables, monkeypatch):
    """For the changes, for all cards of the changed accounts, and by key for steps and balances."""
    from activation_mart.plans import run_update
    from activation_mart.session import settle

    w = World()
    w.held(1, TCustomerkey=1, PCustomerkey=2, VCustomerkey=1)
    plans = []

    def noted(df, label):
        plans.append(plan_of(df))
        return settle(df, label)

    for module in ("operators.latest", "operators.keys", "operators.lookup", "plans.block", "plans.cards", "plans.runs"):
        monkeypatch.setattr(f"activation_mart.{module}.settle", noted)
    out = run_update(tables, w.master(tables.spark), WINDOW)
    assert scans("".join(plans) + plan_of(out), "customer") == 4
    assert [r["PCurrBalance"] is not None for r in out.collect()] == [True]
