from __future__ import annotations

import pytest

from activation_mart.sources import MasterStore, Sources, activity_type_order


def test_versions(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "master"))
    assert store.version() == 0
    with pytest.raises(ValueError):
        store.read()
    store.write(spark.range(3).withColumnRenamed("id", "AccountKey"))
    store.write(store.read().unionByName(store.read()))  # a run reads the version it follows
    assert store.version() == 2
    assert store.read().count() == 6


def test_failed_run_leaves_the_version_in_force(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "master"))
    store.write(spark.range(3).withColumnRenamed("id", "AccountKey"))
    with pytest.raises(Exception):
        store.write(spark.range(3).selectExpr("raise_error('lost') AS AccountKey"))
    assert store.version() == 1
    assert store.read().count() == 3
    assert store.write(spark.range(4).withColumnRenamed("id", "AccountKey")) == 2


def test_bucketed_master_joins_without_exchange(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "master"), buckets=4, table="test_master")
    store.write(spark.range(1000).selectExpr("id AS AccountKey", "id % 7 AS v"))
    held = store.read()
    assert held.count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = held.join(store.read().groupBy("AccountKey").count(), "AccountKey")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text


def test_sources(spark, tmp_path):
    spark.range(2).selectExpr("CAST(id AS INT) AS BankKey", "'x' AS BankName").write.parquet(
        str(tmp_path / "bank")
    )
    spark.range(2).write.parquet(str(tmp_path / "product"))
    src = Sources.from_parquet(spark, str(tmp_path))
    assert src["bank"].count() == 2
    with pytest.raises(ValueError, match="lacks columns"):
        src.get("product")
    with pytest.raises(KeyError):
        src.get("nothing")


def test_activity_type_order(spark):
    rows = activity_type_order(spark).collect()
    assert [row["id"] for row in rows] == list(range(1, 9))
    assert rows[-1]["ActivationActivityTypeKey"] == 10000
    assert rows[-1]["ActicationActivityOrder"] == 9
