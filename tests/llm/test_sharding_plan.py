"""Plans of the shards: some hundred boundaries in each branch filled the driver's memory."""

from __future__ import annotations

from pyspark.sql import functions as F

from activation_mart.llm import sharding


def test_boundaries_stand_in_one_plan(spark, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 9).alias("text"))
    settle, plans = sharding.settle, []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, label)

    monkeypatch.setattr(sharding, "settle", watched)
    rows = sharding.shard_documents(docs)
    plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
    assert ["CASE WHEN (__key" in plan for plan in plans].count(True) == 1
    assert rows.count() == 3000
