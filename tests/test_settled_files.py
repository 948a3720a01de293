"""Settled frames leave no shuffle files behind, and go when nothing reads them any more."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from activation_mart.llm import components
from activation_mart.session import CLEANUP, discard, run_scope, settle


def _bytes(folder) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def _shuffle_files(spark) -> int:
    folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return sum(f.startswith("shuffle_") for top in folders for _, _, names in os.walk(top.getPath()) for f in names)


def test_a_settled_frame_keeps_no_shuffle(spark, tmp_path):
    before, files = spark.conf.get(CLEANUP, None), _shuffle_files(spark)

    def written(n):
        rows = spark.range(n).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
        return settle(rows, "rows").count()

    with run_scope(spark, str(tmp_path)):
        with ThreadPoolExecutor(4) as pool:
            assert list(pool.map(written, [100] * 8)) == [7] * 8
    assert spark.conf.get(CLEANUP, None) == before
    for _ in range(50):  # they are removed aside
        if (left := _shuffle_files(spark) - files) <= 8 * 2:
            break
        time.sleep(0.1)
    assert left <= 8 * 2  # of the counts


def test_discarded_files_are_gone(spark, tmp_path):
    with run_scope(spark, str(tmp_path)):
        kept, gone = settle(spark.range(1000), "kept"), settle(spark.range(100000), "gone")
        assert _bytes(tmp_path) > 300000
        discard(gone)
        assert _bytes(tmp_path) < 50000 and kept.count() == 1000


def test_components_leave_one_frame(spark, tmp_path):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with run_scope(spark, str(tmp_path)) as run:
        roots = components.components(edges)
        assert {r["root"] for r in roots.collect()} == {0} and roots.count() == 201
        assert len(os.listdir(run.folder)) == 1
