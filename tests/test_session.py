from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier
from types import SimpleNamespace

import pytest

from activation_mart.session import current_scratch, run_scope, settle, shared_folder


def session(master, setting=None, context_folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context_folder),
    )


def test_the_cluster_names_the_folder():
    assert shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///context/1")) == "hdfs:///context/1"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_settled_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS note")
    settled = settle(df, "test")
    assert settled.dtypes == df.dtypes
    assert settled.count() == 5
    assert shared_folder(spark) in settled.inputFiles()[0]


def runs(folder):
    return os.listdir(folder / "activation-mart") if (folder / "activation-mart").exists() else []


def test_a_run_owns_what_it_settles(spark, tmp_path):
    with run_scope(spark, str(tmp_path)) as run:
        settled = settle(spark.range(3).toDF("n"), "rows")
        assert settled.count() == 3 and run.folder in settled.inputFiles()[0]
        with run_scope(spark, str(tmp_path)):
            inner = settle(spark.range(2).toDF("n"), "rows")
            assert inner.count() == 2 and len(runs(tmp_path)) == 2
        assert len(runs(tmp_path)) == 1 and settled.count() == 3
    assert runs(tmp_path) == []


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    name = f"scratch_{os.getpid()}"
    with pytest.raises(RuntimeError, match="half way"):
        with run_scope(spark, str(tmp_path)) as run:
            settle(spark.range(3).toDF("n"), "rows")
            spark.range(3).write.option("path", run.path("table")).saveAsTable(name)
            run.owns_table(name)
            assert spark.table(name).count() == 3
            raise RuntimeError("half way")
    assert runs(tmp_path) == [] and not spark.catalog.tableExists(name)
    assert current_scratch(spark) is not run


def test_runs_side_by_side(spark, tmp_path):
    """The first ends, with a failure, while the second still reads what it settled."""
    settled, over = Barrier(2, timeout=120), Barrier(2, timeout=120)

    def first():
        with run_scope(spark, str(tmp_path)):
            settle(spark.range(5).toDF("n"), "rows")
            settled.wait()
            raise ValueError("first")

    def second():
        with run_scope(spark, str(tmp_path)) as run:
            mine = settle(spark.range(7).toDF("n"), "rows")
            settled.wait()
            over.wait()
            assert runs(tmp_path) == [os.path.basename(run.folder)]
            return mine.count()

    with ThreadPoolExecutor(2) as pool:
        failing, reading = pool.submit(first), pool.submit(second)
        with pytest.raises(ValueError, match="first"):
            failing.result(120)
        over.wait()
        assert reading.result(120) == 7
    assert runs(tmp_path) == []
