"""The three scheduled jobs, one after the other, over tables on disk."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import datetime

import pytest
from world import DAY, ONLINE_PERSO, RETAIL_TEMP, VERIFICATION, World, by_account

from activation_mart.__main__ import REPORTS, arguments, run
from activation_mart.functions import RunWindow
from activation_mart.plans import backfill, build_initial
from activation_mart.session import run_scope
from activation_mart.sources import MasterStore, Sources

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_initial_add_update(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("activation_mart.__main__.named_folder", lambda _: None)
    w = World()
    w.card(10, 1, CreateDate=datetime(2012, 5, 1))
    w.failure(10, VERIFICATION)
    w.card(20, 2, RETAIL_TEMP, CreateDate=DAY)
    w.validation(1002, 20, on=DAY)
    w.card(30, 3, RETAIL_TEMP, CreateDate=datetime(2012, 5, 2), Email="qa@issuer.example")
    w.validation(1001, 10, on=datetime(2012, 12, 24))
    src = w.sources(spark)
    for name in w.rows:
        src[name].write.parquet(str(tmp_path / "src" / name))

    def job(name, start, end, *more):
        options = ["--sources", str(tmp_path / "src"), "--master", str(tmp_path / "master"),
                   "--house-email", "%@ISSUER.example"]
        return run(spark, arguments([name, *options, "--start", start, "--end", end, *more]))

    store = MasterStore(spark, str(tmp_path / "master"))
    assert job("initial", "1/1/2012", "9/1/2012", "--block-end", "10/1/2012") == 1
    first = by_account(store.read())
    assert set(first) == {1}
    assert first[1]["Tablekey"] == 1
    assert first[1]["Activation_step"] == "Ident_Verify"
    assert job("daily-add", "12/1/2012", "1/1/2013") == 2
    second = by_account(store.read())
    assert set(second) == {1, 2}
    assert (second[2]["Tablekey"], second[2]["Activation_step"]) == (2, "Ident_Verify")
    assert job("daily-update", "12/23/2012", "12/26/2012") == 3
    assert set(by_account(store.read())) == {1, 2}
    assert os.listdir(tmp_path / "master" / "scratch" / "activation-mart") == []


@pytest.fixture
def built(spark, tmp_path):
    """Sources in files, a first master over them, and a way to run a job."""
    w = World()
    w.card(10, 1, CreateDate=datetime(2012, 5, 1))
    w.card(11, 1, ONLINE_PERSO, CreateDate=datetime(2012, 5, 1), CreditRatingKey="N1")
    w.failure(10, VERIFICATION)
    w.card(20, 2, RETAIL_TEMP, CreateDate=datetime(2012, 5, 2))
    w.validation(1001, 20, on=datetime(2012, 5, 3))
    w.quiz(1001, "refer")
    w.card(30, 3, RETAIL_TEMP, CreateDate=datetime(2012, 5, 2), CardActivationDate=DAY)
    w.validation(1003, 30, "Approved", None, on=datetime(2012, 5, 3))
    w.add("identity_validation_status", IdentityValidationKey=1003,
          IdentityValidationVendorKey=4, IdentityValidationStatusTypeKey=1)
    src = w.sources(spark)
    for name in w.rows:
        src[name].write.parquet(str(tmp_path / "src" / name))
    store = MasterStore(spark, str(tmp_path / "master"))

    def job(*words, places=("--sources", str(tmp_path / "src"))):
        return run(spark, arguments([*words, *places, "--master", str(tmp_path / "master")]))

    window = ["--start", "1/1/2012", "--end", "1/1/2013"]
    with run_scope(spark, str(tmp_path / "first")):
        store.write(build_initial(src, RunWindow.parse(*window[1::2])))
    return job, store, window


def test_single_backfills_make_the_whole(spark, built, tmp_path):
    job, store, window = built
    assert {r["Activation_step"] for r in by_account(store.read()).values()} == {None}
    assert job("backfill-online", *window) == 2
    steps = {k: r["Activation_step"] for k, r in by_account(store.read()).items()}
    assert steps == {1: "Neg_Match", 2: None, 3: None}
    assert job("backfill-retail") == 3
    steps = {k: r["Activation_step"] for k, r in by_account(store.read()).items()}
    assert steps == {1: "Neg_Match", 2: "OOW", 3: "Approved"}
    assert job("backfill-quiz") == 4 and by_account(store.read())[2]["OOW"] == "refer"
    assert job("tag-internal") == 5 and by_account(store.read())[3]["LastAttemptValue"] == "Int"
    assert job("refresh-bank") == 6
    single = by_account(store.read())
    again = MasterStore(spark, str(tmp_path / "other"))
    with run_scope(spark, str(tmp_path / "first")):
        src = Sources.from_parquet(spark, str(tmp_path / "src"))
        whole = RunWindow.parse(*window[1::2])
        again.write(backfill(build_initial(src, whole), src, whole))
    assert single == by_account(again.read())


def test_reports(spark, built, tmp_path):
    job, store, window = built
    job("backfill-online", *window)
    held = store.read()
    store.write(held.unionByName(held.filter("AccountKey = 1")))  # an account twice
    ways = {
        "failures": ["--bank", "1", *window], "failed-then-approved": [], "unresolved": [], "steps": [], "exceptions": [],
        "duplicates": [], "duplicate-rows": [], "duplicate-cards": [], "drift": window, "bank-changes": [],
    }
    assert set(ways) == set(REPORTS)
    found = {}
    for name, more in ways.items():
        assert job("report", name, *more, "--out", str(tmp_path / name)) == 3
        found[name] = [r.asDict() for r in spark.read.parquet(str(tmp_path / name)).collect()]
    assert sorted(r["CustomerKey"] for r in found["duplicates"]) == [10, 11]
    assert len(found["duplicate-rows"]) == 2 and [r["PCustomerkey"] for r in found["duplicate-cards"]] == [11]
    assert sum(r["cnt"] for r in found["steps"]) == 4 and found["exceptions"] == []
    assert {(r["AccountKey"], r["newbankkey"]) for r in found["bank-changes"]} == {(1, 1)}  # that of the card verified
    assert store.version() == 3
    job("report", "steps", "--out", str(tmp_path / "csv"), "--format", "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["Channel", "Activation_step", "cnt"]


def test_sources_from_the_catalog(spark, built, tmp_path):
    job, store, window = built
    spark.sql("CREATE DATABASE IF NOT EXISTS ops_test")
    try:
        src = Sources.from_parquet(spark, str(tmp_path / "src"))
        src["customer"].filter("CustomerKey < 30").write.mode("overwrite").saveAsTable("ops_test.customers")
        places = ("--sources", str(tmp_path / "src"), "--table", "customer=ops_test.customers")
        job("report", "duplicates", "--out", str(tmp_path / "none"), places=places)
        assert job("initial", *window, places=places) == 2
        assert set(by_account(store.read())) == {1, 2}
    finally:
        spark.sql("DROP DATABASE ops_test CASCADE")


@pytest.mark.parametrize(
    "words",
    [["daily-add"], ["report", "--sources", "s"], ["report", "steps", "--sources", "s"], ["initial", "--sources", "s"],
     ["refresh-bank", "--table", "nothing"], ["refresh-bank", "--table", "nothing=t"]],
)
def test_wrong_words(words, capsys):
    with pytest.raises(SystemExit):
        arguments([*words, "--master", "m"])
    assert "usage" in capsys.readouterr().err


def test_starts_where_no_folder_is_set(spark, tmp_path):
    """A process of its own, without this machine's Spark settings."""
    w = World()
    w.card(10, 1, CreateDate=datetime(2012, 5, 1))
    src = w.sources(spark)
    for name in w.rows:
        src[name].write.parquet(str(tmp_path / "src" / name))
    (tmp_path / "conf").mkdir()
    env = os.environ | {
        "SPARK_CONF_DIR": str(tmp_path / "conf"),
        "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell",
    }
    command = [sys.executable, "-m", "activation_mart", "initial", "--sources", str(tmp_path / "src"),
               "--master", str(tmp_path / "master"), "--start", "1/1/2012", "--end", "9/1/2012"]
    done = subprocess.run(command, env=env, cwd=REPO, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "initial: master version 1" in done.stdout
    assert by_account(MasterStore(spark, str(tmp_path / "master")).read())[1]["Tablekey"] == 1
    assert os.listdir(tmp_path / "master" / "scratch" / "activation-mart") == []
