from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from activation_mart.operators import (
    add_column,
    append_new,
    apply_inner,
    apply_left,
    drift,
    drift_by_column,
    duplicates,
    first_match,
    keyed_patch,
    latest_one,
    latest_with_ties,
    left_lookup,
    null_aware_anti,
    only_keys,
    preview,
    repeated_rows,
    rows_at_latest,
    set_where,
    spread_lookup,
    top_n,
    union_distinct,
    with_attempt,
    with_surrogate_key,
)


def tuples(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(row) for row in rows), key=repr)


def test_latest_with_and_without_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, 1, "e"), (3, None, "f")],
        "k int, t int, v string",
    )
    assert tuples(latest_with_ties(df, "k", "t"), "k", "v") == [(1, "a"), (1, "b"), (2, "e"), (3, "f")]
    assert tuples(latest_one(df, "k", ["t", "v"]), "k", "v") == [(1, "b"), (2, "e"), (3, "f")]


def test_attempts_over_days_without_keys_and_moments(spark):
    at = datetime(2012, 5, 1, 12)
    moments = [at, at, at - timedelta(hours=1), at - timedelta(days=3), at - timedelta(days=4), None]
    rows = [(k, t) for k in (0, 1, None) for t in moments]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    expected = [1, 1, 2, 3, 4, 5]
    for k in ("k = 0", "k = 1", "k IS NULL"):
        out = with_attempt(df, "k", "t").filter(k).orderBy("attempt").collect()
        assert [row["attempt"] for row in out] == expected
        assert [row["t"] for row in out] == moments


def test_rows_at_latest_keeps_ties_and_other_codes(spark):
    df = spark.createDataFrame(
        [(1, 5, "x"), (1, 5, "other"), (1, 6, "other"), (1, 4, "x"), (2, 3, "other"), (3, None, "x")],
        "k int, t int, code string",
    )
    out = rows_at_latest(df, "k", "t", F.col("code") == "x")
    assert tuples(out) == [(1, 5, "other"), (1, 5, "x")]


@pytest.mark.parametrize(
    "right, expected",
    [([1, None], []), ([1], [2, 2]), ([], [1, 2, 2, None]), ([9], [1, 2, 2])],
)
def test_null_aware_anti(spark, right, expected):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(k,) for k in right], "k int")
    out = [row[0] for row in null_aware_anti(left, other, "k").collect()]
    assert sorted(out, key=repr) == sorted(expected, key=repr)
    left.createOrReplaceTempView("l_keys")
    other.createOrReplaceTempView("r_keys")
    plain = spark.sql("SELECT k FROM l_keys WHERE k NOT IN (SELECT k FROM r_keys)")
    assert sorted(out, key=repr) == sorted((row[0] for row in plain.collect()), key=repr)


def test_union_distinct_is_positional(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(2, None), (3, "y")], "p int, q string")
    out = union_distinct(a, b)
    assert out.columns == ["a", "b"]
    assert tuples(out) == [(1, "x"), (2, None), (3, "y")]


def test_left_lookup_with_null_keys(spark):
    left = spark.createDataFrame([(i, i % 3 if i % 2 else None) for i in range(20)], "id int, k int")
    first = spark.createDataFrame([(0, "zero"), (1, "one")], "f int, name string")
    second = spark.createDataFrame([(1, True)], "f int, flag boolean")
    out = left_lookup(left, [first, second], "k", "f", "id")
    assert out.columns == ["id", "k", "name", "flag"]
    expected = [
        (i, k, {0: "zero", 1: "one"}.get(k), True if k == 1 else None)
        for i, k in ((i, i % 3 if i % 2 else None) for i in range(20))
    ]
    assert tuples(out) == sorted(expected, key=repr)


def test_only_keys(spark):
    accounts = spark.createDataFrame([(1,), (None,), (3,)], "k bigint")
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "f bigint, v string")
    assert tuples(only_keys(facts, accounts, "f"), "v") == [("a",), ("c",)]
    assert only_keys(facts, None, "f").count() == 3


def test_apply(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    found = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tuples(apply_inner(left, found, "k")) == [(1, "a")]
    assert tuples(apply_left(left, found, "k")) == [(1, "a"), (2, None)]


MASTER = [(1, "a", 1), (2, None, 2), (3, "c", 3)]


def test_keyed_patch_modes(spark):
    master = spark.createDataFrame(MASTER, "k int, v string, other int")
    patch = spark.createDataFrame([(1, None), (2, "B"), (9, "Z")], "k int, v string")
    out = keyed_patch(master, patch, "k", ["v"])
    assert out.columns == master.columns
    assert tuples(out) == [(1, None, 1), (2, "B", 2), (3, "c", 3)]
    filled = keyed_patch(master, patch, "k", ["v"], "fill_null")
    assert tuples(filled) == [(1, "a", 1), (2, "B", 2), (3, "c", 3)]
    with pytest.raises(ValueError):
        keyed_patch(master, patch, "k", ["v"], "merge")


def test_repeated_patch_keys_do_not_multiply_rows(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    patch = spark.createDataFrame([(1, "x", 5), (1, "y", 4), (1, "z", 4)], "k int, v string, at int")
    assert tuples(keyed_patch(master, patch, "k", ["v"]), "k", "v") == [(1, "z"), (2, "b")]
    assert tuples(keyed_patch(master, patch, "k", ["v"], order=["at"]), "k", "v") == [(1, "x"), (2, "b")]


def test_keyed_patch_scope_and_flag(spark):
    master = spark.createDataFrame(MASTER, "k int, v string, other int")
    patch = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    out = keyed_patch(master, patch, "k", ["v"], where="other = 2", flag="hit")
    assert tuples(out) == [(1, "a", 1, False), (2, "B", 2, True), (3, "c", 3, False)]


def test_append_new_is_idempotent(spark):
    master = spark.createDataFrame(MASTER, "k int, v string, other int")
    news = spark.createDataFrame([(3, "no"), (4, "yes")], "k int, v string")
    once = append_new(master, news, "k")
    assert tuples(once)[-1] == (4, "yes", None)
    assert tuples(append_new(once, news, "k")) == tuples(once)


def test_set_where_and_add_column(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert tuples(set_where(df, "v", "z", F.col("k") != 5), "v") == [("b",), ("z",)]
    added = add_column(df, "note", "string")
    assert dict(added.dtypes)["note"] == "string"
    assert tuples(added, "note") == [(None,), (None,)]


@pytest.mark.parametrize("rows, start", [(1000, 1), (7, 101), (0, 1)])
def test_surrogate_key_is_dense_and_ordered(spark, rows, start):
    df = spark.range(rows).selectExpr("(id * 37) % 1009 AS v").repartition(5)
    out = with_surrogate_key(df, "key", ["v"], start)
    assert out.columns == ["key", "v"]
    keyed = [tuple(row) for row in out.orderBy("key").collect()]
    assert [key for key, _ in keyed] == list(range(start, start + rows))
    assert [v for _, v in keyed] == sorted(v for _, v in keyed)
    assert sorted(keyed) == sorted(tuple(row) for row in out.collect())  # same when read again


def test_first_match(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, 5), (None, None)], "a int, b int")
    step = first_match([("one", "a = 1"), ("five", "b = 5")], "none")
    assert [row[0] for row in df.select(step).collect()] == ["one", "five", "five", "none"]
    assert df.select(first_match([("one", "a = 1")])).collect()[1][0] is None


def test_duplicates_and_drift(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "x")], "k int, v string")
    assert tuples(duplicates(df, ["k"])) == [(1, 2)]
    fresh = spark.createDataFrame([(2, "new"), (3, "y")], "k int, v string")
    assert tuples(drift(df, fresh, "k", ["v"])) == [(3, "x", "y")]
    assert tuples(drift(df, fresh, "k", ["v"], null_safe=True)) == [(2, None, "new"), (3, "x", "y")]


def test_previews(spark):
    df = spark.range(50)
    assert preview(df, 5).count() == 5
    assert [row[0] for row in top_n(df, 3, [F.col("id").desc()]).collect()] == [49, 48, 47]


ORDERED = [
    (None, None), (None, 5), (datetime(1969, 12, 31, 23, 59, 59, 999999), 1), (datetime(1970, 1, 1), -(2**63)),
    (datetime(1970, 1, 1), 2**63 - 1), (datetime(2012, 3, 25, 2, 30), 3), (datetime(2012, 3, 25, 2, 30), None),
    (datetime(9999, 12, 31, 23, 59, 59, 999999), 2**63 - 1), (datetime(1, 1, 1), -(2**63)),
]


def test_latest_one_alike_in_all_forms(spark):
    """Hash aggregate, late fetch and sort choose the same rows, at the ends of the types too."""
    rows = [(k, t, n, i, f"v{i}") for i, (k, (t, n)) in enumerate((k, o) for k in (1, 2, None) for o in ORDERED[: 9 if k else 4])]
    rows += [(3, None, None, 90, "v90"), (4, *ORDERED[5], 91, "v91"), (4, *ORDERED[6], 92, "v92")]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, n bigint, row int, v string")
    wide = tuples(latest_one(df, "k", ["t", "n"]), "k", "row")
    assert wide == tuples(latest_one(df, "k", ["t", "n"], row_id="row"), "k", "row")
    assert wide == tuples(latest_one(df.drop("v"), "k", ["t", "n"]), "k", "row")
    assert (3, 90) in wide and (4, 91) in wide


def test_spread_lookup(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else i % 3) for i in range(30)] + [(None, 1)], "a int, k int")
    found = tuples(spread_lookup(left, spark.createDataFrame([(1, "one")], "f int, v string"), "k", "f", "a", 4))
    assert found == sorted([(i, None, None) if i % 3 == 0 else (i, i % 3, "one" if i % 3 == 1 else None) for i in range(30)] + [(None, 1, "one")], key=repr)


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert tuples(repeated_rows(df, "k"), "v") == [("a",), ("b",)]


def test_drift_by_column(spark):
    master = spark.createDataFrame([(1, "a", 1, None), (2, "b", 2, "x"), (3, "c", 3, "y")], "k int, p int_text, q int, r string".replace("int_text", "string"))
    fresh = spark.createDataFrame(
        [(1, True, None, "A", 1, "new"), (2, True, True, None, 5, None), (4, True, True, "z", 9, "z")],
        "k int, one boolean, two boolean, p string, q int, r string",
    )
    sets = {"one": ["p", "q"], "two": ["r"]}
    assert tuples(drift_by_column(master, fresh, "k", sets)) == [(1, "one", "p", "a", "A"), (2, "one", "q", "2", "5")]
    assert tuples(drift_by_column(master, fresh, "k", sets, null_safe=True)) == [
        (1, "one", "p", "a", "A"), (2, "one", "p", "b", None), (2, "one", "q", "2", "5"), (2, "two", "r", "x", None)
    ]
