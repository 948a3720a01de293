"""The whole pipeline: all stages on the driver's tables, and on odd rows, columns and tables."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from activation_mart.llm import decontamination, lines, minhash, mixing, registry, resampling, sharding
from activation_mart.llm.rows import held, released
from activation_mart.session import run_scope

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def check_shards(rows):
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_all_stages(spark, tmp_path):
    """Classifier by its query; copies by the SQL of the mix over what was left; every copy in one slot."""
    kept = {r["doc_id"] for r in registry.queries()["op4_importance_resampling"](spark, FOLDER).filter("kept").collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    with run_scope(spark, str(tmp_path)) as scope:
        result = [r.asDict() for r in corpus_pipeline.run(spark, FOLDER).collect()]
        stages = sorted(glob.glob(f"{scope.folder}/corpus-pipeline-*/*"))
        assert [os.path.basename(path)[0] for path in stages] == list("01234")
        assert all(spark.read.parquet(path).columns == COLUMNS for path in stages[:4])
        assert {r["doc_id"] for r in spark.read.parquet(stages[0]).select("doc_id").collect()} == kept
        duck = duckdb.connect()
        duck.sql(f"CREATE TABLE documents AS SELECT * FROM '{stages[2]}/*.parquet'")
    assert os.listdir(tmp_path / "activation-mart") == []
    sql = registry.oracles()["op5_mix_sources"]
    copies = {key: taken // size for key, taken, size in duck.sql(f"SELECT doc_id, taken, size FROM ({sql}) WHERE size > 0").fetchall() if taken}
    found = Counter(r["doc_id"] for r in result)
    assert {k: n for k, n in found.items() if texts[k].split()} == copies
    check_shards(result)


WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(90)}" for _ in range(n))


def write_tables(spark, folder, rows, labels, items):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, __kept int, __text string, `a.b` string, __whole int, slot int"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_odd_rows(spark, tmp_path):
    extra = (7, "t", "ab", 5, 6)
    texts = {i: prose(i, 60) for i in range(80)} | {100 + i: prose(100 + i, 40) + " vile vilest dreadful" * 4 for i in range(40)}
    texts |= {200: prose(3, 60), 201: prose(200, 20_000), 202: "leaked " + prose(900, 30) + " tail", 203: None, 204: "", 205: "   "}
    rows = [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", None, *extra) for k, t in texts.items()]
    rows += [(None, prose(300, 50), None, None, None, *extra), (5, texts[5], "en", "s2", None, *extra)]
    labels = [(i, 1, 0) for i in range(80)] + [(100 + i, 1, 1) for i in range(40)] + [(0, None, None), (None, 1, 0)]
    write_tables(spark, str(tmp_path / "in"), rows, labels, [(1, prose(900, 30)), (2, None), (3, "")])
    with run_scope(spark, str(tmp_path / "run")) as scope:
        shards = corpus_pipeline.run(spark, str(tmp_path / "in")).collect()
        (mixed,) = glob.glob(f"{scope.folder}/corpus-pipeline-*/3-*")
        out = spark.read.parquet(mixed)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "__kept", "__text", "a.b", "__whole", "slot"]
        result = [r.asDict() for r in out.collect()]
    assert Counter(r["doc_id"] for r in shards) == Counter(r["doc_id"] for r in result)
    found = {r["doc_id"] for r in result}
    assert not found & {203, 204, 205, 202} and not any(100 <= (k or 0) < 140 for k in found)
    assert len({r["text"] for r in result}) == len({(r["doc_id"], r["text"]) for r in result})
    assert len(found & set(range(80))) >= 60
    assert all(r["__kept"] == 7 and r["__text"] == "t" and r["a.b"] == "ab" and r["__whole"] == 5 for r in result)
    check_shards(shards)


def test_empty_tables(spark, tmp_path):
    write_tables(spark, str(tmp_path / "in"), [], [], [])
    with run_scope(spark, str(tmp_path / "run")):
        assert corpus_pipeline.run(spark, str(tmp_path / "in")).count() == 0


NAMES = (
    "__text", "__hit", "__items", "__doc", "__same", "__key", "__of_key", "__row", "__removed", "__size", "__copies", "__copy",
    "__source", "__none", "__weight", "__score", "__kept", "__whole", "__number", "__of", "__range", "__slice", "__part",
    "__place", "__first", "__rate", "__offset", "__target", "__first_id", "__n_first", "__shingle", "node", "key", "row", "word", "raw",
)


def test_no_name_clashes(spark):
    """Every name that an operator uses inside, as a column of the user's: nothing fails, nothing is changed."""
    texts = [(1, prose(1, 80)), (2, prose(1, 80)), (3, prose(2, 80) + "\n" + prose(3, 50)), (4, "x\n" + prose(3, 50)), (5, None), (6, "")]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in NAMES)
    docs = spark.createDataFrame([(k, t, "s", *(f"own {n}" for n in NAMES)) for k, t in texts], schema)
    items = spark.createDataFrame([(1, prose(2, 80))], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    ways = {
        "near": minhash.without_near_duplicates(docs), "clean": decontamination.decontaminated(docs, items),
        "lines": lines.dedup_lines(docs), "mix": mixing.mixed_documents(docs),
        "quality": released(resampling.resample(held(docs, "doc_id", "text"), labels), docs),
        "shards": sharding.sharded_documents(docs).select(*docs.columns),
    }
    found = {}
    for name, out in ways.items():
        assert out.columns == docs.columns, name
        found[name] = rows = out.collect()
        assert rows and all(r[n] == f"own {n}" for r in rows for n in NAMES), name
    assert {r["doc_id"] for r in found["near"]} == {1, 3, 4, 5, 6}
    assert {r["doc_id"] for r in found["clean"]} == {1, 2, 4, 5, 6}
    assert {r["doc_id"]: r["text"] for r in found["lines"]}[4] == "x"
    assert sorted(r["doc_id"] for r in found["shards"]) == [1, 2, 3, 4, 5, 6]


def test_rows_are_held_whole(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, 3)], "id int, `odd.name` string, __whole int")
    back = released(held(df, "id"), df)
    assert back.columns == df.columns and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    changed = released(held(df, "id"), df, id=F.lit(9)).collect()
    assert [r["id"] for r in changed] == [9, 9]
    alone = df.select("id")
    assert sorted(map(repr, released(held(alone, "id"), alone).collect())) == sorted(map(repr, alone.collect()))
