"""Registered queries against their SQL, or against brute force, on the driver's small tables."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from activation_mart.llm import minhash, registry
from activation_mart.session import current_scratch

FOLDER = "/root/testdata/sf0.01"
TABLES = "documents pages benchmark labels".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("SELECT doc_id, text, lang FROM documents").fetchall()


def similar_pairs(sets, similarity):
    """All pairs of at least this Jaccard similarity, by an inverted index."""
    holders, shared = defaultdict(list), Counter()
    for i, own in enumerate(sets):
        for element in own:
            holders[element].append(i)
    for group in holders.values():
        shared.update(combinations(group, 2))
    return [
        (a, b) for (a, b), n in shared.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)
    ]


def roots_of(size, pairs):
    parent = list(range(size))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(size)]


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_matches_sql(spark, duck, name):
    ours = registry.queries()[name](spark, FOLDER)
    columns = sorted(ours.columns)
    theirs = duck.sql(registry.oracles()[name])
    assert columns == sorted(theirs.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    expected = theirs.query("result", f"SELECT {order} FROM result").fetchall()
    assert sorted(repr(tuple(r)) for r in ours.select(*columns).collect()) == sorted(map(repr, expected))


def test_the_entry_has_all_queries():
    assert set(registry.queries()) | {"pipeline"} <= set(driver.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near duplicates", "decontamination", "source mix", "sharding",
    ]


def test_near_duplicates_against_all_pairs(spark, documents):
    found = {r["doc_id"]: r["class_id"] for r in registry.queries()["op1_minhash_near_duplicates"](spark, FOLDER).collect()}
    ids = [key for key, _, _ in documents]
    sets = [set(minhash.shingles(text)[0].tolist()) for _, text, _ in documents]
    true = similar_pairs(sets, 0.85)
    assert len(true) > 50
    assert sum(found[ids[a]] == found[ids[b]] for a, b in true) >= 0.99 * len(true)
    loose = set(similar_pairs(sets, 0.7))
    roots = roots_of(len(ids), loose)
    place = {key: i for i, key in enumerate(ids)}
    assert all(roots[place[key]] == roots[place[of]] for key, of in found.items())


def test_substrings_against_all_windows(spark, documents):
    raws = {key: text.encode() for key, text, _ in documents}
    seen = Counter(raw[i : i + 200] for raw in raws.values() for i in range(len(raw) - 199))
    expected = {}
    for key, raw in raws.items():
        edge = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                edge[i] += 1
                edge[i + 200] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        spans = int(np.sum(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        expected[key] = (len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    rows = registry.queries()["op8_repeated_substrings"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == expected


def test_languages_held_out(spark, documents):
    rows = registry.queries()["op6_kneser_ney_language"](spark, FOLDER).collect()
    lang = {key: value for key, _, value in documents}
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_quality_keeps_clean_documents(spark, duck):
    kept = {r["doc_id"]: r["kept"] for r in registry.queries()["op4_importance_resampling"](spark, FOLDER).collect()}
    rows = duck.sql("SELECT doc_id, quality, toxic FROM labels").fetchall()
    clean = [key for key, quality, toxic in rows if quality == 1 and toxic == 0]
    toxic = [key for key, _, toxic in rows if toxic == 1]
    assert sum(kept[key] for key in clean) >= 0.97 * len(clean)
    assert sum(not kept[key] for key in toxic) >= 0.8 * len(toxic)


def test_shards(spark, documents):
    rows = registry.queries()["op7_sampled_splitters"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(key for key, _, _ in documents)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    mean, most = sum(sizes.values()) / 40, max(r["size"] for r in rows)
    assert set(sizes) <= set(range(40)) and all(abs(n - mean) <= most for n in sizes.values())
    for shard in sizes:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_pipeline(spark, documents, duck):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        docs.write.parquet(path := current_scratch(spark).path(f"test-{name.replace(' ', '-')}"))
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert set(left["decontamination"]) < set(left["near duplicates"]) < set(left["quality classifier"])
    assert len(set(left["near duplicates"].values())) == len(left["near duplicates"])
    hit = registry.queries()["op10_decontaminate"](spark, FOLDER).filter("contaminated").select("doc_id").collect()
    assert not {r["doc_id"] for r in hit} & set(left["decontamination"])
    assert set(left["near duplicates"]) - set(left["decontamination"]) == {r["doc_id"] for r in hit} & set(left["near duplicates"])
