"""Every operator on NULLs, empty and long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from activation_mart.llm import (
    decontamination,
    language,
    lines,
    minhash,
    mixing,
    registry,
    repetition,
    resampling,
    sharding,
    substrings,
    urls,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "node bigint, key string, size string, bucket int, word string, row string, start string"
)
WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "s"]) + str(rng.randrange(50)) for _ in range(n))


LONG = prose(1, 30_000)
BASE = prose(2, 200)
NEAR = BASE.replace(BASE.split()[100], "changed", 1)
TEXTS = [
    (1, BASE), (2, BASE), (3, NEAR), (4, None), (5, ""), (6, "  \n\t "), (7, "word"), (8, "word"),
    (9, LONG), (10, prose(3, 80) + "\n" + prose(4, 40)), (11, "one line\n" + prose(4, 40) + "\n\nend"),
    (None, prose(5, 60)), (None, prose(5, 60)), (12, BASE), (12, BASE), (13, "ÄÖ é 日本語のテキスト ½ 😀"), (14, "!!! ???"),
    (15, "ab " * 400),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (key, text, None if i % 5 == 4 else ("en" if i % 2 else "de"), None if i % 4 == 3 else f"s{i % 3}", None,
         7, "k", "x", 1, "w", "r", "s")
        for i, (key, text) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(frame):
    return sorted((row["doc_id"] is not None, row["doc_id"] or 0) for row in frame.select("doc_id").collect())


EVERY = sorted((key is not None, key or 0) for key, _ in TEXTS)


def test_near_duplicates(spark, docs, none):
    found = minhash.near_duplicates(docs).collect()
    by_key = {row["key"].hex(): row for row in found}
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert len(found) == len({text for _, text in TEXTS if text is not None})
    assert by_key[digest(NEAR)]["class_id"] == by_key[digest(BASE)]["class_id"] == 1
    assert by_key[digest("word")]["class_id"] == 7
    assert by_key[digest("")]["class_id"] == 5 and by_key[digest("!!! ???")]["class_id"] == 14
    assert by_key[digest(prose(5, 60))]["class_id"] is None
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted((k is not None, k or 0) for k in (1, 4, 5, 6, 7, 9, 10, 11, None, 13, 14, 15))
    assert minhash.near_duplicates(none).count() == 0 and minhash.without_near_duplicates(none).count() == 0


def test_urls(spark):
    rows = [
        (1, None), (2, "no scheme"), (3, ""), (4, "http://EXAMPLE.org/es/1"), (5, "http://a.example.org/en/1x#f"),
        (6, "https://x.com/fr/9?q=://"), (7, "https://x.com/de/9"), (8, "ftp://h" + "/a" * 3000), (9, "http://net?x/y"),
        (9, "http://net?x/y"), (None, "http://notexample.org/es/"), (10, "http://org.example.net/x"), (11, "x://É.ORG/A"),
    ]
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in rows], "page_id bigint, url string, host string, path string")
    found = {(r["page_id"], r["host"], r["path"][:8], r["rule"]) for r in urls.judge_urls(pages).collect()}
    assert found == {
        (1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "example.org", "/es/1", "example.org/es/"),
        (5, "a.example.org", "/en/1x", "example.org/en/1"), (6, "x.com", "/fr/9", "com/fr/"),
        (7, "x.com", "/de/9", "com/de/"), (8, "h", "/a/a/a/a", None), (9, "net", "", None),
        (None, "notexample.org", "/es/", "org/"), (10, "org.example.net", "/x", None), (11, "É.org", "/A", "org/"),
    }
    assert urls.judge_urls(pages).count() == len(rows)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_templates_learn_from_rules(spark):
    rows = [(i, f"http://h.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(60)]
    rows += [(100 + i, f"http://h.com/deals/{i}") for i in range(5)] + [(200 + i, f"http://g.com/de/{i}") for i in range(9)]
    rows += [(300, "http://g.com/x/1"), (301, "http://h.com/" + "slug/1")] + [(400 + i, f"http://w.net/{c}") for i, c in enumerate("abcdefghijklmn")]
    found = {r["page_id"]: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert found[1]["template"] == "~/de/~" and found[0]["template"] == "~/fr/~"
    assert found[100]["template"] == found[301]["template"] == "~/~/~"
    assert found[300]["verdict"] == "block" and found[300]["rule"] is None
    assert found[400]["template"] == "~/*"


def test_repetition(docs, none):
    rows = repetition.repetition(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["n_words"] == 0 and by_id[4]["base_failed"] and not by_id[4]["kept"]
    assert by_id[1]["kept"] and by_id[9]["kept"]
    assert by_id[15]["n_repeat_words"] == 400 and by_id[15]["base_failed"] and by_id[15]["dup_chars_5"] == 800
    assert repetition.repetition(none).count() == 0


def test_resampling(spark, none):
    clean = [(i, prose(i, 60)) for i in range(300)]
    foul = [(1000 + i, prose(1000 + i, 40) + " dreadful vile vilest") for i in range(100)]
    labels = [(k, 1, 0) for k, _ in clean[:200]] + [(k, 1, 1) for k, _ in foul[:70]] + [(0, None, None), (5, 1, 0)]
    extra = [(2000, None), (2001, ""), (None, prose(7777, 50)), (2002, "vile"), (2002, "vile")]
    docs = spark.createDataFrame(clean + foul + extra, "doc_id bigint, text string").withColumn("weight", F.lit("w"))
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = {r["doc_id"] for r in resampling.resample(docs, frame).filter("__kept").collect()}
    assert kept >= {k for k, _ in clean} and not kept & {k for k, _ in foul}
    assert None in kept and not kept & {2000, 2001, 2002}
    assert resampling.resample(docs, frame.limit(0)).filter("__kept").count() == 405
    assert resampling.resample(docs.limit(0), frame).count() == 0
    assert sorted(resampling.resample(none, frame).columns) == sorted([*none.columns, "__weight", "__score", "__kept"])


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS)
    total = sum(r["__size"] for r in rows)
    targets = {r["source"]: r["__target"] for r in rows}
    assert abs(sum(targets.values()) - total) < 1e-6
    assert all(0 <= r["__copies"] <= 3 for r in rows)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["__copies"] for r in rows)
    again = {(r["doc_id"], r["source"], r["__size"]): r["__copies"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["source"], r["__size"]): r["__copies"] for r in rows}
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_mixing_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 40), ("big" if i % 3 else rng.choice(["a", "b", None]))) for i in range(3000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for source in ("big", "a", "b", None):
        own = [r for r in found if r["source"] == source]
        taken = sum(r["__size"] * r["__copies"] for r in own)
        assert abs(taken - own[0]["__target"]) <= 0.02 * own[0]["__target"]
        assert own[0]["__target"] <= 3 * own[0]["__source_size"]


def test_language(spark, docs, none):
    rows = language.language_id(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 for k in (4, 5, 6, 14))
    assert by_id[1]["lang_pred"] in ("en", "de")
    assert language.language_id(none).count() == 0
    unlabelled = language.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_kneser_ney_matches_direct_computation(spark):
    texts = ["banana bandana", "cabana band", "nab a ban"]
    model = language.train(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    order = language.ORDER
    grams = Counter()
    for text in texts:
        codes = language.characters(text)
        padded = " " * (order - 2) + "".join(map(chr, codes))
        grams.update(padded[i : i + order] for i in range(len(codes) - 1))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    alphabet = len(levels[1]) + 1

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / alphabet
        counts = levels[n]
        n1, n2 = (sum(1 for c in counts.values() if c == k) for k in (1, 2))
        d = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 + 2 * n2 else 0.5
        own = {g: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        lower = p(gram[1:])
        if not total:
            return lower
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * lower

    def packed(gram):
        out = 0
        for c in gram:
            out = out << language.BITS | ord(c)
        return out

    probes = [*list(grams)[:15], "zana", "bazn", "  qx", "nanz"]
    keys = np.array([packed(g) for g in probes], np.uint64)
    assert model.languages == ["x"]
    ours = np.exp(model.log_probabilities(keys, order)[:, 0])
    assert np.allclose(ours, [p(g) for g in probes], rtol=1e-3)


def test_sharding(spark, docs, none):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == len(TEXTS)
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["size"] == 16 and by_id[9]["size"] == len(LONG) + 16
    assert by_id[1]["text_crc32"] == zlib.crc32(BASE.encode())
    assert sharding.shard_documents(none).count() == 0


def test_shards_are_near_equal_with_one_hot_text(spark):
    rng = random.Random(9)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else prose(i, rng.randrange(5, 60))) for i in range(6000)]
    found = pd.DataFrame(
        sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(),
        columns=["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    )
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 40 and sizes.max() - sizes.min() <= 2 * found["size"].max()
    again = sharding.shard_documents(spark.createDataFrame(rows[::-1], "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == set(zip(found["doc_id"], found["shard"], found["slot"]))


def test_substrings(docs, none):
    rows = substrings.without_repeats(docs).collect()
    assert len(rows) == len(TEXTS)
    expected = brute_substrings([(k, t) for k, t in TEXTS], substrings.LENGTH)
    assert sorted((r["doc_id"] or -1, bytes(r["left"])) for r in rows) == sorted((k or -1, left) for k, left in expected)
    assert substrings.without_repeats(none).count() == 0


def brute_substrings(rows, length):
    raws = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(raw[i : i + length] for _, raw in raws for i in range(len(raw) - length + 1))
    out = []
    for key, raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((key, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("most", [1, substrings.MOST_GROUP_BYTES])
def test_substrings_of_many_kinds(spark, monkeypatch, most):
    """Also where every seed is over the bound, so that its windows are counted one by one."""
    monkeypatch.setattr(substrings, "MOST_GROUP_BYTES", most)
    rng = random.Random(4)
    passage = prose(50, 60)
    rows = []
    for i in range(40):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        rows.append((i, prose(100 + i, rng.randrange(0, 30)) + passage[a:b] + "xy" * rng.randrange(150) + prose(200 + i, 5)))
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], bytes(r["left"])) for r in found) == sorted(brute_substrings(rows, substrings.LENGTH))


def test_transform_matches_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        length, letters = rng.choice([8, 9, 12, 20]), rng.choice([b"ab", b"abcd", bytes(range(256))])
        base = bytes(rng.choice(letters) for _ in range(60))
        strings = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randint(0, 50)
            strings.append(base[at : at + rng.randint(0, 50)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))))
        weights = np.array([rng.choice([1, 1, 2]) for _ in strings])
        seen = Counter()
        for string, weight in zip(strings, weights):
            for i in range(len(string) - length + 1):
                seen[string[i : i + length]] += weight
        expected = [[seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        assert [m.tolist() for m in substrings.repeated_starts(strings, weights, length)] == expected


def test_lines(spark, docs, none):
    by_id = {}
    for r in lines.repeated_lines(docs.withColumn("row", lines.row_key(F.col("doc_id"), F.col("text")))).collect():
        by_id.setdefault(r["doc_id"], []).append((r["pos"], r["removed"]))
    assert 4 not in by_id and 5 not in by_id and 6 not in by_id
    assert by_id[1] == [(0, False)] and by_id[2] == [(0, True)] and by_id[3] == [(0, True)]
    assert sorted(by_id[10]) == [(0, False), (1, False)] and sorted(by_id[11]) == [(0, False), (1, True), (3, False)]
    clean = lines.dedup_lines(docs)
    assert clean.columns == docs.columns and clean.count() == len(TEXTS)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert left[11] == "one line\n\nend" and left[2] == "" and left[4] is None and left[6] == TEXTS[5][1]
    assert lines.dedup_lines(none).count() == 0


def test_decontamination(spark, docs, none):
    item = " ".join(BASE.split()[20:35])
    items = [(1, item), (2, "Word!"), (3, None), (4, ""), (5, "never seen anywhere"), (None, item), (6, "日本語のテキスト")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("text2", F.lit("x"))
    rows = decontamination.contamination(docs, benchmark).collect()
    assert len(rows) == len(TEXTS)
    hits = {r["doc_id"]: (r["__hit"], r["__items"]) for r in rows}
    assert hits[1] == hits[2] == hits[12] == (len(re.findall("[a-z0-9]+", item)), ["1"])
    assert hits[7] == (1, ["2"]) and hits[13] == (1, ["6"])
    assert hits[4][0] is None and hits[9][0] is None
    clean = decontamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert ids(clean) == [x for x in EVERY if x[1] not in (1, 2, 3, 7, 8, 12, 13)]
    assert decontamination.decontaminated(none, benchmark).count() == 0
    assert decontamination.decontaminated(docs, benchmark.limit(0)).count() == len(TEXTS)


def test_every_number_has_a_query():
    names = registry.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert set(registry.oracles()) <= set(names)
