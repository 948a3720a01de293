"""Packing against the tokenizer itself, against a single best fit, and on odd rows."""

from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from activation_mart.llm import packing, registry

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(packing.default_tokenizer())
    out.encode_special_tokens = True
    return out


def tokens(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for row in rows:
        held[row["sequence_id"]].append((row["offset"], row["length"]))
    for placed in held.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_whole_table(spark, tokenizer):
    table = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    expected = set()
    for key, text in zip(table["doc_id"], table["text"]):
        ids = tokens(tokenizer, text)
        for piece, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = np.array(ids[start : start + packing.CAPACITY], "<u4")
            expected.add((key, piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = registry.queries()["op12_best_fit_packing"](spark, FOLDER).collect()
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    sequences = check_sequences(rows, packing.CAPACITY)
    sizes = np.array([r["length"] for r in rows])
    assert sequences <= packing.best_fit(sizes, packing.CAPACITY).max() + 1


ODD = [
    None, "", "   \n", "word", "Word WORD wOrd", "a|b | || |", "it's don't we'll 'd", "ÄÖ é é 日本語  x y\u0085z \x1c\x1d q",
    "<|endoftext|> <|startoftext|>x", "tab\tand\x0bvt\x0cff\rcr", "İstanbul ΣΑΣ ß ﬁ", "1234 5.6e7 --- ... !!?", "x" * 5000, "😀👩‍👩‍👧 ‼",
    " ".join(["long"] * 5000), "word", "​ zero ﻿ width", "a" + "́" * 50 + " b",
]


def test_odd_texts(spark, tokenizer):
    schema = "doc_id bigint, text string, sequence_id string, offset string, item int, length int, ids int"
    docs = spark.createDataFrame([(i if i % 5 else None, text, "s", "o", 1, 2, 3) for i, text in enumerate(ODD)], schema)
    rows = packing.pieces(docs, capacity=64, with_ids=True).collect()
    found = sorted((r["doc_id"] or 0, r["piece"], tuple(r["ids"])) for r in rows)
    expected = []
    for i, text in enumerate(ODD):
        ids = tokens(tokenizer, text)
        expected += [(i if i % 5 else 0, p, tuple(ids[s : s + 64])) for p, s in enumerate(range(0, len(ids), 64))]
    assert found == sorted(expected)
    packed = packing.pack(packing.pieces(docs, capacity=64), 64).collect()
    assert len(packed) == len(rows)
    check_sequences(packed, 64)
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_words_leave_the_cache(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CACHED_WORDS", 10)
    words = packing.WordIds(packing.default_tokenizer())
    rng = random.Random(1)
    for _ in range(30):
        some = list({"".join(rng.choices("abc|", k=3)) for _ in range(20)})
        assert [np.frombuffer(ids, np.uint32).tolist() for ids in words.of(some)] == [tokens(tokenizer, w)[:-1] for w in some]
    assert len(words.young) <= 40


def test_best_fit():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 3000)
    bins = packing.best_fit(sizes, 100)
    filled = np.bincount(bins, sizes)
    assert filled.max() <= 100
    left: list[int] = []  # the same by search
    for size in np.sort(sizes)[::-1].tolist():
        fits = [k for k, room in enumerate(left) if room >= size]
        if fits:
            left[min(fits, key=left.__getitem__)] -= size
        else:
            left.append(100 - size)
    assert len(left) == len(filled)


@pytest.mark.parametrize("kind", ["mixed", "large", "ones", "one size"])
def test_rounds(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 300)
    monkeypatch.setattr(packing, "MEMBERS_PER_TASK", 4800)
    rng = random.Random(3)
    sizes = {
        "mixed": [min(2048, int(rng.expovariate(1 / 700)) + 1) for _ in range(5000)],
        "large": [rng.randrange(1030, 2049) for _ in range(2000)],
        "ones": [1] * 5000,
        "one size": [1100] * 1500,
    }[kind]
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "id int, length int, fill string")
    rows = packing.pack(items).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(sizes)))
    best = int(packing.best_fit(np.array(sizes), 2048).max()) + 1
    assert check_sequences(rows, 2048) <= best * 1.01 + 1


def test_items_that_cannot_be_packed(spark):
    items = spark.createDataFrame([(1, None), (2, 0), (3, 2048), (4, 5000), (5, 10), (5, 10)], "id int, length bigint")
    rows = packing.pack(items).collect()
    by_id = {r["id"]: r["sequence_id"] for r in rows}
    assert len(rows) == 6 and len(set(by_id.values())) == 5 and all(r["offset"] == 0 for r in rows if r["id"] < 5)
    assert sorted(r["offset"] for r in rows if r["id"] == 5) == [0, 10]
