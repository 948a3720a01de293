"""Spelling variants against brute force over whole texts, and on odd rows."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from activation_mart.llm import registry, spelling

FOLDER = "/root/testdata/sf0.01"


def counted(rows):
    """Words and their counts, as the contract of the query has them."""
    runs = Counter()
    lower = {ord(a): b for a, b in zip(spelling.UPPER, spelling.LOWER)}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            runs[run] += 1
    return {w: n for w, n in runs.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Near words by shared patterns: one letter blanked out, or one letter left out."""
    blanked, shorter, near = defaultdict(set), defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            blanked[word[:i] + "*" + word[i + 1 :]].add(word)
            shorter[word[:i] + word[i + 1 :]].add(word)
    for group in blanked.values():
        for word in group:
            near[word] |= group - {word}
    for word, group in shorter.items():
        if word in words:
            near[word] |= group
            for other in group:
                near[other].add(word)
    return near


def expected(rows):
    n = counted(rows)
    near, form = neighbours(n), {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    out = set()
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n[word], len(near[word]), None if form[word] is None else n[form[word]]))
    return out


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_whole_table(spark):
    table = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    rows = registry.queries()["op13_spelling_variants"](spark, FOLDER).select(*COLUMNS).collect()
    assert len(rows) > 10_000
    assert {tuple(r) for r in rows} == expected(list(zip(table["doc_id"], table["text"])))


def chains(seed=5):
    """Words of a small alphabet, so that most have near words, with counts that form chains."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abenoé", k=rng.randrange(5, 8))) for _ in range(600)}
    return [(i, " ".join([w.upper() if i % 3 else w] * rng.choice([3, 4, 6, 8, 13, 20, 50]))) for i, w in enumerate(sorted(words))]


def test_odd_texts(spark):
    long_word = "ab" * 400
    texts = chains() + [
        (10_000, None), (10_001, ""), (10_002, "1 2 !"), (None, "houses " * 5), (None, "house " * 20), (10_003, "mouse " * 9),
        (10_003, "mouse " * 9), (10_004, f"{long_word} " * 3 + f"{long_word}c " * 7 + f"{long_word[:-1]}x " * 14), (10_005, "×÷×÷× " * 4),
        (10_007, "zzbcdef " * 3 + "zzbcdeg " * 6 + "zzbcdgg " * 12 + "zzbbdgg " * 24),
        (10_006, "ABCDEÉ abcdeÉ abcdeÉ abcdeé abcdeé abcdeé Ābcdefg Ābcdefg Ābcdefg"),
    ]
    schema = "doc_id bigint, text string, word string, n string, run int, h int, id int"
    docs = spark.createDataFrame([(k, t, "w", "n", 1, 2, 3) for k, t in texts], schema)
    rows = spelling.spelling_variants(docs).select(*COLUMNS).collect()
    assert {tuple(r) for r in rows} == expected(texts) and len(rows) == len({r["word"] for r in rows})
    assert any(r["root"] not in (r["word"], r["form"]) for r in rows)  # chains of two at least
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_hot_subtrees_are_dealt_out(spark):
    n = counted(chains(6))
    near = neighbours(n)
    vocabulary = spark.createDataFrame(list(n.items()), "word string, n bigint")
    rows = spelling.near_words(vocabulary, trunk_words=20, part_words=7, part_queries=11).collect()
    assert {r["word"]: r["n_near"] for r in rows} == {w: len(s) for w, s in near.items() if s}
    assert all((-r["best_n"], r["best"]) == min((-n[w], w) for w in near[r["word"]]) for r in rows)


def test_search_against_all_pairs():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 7))) for _ in range(300)} | {"x" * 70, "x" * 71, "x" * 69 + "y"})
    held = spelling.Words(pa.array([w.encode() for w in words], pa.binary()), pa.array([1] * len(words)))
    found = [frozenset((int(a), int(b))) for i, j in spelling.near_pairs(held, held) for a, b in zip(i, j)]
    near = neighbours(set(words))
    assert len(found) == len(set(found))
    assert set(found) == {frozenset((i, words.index(o))) for i, w in enumerate(words) for o in near[w]}
