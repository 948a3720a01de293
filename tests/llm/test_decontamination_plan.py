"""Decontamination where the words are too many to broadcast, and with a rarest word that very many windows share."""

from __future__ import annotations

import random
import re

import pytest

from activation_mart.llm import decontamination


def direct(docs, items, window=10):
    """Hits and items of each document, window by window."""
    split = lambda text: re.findall(decontamination.WORD, text or "")
    fold = str.maketrans(decontamination.UPPER, decontamination.LOWER)
    out = {}
    for key, text in docs:
        words = [w.translate(fold) for w in split(text)]
        hit, found = set(), set()
        for item, passage in items:
            own = [w.translate(fold) for w in split(passage)]
            size = min(window, len(own))
            for start in range(max(1, len(own) - window + 1)) if own else ():
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[start : start + size]:
                        hit.update(range(at, at + size))
                        found.add(str(item))
        out[key] = (len(hit), sorted(found)) if hit else (None, None)
    return out


@pytest.fixture
def tables():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rare = "zebra"
    items = [(i, " ".join([*rng.choices(words, k=6), rare, *rng.choices(words, k=8)])) for i in range(60)] + [(99, "Rare"), (98, None), (97, "")]
    docs = []
    for i in range(120):
        text = rng.choices(words, k=rng.randrange(5, 60))
        if i % 3 == 0:
            text[3:3] = items[i % 60][1].upper().split()
        if i % 5 == 0:
            text += [rare] * 3
        docs.append((i, " ".join(text)))
    return [*docs, (200, None), (201, ""), (202, "a RARE one"), (None, items[0][1]), (0, docs[0][1])], items


@pytest.mark.parametrize("few", [True, False])
def test_against_all_windows(spark, monkeypatch, tables, few):
    docs, items = tables
    monkeypatch.setattr(decontamination, "WINDOWS_AT_ONCE", 7)
    if not few:
        monkeypatch.setattr(decontamination, "MOST_BROADCAST_WORDS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontamination.contamination(
            spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
        )
        if not few:
            for line in found._jdf.queryExecution().executedPlan().toString().splitlines():
                assert "Exchange" not in line or "raw#" not in line
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert "ResolvedHint" not in plan and "strategy=broadcast" not in plan
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == len(docs)
    assert {r["doc_id"]: (r["__hit"], r["__items"]) for r in rows} == direct(docs, items)
