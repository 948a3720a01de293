"""The quality classifier's models, weights and draw against a direct computation."""

from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from activation_mart.llm import registry, resampling

FOLDER = "/root/testdata/sf0.01"


def test_ratios_have_both_signs_and_are_normalised():
    raw, target = np.array([0, 100, 100, 100, 3, 1000]), np.array([0, 50, 95, 5, 0, 520])
    ratios = resampling.log_ratios(raw, target, 0.5, 3.0)
    expected = [math.log((t + 1) / (r / 2 + 1)) for r, t in zip(raw, target)]
    sure = [abs(t - r / 2) > 3 * math.sqrt(r / 4 + 0.25) for r, t in zip(raw, target)]
    assert sure == [False, False, True, True, False, False]
    assert np.allclose(ratios, [e if s else 0.05 * e for e, s in zip(expected, sure)], rtol=1e-6)
    assert ratios[0] == ratios[1] == 0 and ratios[2] > 0.5 and ratios[3] < -2 and 0 < ratios[5] < 0.01


def test_log_odds():
    rng = np.random.default_rng(1)
    means = rng.normal(0, 0.1, 4000)
    clean = rng.random(4000) < 1 / (1 + np.exp(-(30 * means + 1)))
    slope, intercept = resampling.log_odds(means, clean)
    assert abs(slope - 30) < 3 and abs(intercept - 1) < 0.2
    slope, intercept = resampling.log_odds(np.array([0.0, 0.1, 0.9, 1.0] * 50), np.array([False, False, True, True] * 50))
    assert 0 < slope < 1e3 and abs(slope * 0.5 + intercept) < 0.5  # parted in full, yet finite


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_weights_and_draw(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    clean = {}
    for row in labels.select("doc_id", "quality", "toxic").dropna().collect():
        clean[row["doc_id"]] = clean.get(row["doc_id"], True) and row["quality"] == 1 and row["toxic"] == 0
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    raw, target = Counter(), Counter()
    for key, good in clean.items():
        found = set(resampling.features(texts[key]).tolist())
        raw.update(found)
        target.update(found if good else ())
    share = sum(clean.values()) / len(clean)
    fitted = resampling.fit(resampling.labelled_sample(docs, labels))

    def ratio(bucket, level):
        expected = raw[bucket] * share
        log = math.log((target[bucket] + 1) / (expected + 1))
        return log if abs(target[bucket] - expected) > level * math.sqrt(expected * (1 - share) + 0.25) else 0.05 * log

    found = {k: resampling.features(t).tolist() for k, t in texts.items() if t}
    rows = registry.queries()["op4_importance_resampling"](spark, FOLDER).collect()
    fits = []
    for level in resampling.LEVELS:
        known = {b: ratio(b, level) for b in raw}
        means = {k: sum(known.get(b, 0.0) for b in own) / len(own) for k, own in found.items()}
        fits.append(max(abs(fitted.slope * means[r["doc_id"]] + fitted.intercept - r["weight"]) for r in rows if r["doc_id"] in means))
    assert min(fits) < 1e-3 * max(1, abs(fitted.slope))
    noise = {r["doc_id"]: r["score"] - r["weight"] for r in rows}
    assert -3 < min(noise.values()) < 0 < max(noise.values()) < 20 and abs(np.mean(list(noise.values())) - 0.577) < 0.15
    k = sum(r["weight"] >= fitted.cut for r in rows)
    ranked = sorted(rows, key=lambda r: (-r["score"], r["doc_id"]))
    assert {r["doc_id"] for r in rows if r["kept"]} == {r["doc_id"] for r in ranked[:k]}


def test_held_out_texts(spark):
    """Texts that no label names are judged by the models of those that have one."""
    rng = random.Random(4)
    plain, foul = [f"word{i}" for i in range(400)], [f"foul{i}" for i in range(30)]
    texts = []
    for i in range(3000):
        words = rng.choices(plain, k=rng.randrange(10, 400))
        bad = i % 8 < 2
        if bad:
            for _ in range(max(2, len(words) // 12)):
                words[rng.randrange(len(words))] = rng.choice(foul)
        texts.append((i, " ".join(words), bad))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, bad boolean")
    labels = docs.filter("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"), F.col("bad").cast("int").alias("toxic"))
    rows = resampling.resample(docs, labels).filter("doc_id % 2 = 1").collect()
    clean, foul_kept = ([r["__kept"] for r in rows if r["bad"] is kind] for kind in (False, True))
    assert sum(clean) >= 0.95 * len(clean) and sum(foul_kept) <= 0.1 * len(foul_kept)
