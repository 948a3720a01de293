"""Language models keep every n-gram, however many there are."""

from __future__ import annotations

import random

import numpy as np

from activation_mart.llm import language


def test_no_rare_gram_is_left_out(spark):
    rng = random.Random(8)
    text = "".join(chr(rng.randrange(0x4E00, 0x9E00)) for _ in range(210_000))
    model = language.train(spark.createDataFrame([("zh", text)], "lang string, text string"))
    keys = np.unique(language.grams(language.characters(text)))
    assert len(keys) > 200_000
    assert len(model.hashes[language.ORDER - 1]) == len(keys)
    unseen = keys ^ np.uint64(1)
    unseen = unseen[~np.isin(unseen, keys)]
    assert model.log_probabilities(keys, language.ORDER).mean() > model.log_probabilities(unseen, language.ORDER).mean() + 0.5
