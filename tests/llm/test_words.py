"""The expression of words: the contract's words, and no ranges, which are slow."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from activation_mart.llm import decontamination


def test_words_are_those_of_the_ranges(spark):
    ranges = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    texts = ["".join(map(chr, range(1, 0x300))), "a-b_c D1é\n日本 [x]^`~", "", " ", "\U0001f600z \x7f\x80", None]
    texts += [f"a{chr(c)}b" for c in [*range(300), 0xFF3F, 0x10FFFF]]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows.select("text", decontamination.raw_words(F.col("text")).alias("words")).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row["words"] == re.findall(ranges, row["text"] or "")


def test_no_ranges_are_compared():
    """A class of single characters is a table of bits; five ranges took 24 s where it takes 1 s."""
    assert "-" not in decontamination.WORD
