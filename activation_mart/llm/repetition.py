"""Quality rules on repetition: characters inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from . import texts
from .registry import query, table

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
BASE_PERCENT = 30
LENGTHS = range(5, 11)
#: Most per cent of the words' characters inside n-grams found twice or more, and inside repeated lines.
MOST_PERCENT = {5: 30, 6: 29, 7: 28, 8: 27, 9: 26, 10: 25}
MOST_LINE_PERCENT = 30

_blank = np.zeros(256, bool)
_blank[[ord(c) for c in BLANKS]] = True
_symbol = np.zeros(256, bool)
_symbol[[ord(c) for c in SYMBOLS]] = True

SCHEMA = ", ".join(
    ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint",
     "n_repeat_words bigint", "dup_line_chars bigint", *(f"dup_chars_{n} bigint" for n in LENGTHS),
     "base_failed boolean", "kept boolean"]
)


def measure(text: str | None) -> tuple:
    """The counts of one text, in the order of SCHEMA without doc_id."""
    raw = texts.codes(text)
    letter = (raw & 0xC0) != 0x80  # one byte of each code point
    starts, ends = texts.runs(~_blank[raw])
    n_words = len(starts)
    before = np.concatenate(([0], np.cumsum(letter)))
    chars = before[ends] - before[starts]
    word_chars = int(chars.sum())
    lines: dict[str, int] = {}
    dup_lines = dup_line_chars = 0
    if n_words:
        for line in text.split("\n"):
            if line.strip(BLANKS):
                seen = lines.get(line, 0)
                lines[line] = seen + 1
                dup_lines += seen > 0
        for line, times in lines.items():
            if times > 1:
                dup_line_chars += times * sum(map(len, line.translate(_to_space).split(" ")))
    repeat_words, dup_chars = 0, dict.fromkeys(LENGTHS, 0)
    if n_words:
        words = texts.span_hashes(texts.prefix_hashes(raw), starts, ends)
        for n, hashes in texts.ngrams(words, LENGTHS):
            mask = texts.repeated(hashes)
            if mask is None:
                break  # longer ones can't repeat either
            inside = texts.covered(mask, n, n_words)
            dup_chars[n] = int(chars[inside].sum())
            if n == WINDOW:
                repeat_words = int(inside.sum())
    base_failed = n_words < MIN_WORDS or 100 * repeat_words > BASE_PERCENT * n_words
    kept = not (
        base_failed
        or any(100 * dup_chars[n] > MOST_PERCENT[n] * word_chars for n in LENGTHS)
        or 100 * dup_line_chars > MOST_LINE_PERCENT * word_chars
    )
    return (n_words, word_chars, int(_symbol[raw].sum()), dup_lines, repeat_words, dup_line_chars,
            *dup_chars.values(), base_failed, kept)


_to_space = {ord(c): " " for c in BLANKS}


def repetition(docs: DataFrame) -> DataFrame:
    """Counts of repetition and the verdict, one row per row of ``docs``.

    Every text is read whole, by itself, with rolling hashes of word n-grams
    of 64 bits; nothing is shuffled. A text fails the base rules with fewer
    than MIN_WORDS words or with over BASE_PERCENT of its words in windows of
    WINDOW words found twice. It is kept if it passes them, and if neither its
    repeated n-grams of any length nor its repeated lines hold more than their
    share of the words' characters. Characters are counted in all occurrences,
    the first included. NULL and empty texts have no words and fail; repeated
    rows are judged alike; other columns of ``docs`` are neither read nor
    returned.
    """

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [(key, *measure(text)) for key, text in zip(batch["doc_id"].tolist(), batch["text"])]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(judged, SCHEMA)


def _sql() -> str:
    grams = "".join(
        f""",
g{n} AS (
  SELECT doc_id, sum(chars) AS chars, count(*) AS n_inside FROM (
    SELECT DISTINCT doc_id, unnest(range(start, start + {n})) AS i FROM (
      SELECT doc_id, start, count(*) OVER (PARTITION BY doc_id, gram) AS times
      FROM (SELECT doc_id, start, md5(array_to_string(words[start:start + {n - 1}], ' ')) AS gram
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS start FROM w)))
    WHERE times > 1) JOIN wl USING (doc_id, i)
  GROUP BY doc_id)"""
        for n in LENGTHS
    )
    fails = " OR ".join(
        f"100 * coalesce(g{n}.chars, 0) > {MOST_PERCENT[n]} * word_chars" for n in LENGTHS
    )
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
wl AS (
  SELECT doc_id, i, len(word) AS chars
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w)),
lines AS (
  SELECT doc_id, line, count(*) AS times,
         len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
per_line AS (
  SELECT doc_id, sum(times - 1) AS dup, sum(times * chars) FILTER (times > 1) AS chars FROM lines GROUP BY doc_id){grams},
counts AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
         coalesce(g{WINDOW}.n_inside, 0) AS n_repeat_words, coalesce(l.chars, 0) AS dup_line_chars,
         {', '.join(f'coalesce(g{n}.chars, 0) AS dup_chars_{n}' for n in LENGTHS)},
         n_words < {MIN_WORDS} OR 100 * coalesce(g{WINDOW}.n_inside, 0) > {BASE_PERCENT} * n_words AS base_failed,
         {fails} OR 100 * coalesce(l.chars, 0) > {MOST_LINE_PERCENT} * word_chars AS repeats
  FROM counts LEFT JOIN per_line l USING (doc_id)
  {' '.join(f'LEFT JOIN g{n} USING (doc_id)' for n in LENGTHS)})
SELECT doc_id, {', '.join(f'{c}::BIGINT AS {c}' for c in [p.split()[0] for p in SCHEMA.split(', ')][1:-2])},
       base_failed, NOT base_failed AND NOT repeats AS kept
FROM judged
"""


@query("op3_repetition_coverage", _sql())
def op3_repetition_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return repetition(table(spark, folder, "documents"))
