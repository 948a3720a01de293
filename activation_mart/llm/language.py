"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from . import texts
from .registry import query, table

ORDER = 4
BITS = 16  # of a character in an n-gram; letters beyond the basic plane share one code
BLANK, OTHER = 32, 0xFFFF
REJECTED_SHARE = 0.005  # of calibration texts of a language that its limit rejects
SHARPNESS = 20.0  # characters that the score treats as independent evidence
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _codes_of_letters() -> np.ndarray:
    """For each code point its code, 0 for what is no letter."""
    if not _letters:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        _letters.append(np.where(letter, np.minimum(points, OTHER), 0).astype(np.uint16))
    return _letters[0]


def characters(text: str | None) -> np.ndarray:
    """Lower-case letters of a text, each run of other characters as one blank, a blank before."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate((np.zeros(1, np.uint16), _codes_of_letters()[points], np.zeros(1, np.uint16)))
    kept = codes > 0
    kept[1:] |= codes[:-1] > 0
    kept[0] = True
    codes = np.where(codes > 0, codes, BLANK)[kept]
    return codes if len(codes) > 1 else codes[:0]


def grams(codes: np.ndarray, n: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each character after the first; the text begins with n - 1 blanks."""
    padded = np.concatenate((np.full(n - 2, BLANK, np.uint64), codes.astype(np.uint64)))
    out = np.zeros(max(0, len(codes) - 1), np.uint64)
    for j in range(n):
        out = (out << np.uint64(BITS)) | padded[j : j + len(out)]
    return out


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) of all texts (lang, text); each task counts before anything is shuffled."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list] = {}

        def flush(lang):
            parts = waiting.pop(lang)
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            return pd.DataFrame({"lang": lang, "gram": found.view(np.int64), "n": n})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                waiting.setdefault(lang, []).append(grams(characters(text)))
                if sum(map(len, waiting[lang])) > 1 << 21 or len(waiting[lang]) > 4096:
                    yield flush(lang)
        for lang in list(waiting):
            yield flush(lang)

    rows = labelled.select("lang", "text").mapInPandas(counted, "lang string, gram bigint, n bigint")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> list[pd.DataFrame]:
    """Per order from 1: (lang, gram, n, total, kinds, discount) of all n-grams.

    n is a count at the highest order and a number of different characters
    before it below; total and kinds are those of its context. No n-gram is
    left out, so what the driver holds grows with their number.
    """
    out = []
    for order in range(ORDER, 0, -1):
        context = F.shiftrightunsigned("gram", BITS)
        contexts = counts.groupBy("lang", context.alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
        )
        ones = counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        rare = F.col("n1") + 2 * F.col("n2")
        discount = F.when(rare > 0, F.greatest(F.lit(0.1), F.least(F.lit(0.9), F.col("n1") / rare))).otherwise(0.5)
        ones = ones.select("lang", discount.alias("discount"))
        named = counts.withColumn("context", context)
        out.append(named.join(contexts, ["lang", "context"]).join(ones, "lang").drop("context").toPandas())
        if order > 1:
            below = F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))
            counts = settle(counts.groupBy("lang", below.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
    return out[::-1]


class Model:
    """Log probabilities of all languages, in sorted arrays of hashes of n-grams and of contexts."""

    def __init__(self, tables: list[pd.DataFrame]):
        self.languages = sorted(tables[0]["lang"].unique()) if len(tables[0]) else []
        self.hashes, self.logs, self.context_hashes, self.backoffs = [], [], [], []
        size = tables[0]["gram"].nunique() + 1
        self.uniform = -np.log(size)
        for order, table in enumerate(tables, 1):
            self._add(order, table)

    def _add(self, order: int, rows: pd.DataFrame) -> None:
        found = np.unique(rows["gram"].to_numpy(np.int64).view(np.uint64))
        contexts = np.unique(found >> np.uint64(BITS))
        shorter = found & np.uint64((1 << BITS * (order - 1)) - 1)
        lower = np.exp(self.log_probabilities(shorter, order - 1))
        probability = np.zeros((len(found), len(self.languages)))
        back = np.ones((len(contexts), len(self.languages)))
        for at, lang in enumerate(self.languages):
            own = rows[rows["lang"] == lang]
            gram = own["gram"].to_numpy(np.int64).view(np.uint64)
            place = np.searchsorted(contexts, gram >> np.uint64(BITS))
            total, discount = own["total"].to_numpy(float), own["discount"].to_numpy(float)
            probability[np.searchsorted(found, gram), at] = (own["n"].to_numpy(float) - discount) / total
            back[place, at] = discount * own["kinds"].to_numpy(float) / total
        probability += back[np.searchsorted(contexts, found >> np.uint64(BITS))] * lower
        for keys, values, hashes, logs in (
            (found, probability, self.hashes, self.logs), (contexts, back, self.context_hashes, self.backoffs),
        ):
            hashed = texts.mixed(keys + np.uint64(1))
            sort = np.argsort(hashed)
            hashes.append(hashed[sort])
            logs.append(np.log(np.maximum(values[sort], 1e-300)).astype(np.float32))

    @staticmethod
    def _find(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = texts.mixed(keys + np.uint64(1))
        at = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
        return at, hashes[at] == hashed

    def log_probabilities(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Of the last character of each n-gram after the others, for every language."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.uniform, np.float32)
        at, seen = self._find(keys, self.hashes[order - 1])
        out = self.logs[order - 1][at]
        if not seen.all():
            rest = np.flatnonzero(~seen)
            unseen = keys[rest]
            mask = np.uint64((1 << BITS * (order - 1)) - 1)
            shorter = self.log_probabilities(unseen & mask, order - 1)
            at, known = self._find(unseen >> np.uint64(BITS), self.context_hashes[order - 1])
            out[rest] = shorter + np.where(known[:, None], self.backoffs[order - 1][at], 0)
        return out

    def entropies(self, text: str | None) -> np.ndarray | None:
        """Cross-entropy per character for every language; None without letters."""
        codes = characters(text)
        if not len(codes) or not self.languages:
            return None
        keys, total = grams(codes), np.zeros(len(self.languages))
        for low in range(0, len(keys), 1 << 16):
            total -= self.log_probabilities(keys[low : low + (1 << 16)], ORDER).sum(axis=0, dtype=np.float64)
        return total / len(keys)


def train(labelled: DataFrame) -> Model:
    """Models of all languages in (lang, text); rows with a NULL are not used."""
    used = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return Model(kneser_ney(settle(count_grams(used), "grams")))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (any columns, text) with ``lang_pred``, ``entropy`` and ``score``.

    The language is that of the least cross-entropy per character over the whole
    text, the first by name in a tie. The score is its share of exp(-SHARPNESS x
    entropy) over all languages, from 0 to 1. NULL and texts without a letter,
    and all texts if no language was learned, are ``und`` with score 0 and NULL
    entropy. Only the text is read to predict.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(column: pd.Series) -> pd.DataFrame:
        model, rows = shared.value, []
        for text in column:
            entropies = model.entropies(text)
            if entropies is None:
                rows.append((UNKNOWN, None, 0.0))
                continue
            best = int(np.argmin(entropies))
            share = np.exp(-SHARPNESS * (entropies - entropies[best]))
            rows.append((model.languages[best], float(entropies[best]), float(1 / share.sum())))
        return pd.DataFrame(rows, columns=["lang_pred", "entropy", "score"]).astype({"entropy": "float64"})

    predict.__annotations__ = {"column": pd.Series, "return": pd.DataFrame}
    found = F.pandas_udf(predict, "lang_pred string, entropy double, score double")
    return docs.withColumn("__found", found("text")).select(*docs.columns, "__found.*")


def fold() -> Column:
    """Number of a document's fold, 0 to 3."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, entropy, rejected) of every row of ``docs``.

    Folds 0 and 1 of doc_id train the models, fold 3 calibrates, fold 2 is held
    out. ``rejected`` marks texts whose entropy is above that of all but
    REJECTED_SHARE of the calibration texts of the predicted language: no
    learned language fits them well. Folds go by crc32 of doc_id; a NULL doc_id
    is in none. All texts are read whole; repeated rows are predicted alike; an
    empty table gives an empty result.
    """
    model = train(docs.filter(fold().isin(0, 1)).select("lang", "text"))
    scored = settle(
        identify(docs.select("doc_id", "text", fold().alias("fold"), (F.col("lang")).alias("lang")), model).drop("text"),
        "languages",
    )
    right = scored.filter((F.col("fold") == 3) & (F.col("lang") == F.col("lang_pred")))
    limits = right.groupBy("lang_pred").agg(
        F.percentile_approx("entropy", 1 - REJECTED_SHARE, 10_000).alias("limit")
    )
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(
        "doc_id", F.coalesce(F.col("fold") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy",
        F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False)).alias("rejected"),
    )


@query("op6_kneser_ney_language")
def op6_kneser_ney_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(table(spark, folder, "documents").select("doc_id", "text", "lang"))
