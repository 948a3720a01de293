"""Quality classifier by importance resampling with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators.keys import with_surrogate_key
from ..session import settle
from . import texts
from .registry import query, table

BUCKETS = 1 << 20
MOST_LABELLED = 50_000  # labelled rows that the models are fitted to, at most
PREFIXES = (3, 4, 5, 6)
PSEUDO_COUNT = 1.0
LEVELS = (2.0, 3.0, 4.0)  # standard errors from which a ratio counts in full
UNSURE = 0.05  # share at which a ratio nearer to chance counts
CLEAN_WORTH = 3.0  # rejected texts that one lost clean text is worth, for the cut
COUNTS = ("raw0", "target0", "raw1", "target1")

_kind = np.zeros(256, np.uint8)  # 0 blank, 1 word, 2 sign
_kind[33:127] = 2
_kind[128:] = 1
_kind[[c for c in range(128) if chr(c).isalnum()]] = 1


def features(text: str | None) -> np.ndarray:
    """Buckets of the n-grams of a text, each once.

    N-grams are whole words and signs, the first 3 to 6 bytes of each word, and
    one that tells how large a share of the word pairs repeats, in tenths.
    """
    raw = texts.codes((text or "").lower())
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = _kind[raw]
    edges = np.flatnonzero(np.diff(kind)) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(raw)]))
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    prefix = texts.prefix_hashes(raw)
    words = texts.span_hashes(prefix, starts, ends)
    found = [words]
    for n in PREFIXES:
        long = starts[ends - starts >= n]
        found.append(texts.mixed(texts.span_hashes(prefix, long, long + n) + np.uint64(n)))
    if len(words) > 1:
        pairs = texts.mixed(words[:-1] * texts.STEP + words[1:])
        share = 1 - len(np.unique(pairs)) / len(pairs)
        found.append(texts.mixed(np.array([int(10 * share)], np.uint64)))
    return np.unique(np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Texts of labelled documents: ``clean`` or not, and in which ``half``, by hash.

    A document is clean with quality 1 and toxic 0 in all its labels; labels
    with a NULL are not used. At most ``most`` labels, those of least hash, are
    taken, hence few enough to broadcast.
    """
    marked = (
        labels.select("doc_id", "quality", "toxic").dropna()
        .groupBy("doc_id").agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("clean"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int")
    return docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select(
        "text", "clean", half.alias("half")
    )


def count_features(sample: DataFrame) -> np.ndarray:
    """Per half of the sample and bucket, the texts that have it: all (raw) and clean ones (target).

    Four numbers a bucket reach the driver, a fixed amount.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((4, BUCKETS), np.int64)
        for batch in batches:
            for text, clean, half in zip(batch["text"], batch["clean"], batch["half"]):
                own = features(text)
                seen[2 * half, own] += 1
                if clean:
                    seen[2 * half + 1, own] += 1
        some = np.flatnonzero(seen[0] + seen[2])
        yield pd.DataFrame({"bucket": some} | {name: seen[i, some] for i, name in enumerate(COUNTS)})

    counts = (
        sample.mapInPandas(counted, "bucket bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
        .groupBy("bucket").agg(*[F.sum(c).cast("int").alias(c) for c in COUNTS])
        .select(F.col("bucket").cast("int"), *COUNTS)
        .toArrow()  # 20 bytes a bucket; as rows they would be objects
    )
    out = np.zeros((4, BUCKETS), np.int32)
    for i, name in enumerate(COUNTS):
        out[i, counts["bucket"].to_numpy()] = counts[name].to_numpy()
    return out


def log_ratios(raw: np.ndarray, target: np.ndarray, share: float, level: float) -> np.ndarray:
    """Log ratio of the target's to the raw model for each bucket, from the texts that have it.

    Both models are normalised: ``share`` of raw texts are target texts, so a
    bucket that is as frequent in both has ratio 1, as has an unseen one. A
    ratio of either sign counts in full where the target's count stands out from
    chance by ``level`` standard errors, else at the share UNSURE.
    """
    expected = raw * share
    ratio = np.log((target + PSEUDO_COUNT) / (expected + PSEUDO_COUNT))
    sure = np.abs(target - expected) > level * np.sqrt(expected * (1 - share) + 0.25)
    return np.where(sure, ratio, UNSURE * ratio).astype(np.float32)


def mean_ratio(ratios: np.ndarray, text: str | None) -> float:
    """Mean log ratio over the n-grams of a text, so that length weighs nothing; NaN without any."""
    own = features(text)
    return float(ratios[own].mean(dtype=np.float64)) if len(own) else float("nan")


def log_odds(means: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of a logistic fit of ``clean`` to the means, with Platt's smoothed targets."""
    good, bad = clean.sum(), (~clean).sum()
    goal = np.where(clean, (good + 1) / (good + 2), 1 / (bad + 2))
    centre, spread = means.mean(), means.std() or 1.0
    x = np.stack(((means - centre) / spread, np.ones(len(means))))
    fitted = np.zeros(2)

    def loss(at: np.ndarray) -> float:
        z = at @ x
        return float((np.logaddexp(0, z) - goal * z).sum())

    for _ in range(100):
        share = 1 / (1 + np.exp(-np.clip(fitted @ x, -500, 500)))
        hessian = (x * (share * (1 - share) + 1e-9)) @ x.T + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, x @ (goal - share)), 1.0
        while size > 1e-6 and loss(fitted + size * step) > loss(fitted):
            size /= 2
        fitted = fitted + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(fitted[0] / spread), float(fitted[1] - fitted[0] * centre / spread)


@dataclass
class Resampler:
    """Log ratios, the odds that their mean stands for, and the weight from which a text counts as target text."""

    ratios: np.ndarray
    slope: float = 0.0
    intercept: float = 0.0
    cut: float = float("-inf")

    def weight(self, text: str | None) -> float:
        """Calibrated log importance weight; least possible for a text without n-grams."""
        mean = mean_ratio(self.ratios, text)
        return float("-inf") if np.isnan(mean) else self.slope * mean + self.intercept


def fit(sample: DataFrame) -> Resampler:
    """Models, and their calibration on labelled texts.

    Each half of the sample is scored by the models of the other, for several
    levels of significance. Level and cut are those with most clean texts kept,
    worth CLEAN_WORTH, and others rejected; a logistic fit turns the mean log
    ratio, whose scale depends on the n-grams, into log odds.
    """
    totals = {
        (row["half"], row["clean"]): row["count"] for row in sample.groupBy("half", "clean").count().collect()
    }
    clean, other = (sum(n for (_, c), n in totals.items() if c is kind) for kind in (True, False))
    if not clean or not other:
        return Resampler(np.zeros(BUCKETS, np.float32))
    counts = count_features(sample)
    share = [totals.get((h, True), 0) / max(1, totals.get((h, True), 0) + totals.get((h, False), 0)) for h in (0, 1)]
    shared = sample.sparkSession.sparkContext.broadcast(counts)
    names = [f"mean{i}" for i in range(len(LEVELS))]

    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = {
            (h, i): log_ratios(shared.value[2 - 2 * h], shared.value[3 - 2 * h], share[1 - h], level)
            for h in (0, 1) for i, level in enumerate(LEVELS)
        }
        for batch in batches:
            rows = []
            for text, clean, half in zip(batch["text"], batch["clean"], batch["half"]):
                own = features(text)
                if len(own):
                    rows.append([bool(clean), *(float(models[half, i][own].mean(dtype=np.float64)) for i in range(len(LEVELS)))])
            yield pd.DataFrame(rows, columns=["clean", *names])

    # One row per text of the bounded sample.
    scored = sample.mapInPandas(crossed, "clean boolean, " + ", ".join(f"{c} double" for c in names)).toArrow()
    means, is_clean = np.stack([scored[c].to_numpy() for c in names], axis=1), scored["clean"].to_numpy().astype(bool)
    if is_clean.all() or not is_clean.any():
        return Resampler(np.zeros(BUCKETS, np.float32))
    best, level, least = -1.0, 0, 0.0
    for i in range(len(LEVELS)):
        values = np.unique(means[:, i])
        kept = 1 - np.searchsorted(np.sort(means[is_clean, i]), values) / is_clean.sum()
        rejected = np.searchsorted(np.sort(means[~is_clean, i]), values) / (~is_clean).sum()
        gain = CLEAN_WORTH * kept + rejected
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, level, least = gain[at], i, float(values[at])
    slope, intercept = log_odds(means[:, level], is_clean)
    whole = log_ratios(counts[0] + counts[2], counts[1] + counts[3], clean / (clean + other), LEVELS[level])
    return Resampler(whole, slope, intercept, slope * least + intercept)


def log_weight(spark: SparkSession, fitted: Resampler):
    """Column function: calibrated log importance weight of a text."""
    shared = spark.sparkContext.broadcast(fitted)

    def weigh(column: pd.Series) -> pd.Series:
        fitted = shared.value
        return pd.Series([fitted.weight(text) for text in column], dtype="float64")

    weigh.__annotations__ = {"column": pd.Series, "return": pd.Series}
    return F.pandas_udf(weigh, DoubleType())


def _gumbel(key: Column) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(11)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(-F.log(uniform))


def resample(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """Every row of ``docs`` with ``__weight``, ``__score`` and ``__kept``.

    The target is the clean part of a labelled sample, raw text the whole
    sample; both are normalised models of hashed n-grams, counted once per text.
    ``__weight`` is the mean over the text's n-grams of the log ratio of the two,
    calibrated to log odds on labelled texts; ``__score`` adds standard Gumbel
    noise (from a hash of doc_id), and the k rows of highest score are kept,
    which draws k rows without replacement in proportion to the odds. k is the
    number of rows whose weight reaches the cut found on labelled rows. The k-th
    score is found by numbering (score, doc_id) over range partitions; rows
    never meet in one task.

    NULL and empty texts have no n-grams and the least weight, minus infinity;
    a text of unknown n-grams has a mean ratio of 1. Ties go to the smaller
    doc_id, NULL last; equal rows are kept or dropped together; without labels
    of both kinds all rows are kept; an empty table gives an empty result; extra
    columns stay, but for those named like the three added.
    """
    spark = docs.sparkSession
    sample = settle(labelled_sample(docs, labels, most_labelled), "labelled")
    fitted = fit(sample)
    weigh = log_weight(spark, fitted)
    scored = settle(docs.withColumn("__weight", weigh("text")), "weighed")
    score = F.col("__weight") + _gumbel(F.col("doc_id"))
    tie = F.coalesce("doc_id", F.lit(2**63 - 1))
    scored = scored.withColumn("__score", score)
    k = scored.filter(F.col("__weight") >= F.lit(fitted.cut)).count()
    if not k:
        return scored.withColumn("__kept", F.lit(False))
    ranked = with_surrogate_key(
        scored.select((-F.col("__score")).alias("__down"), tie.alias("__tie")), "__rank", ["__down", "__tie"]
    )
    last = ranked.filter(F.col("__rank") == k).first()
    kept = (-F.col("__score") < last["__down"]) | ((-F.col("__score") == last["__down"]) & (tie <= last["__tie"]))
    return scored.withColumn("__kept", kept)


@query("op4_importance_resampling")
def op4_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = resample(docs, table(spark, folder, "labels"))
    return judged.select(
        "doc_id", F.col("__weight").alias("weight"), F.col("__score").alias("score"), F.col("__kept").alias("kept")
    )
