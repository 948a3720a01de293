"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import with_surrogate_key
from ..session import settle
from . import texts
from .components import linked_components, own_weights
from .registry import query, table
from .rows import held, released

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 5  # a pair of similarity 0.8 meets in a band with probability 0.998
BUCKETS = 1 << 18  # of document frequencies
IDF_SPREAD = 0.25
DRAWS = 1 << 16  # entries of the tables of random numbers

_letter = np.zeros(256, bool)
_letter[128:] = True
_letter[[c for c in range(128) if chr(c).isalnum()]] = True


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of five words as 64-bit hashes, sorted, and how often each occurs.

    Words are lower-cased runs of ASCII letters, digits and other scripts; a
    shorter text is one shingle, one without words has none.
    """
    raw = texts.codes((text or "").lower())
    starts, ends = texts.runs(_letter[raw])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = texts.span_hashes(texts.prefix_hashes(raw), starts, ends)
    n = min(SHINGLE, len(words))
    (_, grams), = texts.ngrams(words, range(n, n + 1))
    return np.unique(texts.mixed(grams + np.uint64(n)), return_counts=True)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - 18)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Texts per hashed shingle, over all documents, and the number of texts with any."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                own = np.unique(_bucket(shingles(text)[0]))
                seen[own] += 1
                n += len(own) > 0
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(some, -1), "n": np.append(seen[some], n)})

    rows = (
        docs.select("text").mapInPandas(counted, "bucket bigint, n bigint")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # a row per bucket, a fixed number
    ).set_index("bucket")["n"]
    out = np.zeros(BUCKETS, np.int64)
    total = int(rows.get(-1, 0))
    rows = rows.drop(-1, errors="ignore")
    out[rows.index.to_numpy()] = rows.to_numpy()
    return out, total


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of each bucket: 1 for a shingle of every text, up to 1 + IDF_SPREAD for a rare one.

    The spread is small on purpose: copies of a text that is itself frequent
    differ in rare shingles, which must not outweigh all that they share.
    """
    counts, total = document_frequencies(docs)
    return 1 + IDF_SPREAD * (1 - np.log1p(counts) / np.log1p(max(total, 1)))


class Sampler:
    """Improved consistent weighted sampling (Ioffe 2010).

    For each sample k and shingle s, r and c ~ Gamma(2, 1) and b ~ U(0, 1) come
    from tables, at places that a hash of s and k names. t = floor(ln w / r + b),
    and the sample is the (s, t) of least ln c - r (t - b + 1).
    """

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 20):
        random = np.random.default_rng(seed)
        self.r = random.gamma(2, 1, DRAWS).astype(np.float32)
        self.log_c = np.log(random.gamma(2, 1, DRAWS)).astype(np.float32)
        self.b = random.random(DRAWS).astype(np.float32)
        self.factors = random.integers(1 << 63, size=samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per sample."""
        logs = np.log(weights).astype(np.float32)
        best = np.full(len(self.factors), np.inf, np.float32)
        out = np.zeros(len(self.factors), np.uint64)
        for low in range(0, len(grams), 4096):  # long texts piece by piece
            part = grams[low : low + 4096]
            at = ((part * self.factors[:, None]) >> np.uint64(48)).astype(np.int32)
            r, b = self.r[at], self.b[at]
            t = np.floor(logs[low : low + 4096] / r + b)
            value = self.log_c[at] - r * (t - b + 1)
            place = np.argmin(value, axis=1)
            k = np.arange(len(out))
            least = value[k, place]
            new = least < best
            best[new] = least[new]
            chosen = part[place] ^ texts.mixed(t[k, place].astype(np.int64).view(np.uint64))
            out[new] = chosen[new]
        return texts.mixed(out + np.arange(len(out), dtype=np.uint64))


def _weights(idf: np.ndarray, grams: np.ndarray, times: np.ndarray) -> np.ndarray:
    return times * idf[_bucket(grams)]


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, key, size, bands) of every row: digest of the text, weight of its set, hashes of its bands."""

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample, steps = Sampler(), np.arange(1, ROWS + 1, dtype=np.uint64)
        for batch in batches:
            sizes, bands = [], []
            for text in batch["text"]:
                grams, times = shingles(text)
                if not len(grams):
                    sizes.append(0.0)
                    bands.append([])
                    continue
                weights = _weights(idf.value, grams, times)
                sizes.append(float(weights.sum()))
                rows = sample(grams, weights).reshape(BANDS, ROWS)
                mixed = texts.mixed((rows * texts.mixed(steps)).sum(axis=1) + np.arange(BANDS, dtype=np.uint64))
                bands.append(mixed.view(np.int64))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "size": sizes, "bands": bands,
            })

    keyed = docs.select("doc_id", F.unhex(F.md5("text")).alias("key"), "text").filter(F.col("text").isNotNull())
    return keyed.mapInPandas(signed, "doc_id bigint, key binary, size double, bands array<bigint>")


def weighted_jaccard(pairs: DataFrame, idf) -> DataFrame:
    """(a, b, similarity) of pairs (a, b, text_a, text_b): sum of lesser by sum of greater weights."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, last = [], (None, None)
            for text_a, text_b in zip(batch["text_a"], batch["text_b"]):
                if last[0] != text_a:
                    last = (text_a, shingles(text_a))
                (grams_a, times_a), (grams_b, times_b) = last[1], shingles(text_b)
                a, b = _weights(idf.value, grams_a, times_a), _weights(idf.value, grams_b, times_b)
                at = np.minimum(np.searchsorted(grams_a, grams_b), len(grams_a) - 1)
                both = grams_a[at] == grams_b
                shared = np.minimum(a[at[both]], b[both]).sum()
                out.append(float(shared / (a.sum() + b.sum() - shared)))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": out})

    return pairs.select("a", "b", "text_a", "text_b").mapInPandas(compared, "a bigint, b bigint, similarity double")


def weighted_shingles(frame: DataFrame, idf) -> DataFrame:
    """(node, element, weight) of the shingles of (node, text)."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, text in zip(batch["node"], batch["text"]):
                grams, times = shingles(text)
                yield pd.DataFrame({
                    "node": np.full(len(grams), node), "element": grams.view(np.int64),
                    "weight": _weights(idf.value, grams, times),
                })

    return frame.select("node", "text").mapInPandas(listed, "node bigint, element bigint, weight double")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per distinct text: ``key``, ``first_id`` (its least doc_id), ``n_first``, ``class_id``, ``n_links``.

    Equal texts are one node from the start, whatever their number. Nodes that
    agree in a band of their signatures are compared by the weighted Jaccard
    similarity of their whole shingle sets; classes are the components of the
    pairs that reach ``similarity`` (see ``linked_components``). ``class_id`` is
    the least doc_id of the class. The frequencies that all tasks read are one
    number for each of a fixed number of buckets.

    NULL texts are no nodes, each stays a class of its own; texts without words,
    the empty one included, are similar to equal ones only. Rows with NULL
    doc_id take part; a class without any doc_id has NULL as class_id. Repeated
    rows are copies. An empty table gives an empty result. Only doc_id and text
    are read.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))
    signed = settle(signatures(docs, idf), "signatures")
    rows = signed.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    nodes = rows.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.min_by("n", "doc_id").alias("n_first"), F.max("size").alias("size")
    )
    nodes = with_surrogate_key(
        nodes.withColumn("none", F.col("first_id").isNull()), "node", ["none", "first_id", "key"]
    ).drop("none")
    nodes = settle(nodes, "nodes")
    # A node's bands are those of any of its rows; the row of its least doc_id stands for it.
    bands = signed.filter(F.size("bands") > 0).join(nodes.drop("size"), "key").filter(
        F.col("doc_id").eqNullSafe(F.col("first_id"))
    )
    members = bands.select("node", F.explode("bands").alias("bucket")).distinct()
    hashed = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("key")).filter(F.col("text").isNotNull())

    def fetch(wanted: DataFrame) -> DataFrame:
        named = nodes.join(wanted, "node").select("node", "key", "first_id", "n_first", "size")
        rows = hashed.join(named, "key").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
        rows = rows.select("node", "size", "text", "n_first")
        once = rows.filter("n_first = 1").drop("n_first")
        repeated = rows.filter("n_first > 1 OR n_first IS NULL").drop("n_first")
        return once.unionByName(repeated.dropDuplicates(["node"]))

    def compare(pairs: DataFrame, fetched: DataFrame) -> DataFrame:
        left = pairs.join(fetched.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        both = left.join(fetched.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        return weighted_jaccard(both, idf).filter(F.col("similarity") >= similarity).select("a", "b").distinct()

    def own(wanted: DataFrame, fetched: DataFrame) -> DataFrame:
        return own_weights(weighted_shingles(fetched.join(wanted, "node"), idf).distinct())

    roots, links = linked_components(members, fetch, compare, own, similarity)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    firsts = nodes.select(F.col("node").alias("root"), F.col("first_id").alias("class_id"))
    return (
        nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        .join(firsts, "root").join(degrees, "node", "left")
        .select("key", "first_id", "n_first", "class_id", F.col("node") == F.col("root"),
                F.coalesce("n_links", F.lit(0)).alias("n_links"))
        .toDF("key", "first_id", "n_first", "class_id", "is_first", "n_links")
    )


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The first document of each class, and all with NULL text, with the columns of ``docs``."""
    classes = settle(near_duplicates(docs.select("doc_id", "text"), similarity), "classes")
    first = classes.filter("is_first").select(
        F.col("key").alias("__of_key"), F.col("first_id").alias("__first_id"), F.col("n_first").alias("__n_first")
    )
    keyed = held(docs, "doc_id", "text").withColumn("__key", F.unhex(F.md5("text")))
    match = F.expr("__key = __of_key AND doc_id <=> __first_id")
    kept = keyed.filter(F.col("text").isNotNull()).join(first, match)
    once = "__n_first = 1 AND __first_id IS NOT NULL"
    if not first.filter(f"NOT ({once})").isEmpty():  # a repeated row, or none with a doc_id
        repeated = kept.filter(f"NOT ({once})").dropDuplicates(["__key"])
        kept = kept.filter(once).unionByName(repeated)
    return released(kept, docs).unionByName(docs.filter(F.col("text").isNull()))


@query("op1_minhash_near_duplicates")
def op1_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    classes = settle(near_duplicates(docs), "classes").select("key", "class_id", "first_id", "n_links")
    found = docs.select("doc_id", F.unhex(F.md5("text")).alias("key")).join(classes, "key", "left")
    return found.select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
