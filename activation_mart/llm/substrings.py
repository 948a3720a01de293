"""Removal of repeated byte strings, by interval expansion on Burrows-Wheeler transforms of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from . import texts
from .registry import query, table

LENGTH = 200
SEED = 24  # bytes of the substring that deals windows out
BLOCK_BYTES = 1 << 20  # of strings that are transformed together
MOST_GROUP_BYTES = 64 << 20  # of one seed; beyond, its windows are counted one by one
PLACE = np.uint64((1 << 24) - 1)
PACKED = 7  # symbols of 9 bits in the first sort key


def stretches(raw: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """Runs of windows with their least seed hash at one place: (hash, digest of the run's bytes, start, windows)."""
    if len(raw) < length:
        return None
    prefix = texts.prefix_hashes(raw)
    at = np.arange(len(raw) - seed + 1)
    hashes = texts.span_hashes(prefix, at, at + seed)
    # Hash and place in one number: the least is the leftmost place of the least hash.
    least = (hashes & ~PLACE) | (at.astype(np.uint64) & PLACE)
    span, size, windows = length - seed + 1, 1, len(raw) - length + 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:windows], least[span - size : span - size + windows])
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    ends = np.append(starts[1:], windows)
    first = starts.astype(np.uint64)
    place = starts + (((least[starts] & PLACE) - first) & PLACE).astype(np.int64)
    return hashes[place], texts.span_hashes(prefix, starts, ends + (length - 1)), starts, ends - starts


def _sorted_suffixes(symbols: np.ndarray, keys: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by their next ``depth`` symbols or more, up to the separator, by doubling."""
    n = len(symbols)
    order = np.argsort(keys)
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n, np.int64)
    rank[order] = first
    size = PACKED
    slots = np.arange(n)
    while size < depth:
        # Groups of several suffixes that have no separator yet; others are in place.
        group = rank[order[slots]]
        several = np.zeros(len(slots), bool)
        several[1:] = group[1:] == group[:-1]
        several[:-1] |= several[1:]
        slots = slots[several & (left[order[slots]] >= size)]
        if not len(slots):
            break
        places = order[slots]
        pair = (rank[places] << 32) | rank[np.minimum(places + size, n - 1)]
        moved = np.argsort(pair)
        pair, places = pair[moved], places[moved]
        order[slots] = places
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        rank[places] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size *= 2
    return order


def repeated_starts(strings: list[bytes], weights: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each string the places where a ``length``-byte substring starts that starts elsewhere too.

    ``weights`` says how many times each string occurs. The strings, parted by a
    separator, are transformed; then common prefixes are found by increasing
    value (Beller et al. 2013): an interval of suffixes that share w is extended
    backward to those that share cw, for every c before it, and where the right
    end of such an interval has no value yet, it is len(w). The search starts
    with the values that the first sort key shows and stops below ``length``;
    suffixes without a value between them share that many bytes.
    """
    sizes = np.array([len(s) for s in strings])
    symbols = np.zeros(sizes.sum() + len(strings) + 1, np.int64)
    joined = b"\0".join([b"", *strings, b""])
    symbols[:] = np.frombuffer(joined, np.uint8)
    symbols += 1
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) + 1
    bounds = np.concatenate(([0], begins + sizes))
    symbols[bounds] = 0
    n = len(symbols)
    nearest = np.repeat(bounds[1:], sizes + 1) if len(strings) else np.zeros(0, np.int64)
    left = np.concatenate(([0], nearest - np.arange(1, n)))  # symbols before the separator

    keys = np.zeros(n, np.int64)
    padded = np.concatenate((symbols, np.zeros(PACKED, np.int64)))
    for j in range(PACKED):
        keys = (keys << 9) | np.where(left >= j, padded[j : j + n], 0)
    order = _sorted_suffixes(symbols, keys, left, length)

    before = symbols[order - 1]  # the transform; the first place is a separator
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable")
    step = np.empty(n, np.int64)  # where a suffix stands with the symbol before it
    step[by_symbol] = np.arange(n)

    common = np.full(n + 1, -1, np.int16)
    common[n] = common[0] = 0
    ordered = keys[order]
    differ = ordered[1:] ^ ordered[:-1]
    ends = np.flatnonzero(differ) + 1
    top = np.frexp(differ[ends - 1].astype(np.float64))[1]  # bits; exact enough, as symbols are 9 bits apart
    common[ends] = PACKED - 1 - (np.minimum(top, 63) - 1) // 9
    lows = np.concatenate(([0], ends))
    highs = np.append(ends, n)
    whole = left[order[lows]] >= PACKED - 1
    queue = whole & (common[highs] == PACKED - 1) & (highs < n)
    lows, highs = lows[queue], highs[queue]

    for value in range(PACKED, length):
        if not len(lows):
            break
        one = highs - lows == 1
        at = lows[one]
        at = step[at[before[at] > 0]]
        new_lows, new_highs = [at], [at + 1]
        lows, highs = lows[~one], highs[~one]
        if len(lows):
            widths = highs - lows
            owner = np.repeat(np.arange(len(lows)), widths)
            at = np.arange(len(owner)) + np.repeat(lows - np.concatenate(([0], np.cumsum(widths)[:-1])), widths)
            some = before[at] > 0
            at, owner = step[at[some]], owner[some]
            if len(at):
                sort = np.argsort(at)
                at, owner = at[sort], owner[sort]
                new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])))
                new_lows.append(at[new])
                new_highs.append(at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + 1)
        lows, highs = np.concatenate(new_lows), np.concatenate(new_highs)
        open_ = common[highs] < 0
        lows, highs = lows[open_], highs[open_]
        common[highs] = value

    own = np.repeat(np.arange(len(strings)), sizes + 1)
    weight = np.concatenate(([0], np.where(left[1:] >= length, weights[own], 0)))[order]
    starts = np.flatnonzero(common[:n] >= 0)
    groups = np.add.reduceat(weight, starts)
    marked = np.zeros(n, bool)
    marked[order] = np.repeat(groups >= 2, np.diff(np.append(starts, n)))
    return [marked[b : b + max(0, s - length + 1)] for b, s in zip(begins, sizes)]


def row_key() -> Column:
    """Equal for rows equal in doc_id and text."""
    return F.xxhash64("doc_id", "text")


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """Stretches (row, start, windows, seed, digest) whose seed hash occurs twice or more.

    Seeds are counted before the shuffle, and the join may split a frequent one.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {name: [np.zeros(0, np.int64)] for name in ("row", "start", "windows", "seed", "digest")}
            for row, text in zip(batch["row"], batch["text"]):
                parts = stretches(texts.codes(text), length, min(SEED, length))
                if parts:
                    seed, digest, start, windows = parts
                    found["row"].append(np.full(len(start), row, np.int64))
                    found["start"].append(start)
                    found["windows"].append(windows)
                    found["seed"].append(seed.view(np.int64))
                    found["digest"].append(digest.view(np.int64))
            yield pd.DataFrame({name: np.concatenate(values) for name, values in found.items()})

    rows = docs.select(row_key().alias("row"), "text").filter(F.octet_length("text") >= length)
    dealt = rows.mapInPandas(cut, "row bigint, start int, windows int, seed bigint, digest bigint")
    several = dealt.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    return dealt.join(several, "seed")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, spans): for each row the byte ranges [from, to) of its repeated windows, not merged.

    A window of ``length`` bytes is dealt out by the least hash of its
    SEED-byte substrings, which neighbouring windows mostly share; equal
    windows have equal seeds. Stretches that are equal as a whole are counted
    before their bytes move. Where a seed has equal stretches alone,
    all their windows are repeated; the others go, once each, into blocks of about
    BLOCK_BYTES and through ``repeated_starts``. A seed with over
    MOST_GROUP_BYTES of different stretches, too many for a task, has its
    windows counted by their digests, over all tasks.
    """
    found = settle(occurrences(docs, length), "stretches")
    kinds = found.groupBy("seed", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("row"), F.min_by("start", "row").alias("start"),
        F.first("windows").alias("windows"),
    )
    per_seed = kinds.groupBy("seed").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + F.lit(length - 1).cast("long")).alias("bytes")
    )
    kinds = settle(kinds.join(per_seed, "seed"), "kinds")
    alone = kinds.filter("kinds = 1").select(
        "seed", "digest", F.array(F.struct(F.lit(0).alias("low"), F.col("windows").alias("high"))).alias("runs")
    )
    mixed = kinds.filter("kinds > 1")
    total = mixed.agg(F.sum(F.col("windows") + F.lit(length - 1).cast("long"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    raw = docs.select(row_key().alias("row"), F.encode("text", "UTF-8").alias("raw"))
    cut = raw.join(mixed, "row").select(
        "seed", "digest", "n", "bytes", "windows",
        F.substring("raw", F.col("start") + 1, F.col("windows") + (length - 1)).alias("piece"),
    )
    cut = settle(cut.dropDuplicates(["seed", "digest"]) if _has_copies(docs) else cut, "pieces")

    def transform(block: pd.DataFrame) -> pd.DataFrame:
        masks = repeated_starts(block["piece"].tolist(), block["n"].to_numpy(), length)
        runs = [
            [{"low": int(low), "high": int(high)} for low, high in zip(*texts.runs(mask))] for mask in masks
        ]
        return pd.DataFrame({"seed": block["seed"], "digest": block["digest"], "runs": runs})

    schema = "seed bigint, digest bigint, runs array<struct<low:int,high:int>>"
    usual = (
        cut.filter(F.col("bytes") <= MOST_GROUP_BYTES)
        .select("seed", "digest", "n", "piece", F.pmod("seed", F.lit(blocks)).alias("block"))
        .groupBy("block").applyInPandas(transform, schema)
    )
    every = cut.filter(F.col("bytes") > MOST_GROUP_BYTES).select(
        "seed", "digest", "n", F.posexplode(F.expr(
            f"transform(sequence(1, windows), i -> md5(substring(piece, i, {length})))")).alias("low", "window")
    )
    often = every.groupBy("window").agg(F.sum("n").alias("times")).filter("times > 1").select("window")
    large = every.join(often, "window").groupBy("seed", "digest").agg(
        F.collect_list(F.struct("low", (F.col("low") + 1).alias("high"))).alias("runs")
    )
    runs = alone.unionByName(usual).unionByName(large)
    spans = found.join(runs, ["seed", "digest"]).select("row", F.expr(
        f"transform(runs, x -> struct(start + x.low AS low, start + x.high + {length - 1} AS high))").alias("spans"))
    return spans.filter(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _has_copies(docs: DataFrame) -> bool:
    """Whether rows equal in doc_id and text occur, which would give a piece twice."""
    keys = docs.select(row_key().alias("row")).groupBy("row").count()
    return not keys.filter("count > 1").isEmpty()


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, left): merged removed byte ranges of each row, and the bytes that stay.

    A byte goes if a ``length``-byte string over it starts anywhere else in any
    text, its own included, as the texts are in the input; see
    ``repeated_spans``. Matches never cross texts. NULL is taken as empty, a
    text of fewer bytes loses nothing, repeated rows are each other's copies, a
    NULL doc_id is like any other, and an empty table gives an empty result.
    """
    spans = repeated_spans(docs, length).withColumnRenamed("row", "__row")
    rows = docs.select("doc_id", "text", row_key().alias("row"))
    joined = rows.join(spans, rows["row"] == spans["__row"], "left").select("doc_id", "text", "spans")

    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, merged, rest = [], [], []
            for text, spans in zip(batch["text"], batch["spans"]):
                raw = texts.codes(text).tobytes()
                cuts = _merged(spans) if spans is not None else []
                ends = [0, *(high for _, high in cuts)]
                sizes.append(len(raw))
                merged.append([{"low": low, "high": high} for low, high in cuts])
                rest.append(b"".join(raw[a:b] for a, b in zip(ends, [*(low for low, _ in cuts), len(raw)])))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_bytes": sizes, "spans": merged, "left": rest,
            })

    return joined.mapInPandas(
        removed, "doc_id bigint, n_bytes bigint, spans array<struct<low:int,high:int>>, left binary"
    )


@query("op8_repeated_substrings")
def op8_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("left")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("left", 256).alias("kept_sha256"),
    )
