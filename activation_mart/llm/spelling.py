"""Spelling variants: words one letter apart, found in a trie of letter-group counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS = 5
MIN_COUNT = 3
TIMES = 2  # a form is at least so many times as frequent as its variant
SLIPS = 97  # one run in so many loses a letter
#: Letter groups, a level of the trie each; all other letters are the last group.
GROUPS = ("e", "ao", "iu", "nr", "st", "lh", "dc", "mp", "gbf", "vwy", "jkqxz")
LEVELS = len(GROUPS) + 1
MOST_TRUNK_LEVELS = 7  # as many bytes as a positive long has
TRUNK_WORDS = 1 << 13  # words of a subtree that the trunk is made deep enough for
PART_WORDS = 1 << 14  # words of a trie built at once
PART_QUERIES = 1 << 16  # words searched in it at once
LEAF_VECTORS = 16  # vectors under a node that are compared without going deeper
PAIRS_AT_ONCE = 1 << 19
LONG = 64  # letters of a word that the matrices hold

_group = np.full(256, LEVELS - 1, np.uint8)
for _number, _members in enumerate(GROUPS):
    _group[[ord(c) for c in _members]] = _number


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of the texts: see ``spelling_variants``."""
    runs = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{MIN_LETTERS},}})"), F.lit(1))
    lowered = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).select(
        "id", F.translate("run", UPPER, LOWER).alias("run")
    )
    hashed = lowered.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    slipped = F.expr("concat(substring(run, 1, CAST(h % length(run) AS INT)), substring(run, CAST(h % length(run) AS INT) + 2))")
    kept = hashed.select(F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word"))
    counts = kept.filter(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


def _code() -> Column:
    """The word's counts at the levels that a trunk may have, a byte each, modulo 256."""
    counts = [F.length("word") - F.length(F.translate("word", GROUPS[level], "")) for level in range(MOST_TRUNK_LEVELS)]
    out = F.lit(0).cast("bigint")
    for level, count in enumerate(counts):
        out = out.bitwiseOR(F.shiftleft((count % 256).cast("bigint"), 8 * level))
    return out


def _moved(code: Column, level: int, by: int) -> Column:
    """The code with a count changed by one; it stays in its byte."""
    kept = code.bitwiseAND(F.lit(~(255 << 8 * level)))
    count = F.shiftrightunsigned(code, 8 * level).bitwiseAND(F.lit(255)) + by
    return kept.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(255)), 8 * level))


def _trunks(trunk: Column, depth: int) -> Column:
    """The word's own trunk, and those a vector with one letter more, one of them perhaps another's, can have."""
    more = [_moved(trunk, i, 1) for i in range(depth)]
    # The letter that another one replaces belongs to a later group: the other way round is the other word's search.
    other = [_moved(more[i], j, -1) for i in range(depth) for j in range(i + 1, depth)]
    return F.array(trunk, *more, *other)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of binary values in a row, where each begins, and their lengths."""
    joined = column.cast(pa.large_binary())
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    raw = joined.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


class Words:
    """Words (bytes of Latin-1) with their counts, vectors, and letters from both ends."""

    def __init__(self, letters: pa.Array, n: pa.Array):
        self.bytes = letters.to_pylist()
        self.n = np.asarray(n.to_numpy(zero_copy_only=False) if isinstance(n, pa.Array) else n.to_numpy(), np.int64)
        raw, start, self.size = _letters(letters)
        row = np.repeat(np.arange(len(start)), self.size)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        value = raw[np.repeat(start, self.size) + inside]
        cells = np.bincount(row * LEVELS + _group[value], minlength=len(start) * LEVELS)
        self.vectors = cells.reshape(-1, LEVELS).astype(np.int32)
        width = int(min(LONG, self.size.max(initial=0))) + 1
        self.ahead = np.zeros((len(start), width), np.uint8)
        self.behind = np.zeros((len(start), width), np.uint8)
        near = inside < width
        self.ahead[row[near], inside[near]] = value[near]
        back = np.repeat(self.size, self.size) - 1 - inside
        near = back < width
        self.behind[row[near], back[near]] = value[near]

    def classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct vectors in order, the words ordered by vector, and where each vector's words begin."""
        order = np.lexsort(self.vectors.T[::-1])
        sorted_ = self.vectors[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        return sorted_[first], order, np.append(first, len(order))


def _search(tree: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, vector) places with a surplus of at most one letter, and of one deficit after it.

    ``tree`` are distinct vectors in order, so a node of the trie is a range of
    them that agrees in its first levels. The search goes depth first, with all
    queries that still have a budget for the node, and what they spent.
    """
    stack = [(0, 0, len(tree), np.arange(len(queries)), np.zeros(len(queries), bool), np.zeros(len(queries), bool))]
    while stack:
        level, low, high, at, more, less = stack.pop()
        if not len(at) or low == high:
            continue
        if high - low <= LEAF_VECTORS or level == LEVELS:
            rest = tree[low:high, None, level:] - queries[None, at, level:]
            plus, minus = np.maximum(rest, 0).sum(axis=2), np.maximum(-rest, 0).sum(axis=2)
            fits = (plus + more <= 1) & (minus + less <= 1) & ((minus == 0) | (plus + more == 1))
            if fits.any() and rest.shape[2]:
                late = (plus == 1) & (minus == 1)  # the surplus must come first
                fits &= ~late | (rest.argmax(axis=2) < rest.argmin(axis=2))
            vector, bundle = np.nonzero(fits)
            if len(vector):
                yield at[bundle], low + vector
            continue
        counts = tree[low:high, level]
        cuts = np.flatnonzero(np.diff(counts)) + 1
        spent = queries[at, level]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), high - low]):
            step = int(counts[a]) - spent
            fits = (step == 0) | ((step == 1) & ~more) | ((step == -1) & more & ~less)
            if fits.any():
                chosen = step[fits]
                stack.append((level + 1, low + a, low + b, at[fits], more[fits] | (chosen == 1), less[fits] | (chosen == -1)))


def _one_apart(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _verified(first: Words, i: np.ndarray, second: Words, j: np.ndarray) -> np.ndarray:
    """Mask of the pairs that are one letter apart; ``second`` holds the longer words."""
    width = min(first.ahead.shape[1], second.ahead.shape[1])
    ahead = first.ahead[i, :width] == second.ahead[j, :width]
    behind = first.behind[i, :width] == second.behind[j, :width]
    size, other = first.size[i], second.size[j]
    # Padding differs from letters, so a run of equal places ends with the shorter word.
    shared = np.where(ahead.all(axis=1), width, ahead.argmin(axis=1)) + np.where(behind.all(axis=1), width, behind.argmin(axis=1))
    near = np.where(other == size, shared >= size - 1, (other == size + 1) & (shared >= size))
    near &= ~((other == size) & ahead.all(axis=1) & (size <= width))  # the same word
    for k in np.flatnonzero(np.maximum(size, other) >= width):
        near[k] = _one_apart(first.bytes[i[k]], second.bytes[j[k]])
    return near


def near_pairs(tree: Words, queries: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word of the tree) places of pairs one letter apart, each pair from one side only."""
    vectors, tree_order, tree_first = tree.classes()
    sought, query_order, query_first = queries.classes()

    def pairs(found: list[tuple[np.ndarray, np.ndarray]]):
        q, v = (np.concatenate(part) for part in zip(*found))
        own, other = np.diff(query_first)[q], np.diff(tree_first)[v]
        same = (sought[q] == vectors[v]).all(axis=1)
        total = own * other
        for low, high in _blocks(total, PAIRS_AT_ONCE):
            cells = np.repeat(np.arange(low, high), total[low:high])
            inside = np.arange(len(cells)) - np.repeat(np.cumsum(total[low:high]) - total[low:high], total[low:high])
            i = query_order[query_first[q[cells]] + inside // other[cells]]
            j = tree_order[tree_first[v[cells]] + inside % other[cells]]
            near = _verified(queries, i, tree, j)
            i, j, alike = i[near], j[near], same[cells][near]
            # Words of one vector meet from both sides; the smaller one searches.
            once = np.array([not s or queries.bytes[x] < tree.bytes[y] for s, x, y in zip(alike, i, j)], bool)
            yield i[once], j[once]

    waiting, held = [], 0
    for q, v in _search(vectors, sought):
        waiting.append((q, v))
        held += len(q)
        if held >= PAIRS_AT_ONCE:
            yield from pairs(waiting)
            waiting, held = [], 0
    if waiting:
        yield from pairs(waiting)


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of places whose sizes sum to about ``most``."""
    slot = (np.cumsum(sizes) - sizes) // most
    bounds = np.flatnonzero(np.diff(slot, prepend=-1, append=-2))
    yield from zip(bounds[:-1].tolist(), bounds[1:].tolist())


FOUND = "letters binary, n_near bigint, best_n bigint, best binary"


def _search_subtree(left: pa.Table, right: pa.Table) -> pa.Table:
    """Near words of a subtree's words and of the words searched in it: per word their number and the most frequent."""
    tree, queries = Words(left.column("letters").combine_chunks(), left.column("n")), Words(right.column("letters").combine_chunks(), right.column("n"))
    found: dict[bytes, list] = {}

    def note(own: Words, i: np.ndarray, other: Words, j: np.ndarray, rank: np.ndarray) -> None:
        if not len(i):
            return
        order = np.lexsort((rank[j], -other.n[j], i))
        first = np.flatnonzero(np.diff(i[order], prepend=-1))
        times = np.diff(np.append(first, len(order)))
        for place, best, n in zip(i[order][first].tolist(), j[order][first].tolist(), times.tolist()):
            seen = found.setdefault(own.bytes[place], [0, 0, b""])
            seen[0] += n
            top = int(other.n[best])
            if top > seen[1] or top == seen[1] and other.bytes[best] < seen[2]:
                seen[1], seen[2] = top, other.bytes[best]

    ranks = []
    for some in (tree, queries):
        rank = np.empty(len(some.bytes), np.int64)
        rank[sorted(range(len(some.bytes)), key=some.bytes.__getitem__)] = np.arange(len(some.bytes))
        ranks.append(rank)
    if left.num_rows and right.num_rows:
        for i, j in near_pairs(tree, queries):
            note(queries, i, tree, j, ranks[0])
            note(tree, j, queries, i, ranks[1])
    return pa.table(
        {
            "letters": pa.array(list(found), pa.binary()),
            "n_near": pa.array([v[0] for v in found.values()], pa.int64()),
            "best_n": pa.array([v[1] for v in found.values()], pa.int64()),
            "best": pa.array([v[2] for v in found.values()], pa.binary()),
        }
    )


def near_words(vocabulary: DataFrame, trunk_words: int = TRUNK_WORDS, part_words: int = PART_WORDS, part_queries: int = PART_QUERIES) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have a near word.

    The first levels of the trie, its trunk, deal the words to tasks: a subtree
    holds the words that agree in them, and a word is searched in its own
    subtree and in those that its budget of a surplus and a deficit reaches.
    Of two near words the one searches whose vector is the less at the first
    level where they differ, so each pair is found once. The trunk deepens with the vocabulary; a subtree still
    above ``part_words``, or searched by more than ``part_queries`` words, is
    dealt out by hashes of both, part by part.
    """
    coded = settle(vocabulary.select(F.encode("word", "ISO-8859-1").alias("letters"), "n", _code().alias("code")), "coded")
    depth = max(1, min(MOST_TRUNK_LEVELS, math.ceil(math.log(max(coded.count() / trunk_words, 1), 3))))
    trunk = F.col("code").bitwiseAND(F.lit((1 << 8 * depth) - 1))
    tree = coded.select(trunk.alias("trunk"), "letters", "n")
    queries = coded.select(F.explode(_trunks(trunk, depth)).alias("trunk"), "letters", "n")
    sizes = tree.groupBy("trunk").agg(F.count(F.lit(1)).alias("tree_size"))
    asked = queries.groupBy("trunk").agg(F.count(F.lit(1)).alias("query_size"))
    parts = settle(
        sizes.join(asked, "trunk").select(
            "trunk",
            F.ceil(F.col("tree_size") / part_words).cast("int").alias("tree_parts"),
            F.ceil(F.col("query_size") / part_queries).cast("int").alias("query_parts"),
        ),
        "trunks",
    )

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.join(parts, "trunk").select(
            # Aliases, for both sides of the cogroup come from one frame.
            F.col("trunk").alias("trunk"), F.col("letters").alias("letters"), F.col("n").alias("n"), F.pmod(F.xxhash64("letters"), F.col(f"{own}_parts")).cast("int").alias(f"{own}_part"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{other}_part"),
        )

    cell = ["trunk", "tree_part", "query_part"]
    found = (
        dealt(tree, "tree", "query").groupBy(*cell)
        .cogroup(dealt(queries, "query", "tree").groupBy(*cell))
        .applyInArrow(_search_subtree, FOUND)
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("top")
    return found.groupBy("letters").agg(F.sum("n_near").alias("n_near"), best).select(
        F.decode("letters", "ISO-8859-1").alias("word"), "n_near",
        (-F.col("top.less")).alias("best_n"), F.decode("top.best", "ISO-8859-1").alias("best"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to, by pointer doubling.

    Counts at least double from a word to its form, so a chain is short and has
    no cycle. Each round is settled.
    """
    links = settle(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("of"), F.col("root").alias("next"))
        joined = links.join(onward, F.col("root") == F.col("of"), "left")
        links = settle(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word of the texts (doc_id, text).

    Words are the runs of Latin letters of whole texts, lower-case in A to Z,
    of MIN_LETTERS or more, found MIN_COUNT times or more; one run in SLIPS, by
    a hash of doc_id and run, first loses a letter. A NULL text has no words, a
    NULL doc_id counts as empty in the hash, a repeated row counts again. Other
    columns are not read. No word, no row.

    ``n_near`` counts the words one letter apart, ``form`` is the most frequent
    of them if it is TIMES as frequent as the word (the first in order of code
    points in a tie), and ``root`` is what forms lead to, the word itself
    without one.
    """
    vocabulary = settle(words(docs), "vocabulary")
    near = vocabulary.join(near_words(vocabulary), "word", "left")
    enough = F.col("best_n") >= TIMES * F.col("n")
    formed = settle(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))
