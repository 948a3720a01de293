"""Best-fit packing of token sequences: local best fit, then rounds over what is left open."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END = 0  # id after each document
NEARLY_FULL = 16  # tokens that a finished sequence may lack before the last round
ITEMS_PER_TASK = 1 << 16
MEMBERS_PER_TASK = 1 << 20
LEAST_GAIN = 0.01  # a round that joins a smaller share of the open sequences is the last
SLICE_BYTES = 8 << 20  # of texts tokenized at once
CACHED_WORDS = 1 << 19
MARK = "|"  # a word of one token that stands between words
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class WordIds:
    """Token ids of blank-separated words, as bytes of 32-bit integers.

    The tokenizer drops blanks and never joins letters across them, so a text's
    ids are those of its words in a row. Known words are kept in two tables of
    at most CACHED_WORDS; the older one goes when the newer is full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        mark = self._encode(MARK)
        self.mark = int(mark[0]) if len(mark) == 1 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        for word in words if self.mark is None else (w for w in words if MARK in w):
            yield word, self._encode(word).tobytes()
        rest = (w for w in words if self.mark is not None and MARK not in w)
        while some := list(islice(rest, 4096)):
            ids = self._encode(f" {MARK} ".join(some))
            marks = np.flatnonzero(ids == self.mark)
            raw, ends = ids.tobytes(), [*(4 * marks).tolist(), 4 * len(ids)]
            yield from zip(some, map(raw.__getitem__, map(slice, [0, *(4 * marks + 4).tolist()], ends)), strict=True)

    def of(self, words: list[str]) -> list[bytes]:
        if len(self.young) > CACHED_WORDS:
            self.young, self.old = {}, self.young
        young = self.young
        unseen = [word for word in words if word not in young]
        known = {word: ids for word in unseen if (ids := self.old.get(word)) is not None}
        young.update(known)
        young.update(self._encode_words([word for word in unseen if word not in known]))
        return list(map(young.__getitem__, words))


_loaded: dict[str, WordIds] = {}


def _words_of(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def token_ids(words: WordIds, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, END after each, and where each text's ids begin and the last ends."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    per_text = pc.list_value_length(split).to_numpy()
    coded = split.flatten().dictionary_encode()
    known = words.of(coded.dictionary.to_pylist())
    lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
    pool = np.frombuffer(b"".join(known), np.uint32)
    at = coded.indices.to_numpy()
    # A text's end is one more word, END, at the end of the pool.
    ends = np.cumsum(per_text)
    at = np.insert(at.astype(np.int64), ends, len(known))
    pool = np.append(pool, np.uint32(END))
    lengths = np.append(lengths, 1)
    starts = np.cumsum(lengths) - lengths
    taken = lengths[at]
    after = np.cumsum(taken)
    place = np.repeat(starts[at] - (after - taken), taken)
    place += np.arange(len(place))
    ids = pool[place]
    text_ends = after[ends + np.arange(len(ends))] if len(ends) else np.zeros(0, np.int64)
    return ids, np.concatenate(([0], text_ends))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, cut only where longer than ``capacity``.

    A document's ids are those of its text and END after them; NULL and empty
    texts have END alone. ``with_ids`` adds the ids of the piece. Repeated rows
    and rows without doc_id are documents like others; other columns are not read.
    """
    path = path or default_tokenizer()
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words_of(path)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            slot = np.cumsum(size) // SLICE_BYTES
            bounds = np.flatnonzero(np.diff(slot, prepend=-1, append=slot[-1] + 1 if len(slot) else 0))
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield _cut(words, batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low))

    def _cut(words: WordIds, keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        ids, bounds = token_ids(words, texts)
        sizes = np.diff(bounds)
        counts = -(-sizes // capacity)
        owner = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = number * capacity
        length = np.minimum(sizes[owner] - start, capacity)
        first = bounds[owner] + start
        raw = memoryview(ids.astype("<u4")).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
        columns = [keys.take(pa.array(owner)).cast(pa.int64()), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: by falling size, into the fullest bin that still takes it, else a new one."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what they lack
    some = 0  # bit r: a bin lacks r
    out, count = np.empty(len(sizes), np.int64), 0
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fits = some >> size
        if fits:
            lacks = size + (fits & -fits).bit_length() - 1
            number = room[lacks].pop()
            if not room[lacks]:
                some ^= 1 << lacks
        else:
            lacks, number = capacity, count
            count += 1
        lacks -= size
        out[at] = number
        if lacks:
            room[lacks].append(number)
            some |= 1 << lacks
    return out


def _merged(batches: list[pa.RecordBatch], capacity: int) -> pa.RecordBatch:
    """Bins (fill, members) as items of a best fit; members of a bin stand one after the other."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    fill = rows.column("fill").to_numpy()
    bins = best_fit(fill, capacity)
    order = np.argsort(bins, kind="stable")
    last = np.flatnonzero(np.diff(bins[order], append=-1))
    lists = rows.column("members").combine_chunks().take(pa.array(order))
    counts = np.cumsum(pc.list_value_length(lists).to_numpy())
    bounds = np.concatenate(([0], counts[last]))
    flat = lists.flatten()
    item = pc.struct_field(flat, "item")
    length = pc.struct_field(item, "length").to_numpy()
    before = np.cumsum(length) - length
    offset = before - np.repeat(before[bounds[:-1]], np.diff(bounds))
    members = pa.StructArray.from_arrays([item, pa.array(offset, pa.int64())], names=["item", "offset"])
    filled = np.diff(np.concatenate(([0], np.cumsum(fill[order])[last])))
    return pa.RecordBatch.from_arrays(
        [pa.array(filled, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), members)], names=["fill", "members"]
    )


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (any columns, length) with ``sequence_id`` and ``offset``: few sequences of ``capacity``.

    Each round deals the open sequences (at first the items) to as many tasks
    as hold ITEMS_PER_TASK of them each, and MEMBERS_PER_TASK items inside them,
    and packs them there, largest first into the fullest sequence that takes them. Sequences that lack NEARLY_FULL or
    less are finished; the others go on as items of the next round, in fewer
    tasks, until one task holds them all or hardly any can still be joined.
    Rounds are settled in the shared folder, an item moves with its sequence,
    and a task holds a bounded number of items however they are spread.

    An item without a length, or of one below 1 or not below ``capacity``, is a
    sequence of its own. Sequence numbers are unique, not gapless. Columns of
    these names are replaced. An empty table gives an empty result.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    length = F.col("length").cast("bigint")
    items = settle(items.select(*(length.alias(c) if c == "length" else F.col(c) for c in names)), "items")
    member = F.struct(F.struct(*names).alias("item"), F.lit(0).cast("bigint").alias("offset"))
    bins = items.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    packable = F.coalesce(F.col("fill").between(1, capacity - 1), F.lit(False))
    finished, opened = [bins.filter(~packable)], bins.filter(packable)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield _merged(held, capacity)

    while True:
        before, held = opened.agg(F.count(F.lit(1)), F.sum(F.size("members"))).first()
        if not before:
            break
        tasks = max(-(-before // ITEMS_PER_TASK), -(-held // MEMBERS_PER_TASK))
        packed = settle(opened.repartition(tasks).mapInArrow(merge, bins.schema), "sequences")
        if tasks == 1 or packed.count() > before * (1 - LEAST_GAIN):
            finished.append(packed)
            break
        full = F.col("fill") >= capacity - NEARLY_FULL
        finished.append(packed.filter(full))
        opened = packed.filter(~full)
    every = reduce(DataFrame.unionAll, finished).withColumn("sequence_id", F.monotonically_increasing_id())
    placed = every.select("sequence_id", F.explode("members").alias("m"))
    return placed.select(*(F.col(f"m.item.{c}").alias(c) for c in names), "sequence_id", F.col("m.offset").alias("offset"))


@query("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(pieces(table(spark, folder, "documents")))
