"""Benchmark decontamination: a prefix-filtered set join of word windows with exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table
from .rows import held, released

# Words before lower-casing. One by one, the characters between words are bits of a table; as ranges each
# character of a text is compared with all of them, over ten times slower.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
WINDOWS_AT_ONCE = 256  # of one word, compared with a place in one row
MOST_BROADCAST_WORDS = 200_000  # some MB


def raw_words(text: Column) -> Column:
    """Words of a text as they stand; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def folded(word: Column) -> Column:
    """A word with A-Z in lower case; ``lower`` does just that where all is ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER)
    )


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items, with the items that have them and the window's size."""
    words = F.transform(raw_words(F.col("text")), folded)
    n = F.size("words")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), n - (window - 1))))
    return (
        benchmark.select("item_id", words.alias("words"))
        .select("item_id", "words", F.explode(starts).alias("start"))
        .groupBy(F.slice("words", F.col("start"), F.lit(window)).alias("window"))
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
        .withColumn("length", F.size("window"))
    )


def _tokens(docs: DataFrame, *keep: str) -> DataFrame:
    """All words of all texts: position, folded word, and the whole text's words for what follows.

    The outer form stops the optimiser from testing for empty arrays first,
    for which it would take all texts apart twice.
    """
    return docs.select(*keep, raw_words(F.col("text")).alias("raw")).select(
        *keep, "raw", F.posexplode_outer("raw").alias("pos", "word")
    ).withColumn("word", folded(F.col("word")))


def rarest_words(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Each window with its rarest word in ``docs`` and that word's first place in it.

    All the window's words must be found, so a prefix of one word, in order of
    rarity over all documents, is necessary. Windows with a word that no
    document has are left out.
    """
    vocabulary = settle(windows.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    counts = _tokens(docs).select("word").join(vocabulary, "word", "left_semi").groupBy("word").count()
    counts = settle(counts, "rarity")
    words = windows.select(
        "window", "items", "length", F.posexplode("window").alias("place", "word")
    ).join(counts, "word", "left")
    rarity = F.struct(F.coalesce("count", F.lit(0)).alias("count"), F.col("word"), F.col("place"))
    return (
        words.groupBy("window", "items", "length").agg(F.min(rarity).alias("rare"))
        .filter("rare.count > 0")
        .select("window", "items", "length", F.col("rare.word").alias("word"), F.col("rare.place").alias("place"))
    )


def _with_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, __text, raw, pos, word): the places of the ``wanted`` words, with the text's words.

    Few words are broadcast, by their count, and the text stays where it is.
    Many meet the places alone, a word and its position; the places of a text
    come together again and fetch it once.
    """
    if wanted.count() <= MOST_BROADCAST_WORDS:
        return _tokens(docs, "doc_id", "__text").join(F.broadcast(wanted), "word", "left_semi")
    places = (
        _tokens(docs, "doc_id", "__text").select("doc_id", "__text", "pos", "word")
        .join(wanted, "word", "left_semi")
        .groupBy("doc_id", "__text").agg(F.collect_set(F.struct("pos", "word")).alias("places"))
        .withColumnsRenamed({"doc_id": "__of_doc", "__text": "__of_text"})
    )
    rows = docs.select("doc_id", "__text", "text").join(places, F.expr("doc_id <=> __of_doc AND __text <=> __of_text"))
    return rows.select(
        "doc_id", "__text", raw_words(F.col("text")).alias("raw"), F.explode("places").alias("place")
    ).select("doc_id", "__text", "raw", "place.pos", "place.word")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` with its words inside benchmark windows, ``__hit``, and ``__items`` found; else NULL.

    A window is ``window`` words of an item in sequence, or a shorter item
    whole. Words of documents are joined with the windows' rarest words alone;
    the windows are no larger than the benchmark, and Spark broadcasts their
    words where its size threshold allows. A candidate is a place, its distance
    to the window's start and end bounds it within the text, and the words
    around it must equal the window in order. Candidates of one word come as
    one array, so that a frequent word doesn't multiply rows.

    NULL and empty texts have no words and no hits, as have items without
    words; items with a NULL id are found but not listed. Rows are told apart by
    doc_id, which may be NULL, and a hash of the text; equal rows have equal
    hits. Extra columns are returned as they are, but for those that are named
    like the two added; columns __text, __doc and __same are replaced. An empty
    table on either side gives no hits.
    """
    windows = settle(rarest_words(docs, settle(item_windows(benchmark, window), "windows")), "rarest")
    # A word that is the rarest of very many windows has several rows, and so its windows several arrays.
    parts = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("word")) / WINDOWS_AT_ONCE)
    by_word = windows.withColumn("__part", F.pmod(F.xxhash64("window"), parts)).groupBy("word", "__part").agg(
        F.collect_list(F.struct("place", "length", "window", "items")).alias("__windows")
    )
    by_word = settle(by_word.drop("__part"), "by-word")
    longest = window  # no window is longer, so the words around a place are enough
    around = F.slice("raw", F.greatest(F.lit(1), F.col("pos") + 2 - longest), F.lit(2 * longest - 1))
    at = F.least(F.col("pos"), F.lit(longest - 1))
    keyed = docs.drop("__hit", "__items", "__doc", "__same").withColumn("__text", F.xxhash64("text"))
    rare = settle(by_word.select("word").distinct(), "rare-words")
    found = (
        _with_words(keyed, rare)
        .select("doc_id", "__text", "word", "pos", at.alias("at"), F.transform(around, folded).alias("around"))
        .join(by_word, "word")
    )
    fits = F.filter(
        "__windows",
        lambda w: (w["place"] <= F.col("at"))
        & (F.slice("around", F.col("at") - w["place"] + 1, w["length"]) == w["window"]),
    )
    hits = (
        found.select("doc_id", "__text", "pos", fits.alias("fits"))
        .filter(F.size("fits") > 0)
        .groupBy("doc_id", "__text")
        .agg(
            F.flatten(F.collect_list(F.transform("fits", lambda w: F.struct(
                (F.col("pos") - w["place"]).alias("start"), w["length"].alias("length"))))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(
                F.array_distinct(F.flatten(F.transform("fits", lambda w: w["items"]))))))).alias("__items"),
        )
    )
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    hits = hits.select(
        F.col("doc_id").alias("__doc"), F.col("__text").alias("__same"),
        F.size(F.array_distinct(places)).cast("long").alias("__hit"), "__items",
    )
    match = F.expr("doc_id <=> __doc AND __text <=> __same")
    return keyed.join(hits, match, "left").drop("__doc", "__same", "__text")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    found = contamination(held(docs, "doc_id", "text"), benchmark, window)
    return released(found.filter(F.col("__hit").isNull()), docs)


SQL = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(words[start:start + {WINDOW - 1}], ' ') AS gram, least(len(words), {WINDOW}) AS n
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - {WINDOW - 2}))) AS start
        FROM b WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, start, n, array_to_string(words[start:start + n - 1], ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS start FROM w, lengths)),
found AS (SELECT doc_id, start, n, item_id FROM grams JOIN windows USING (n, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + n)) AS pos FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_decontaminate", SQL)
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_words", F.size(raw_words(F.col("text"))).cast("long"))
    found = contamination(docs, table(spark, folder, "benchmark"))
    items = F.coalesce(F.col("__items"), F.array().cast("array<string>"))
    return found.select(
        "doc_id", "n_words", F.coalesce("__hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("__hit").isNotNull().alias("contaminated"),
    )
