"""Benchmark decontamination as a prefix-filtered join of word windows, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are runs of digits, letters and everything outside ASCII, A-Z lowered.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
GRAM = 3
# Rows of a benchmark side that are broadcast at once (some 50 MB). More tokens are searched for in
# several passes, more windows by a shuffled join; the result is the same.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER),
                                  BETWEEN_WORDS), "")


def _gram_tokens(words: Column, size: int) -> Column:
    """A hash per position of the ``size`` words that begin there."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))),
        lambda word, k: F.xxhash64(word, *(F.get(words, k + j) for j in range(1, size))))


def _sized(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  min_percent: int = 5, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row per row of ``docs``.

    An item's windows are its runs of ``window`` words, or all its words where it has fewer but some.
    Words of a document inside any occurrence of a window are hit; ``items`` lists, as sorted strings,
    the items with an occurring window. A document is contaminated if 100 x ``n_hit`` is at least
    ``min_percent`` x its words, and not 0.

    The join runs on one necessary token per window: its word triple that is rarest in the
    documents, counted over all of them (a window with a triple that no document has drops out).
    A token's place in the document must leave room for the window before and after it; what is left
    is compared word by word with the window. Documents are keyed by a digest of their text, so
    copies share their candidates and an id may be null or repeated.

    Null, empty and wordless texts have no words and are not contaminated; such items have no window.
    Items that are null in ``item_col`` hit words but are not listed. Repeated items and rows change
    nothing but the number of rows; other columns are ignored; an empty side gives no hits.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = stage(_windows(benchmark.select(
        F.col(item_col).cast("string").alias("item"),
        F.col(item_text_col).cast("string").alias("text")), window), "item_windows")
    windows = items.groupBy("window").agg(F.first("words").alias("words"))
    grams = stage(_window_grams(windows), "window_grams")
    hits = stage(_token_hits(rows, grams, window), "token_hits")
    needed = stage(_rarest_tokens(grams, hits), "needed")

    found = stage(_occurrences(hits, _sized(needed), window), "occurrences")
    covered = F.array_distinct(F.flatten(F.transform(
        "places", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1))))
    hit = found.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("places")) \
        .select("key", F.size(covered).cast("long").alias("n_hit"))
    listed = (found.select("key", "window").distinct()
              .join(items.select("window", "item").filter("item IS NOT NULL").distinct(), "window")
              .groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    per_text = stage(hit.join(listed, "key", "left"), "per_text")
    counted = rows.select("doc_id", F.md5("text").alias("key"),
                          F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    enough = 100 * F.col("n_hit") >= min_percent * F.col("n_words")
    return (counted.join(per_text, "key", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", none).alias("items"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    "items", ((F.col("n_hit") > 0) & enough).alias("contaminated")))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(item, words, window): every run of words to look for; ``window`` is the words as one text."""
    words = items.select("item", words_of(F.col("text")).alias("all")).filter("size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    return (words.select("item", "all", F.explode(starts).alias("start"))
            .select("item", F.slice("all", F.col("start") + 1, window).alias("words"))
            .withColumn("window", F.array_join("words", " ")))


def _window_grams(windows: DataFrame) -> DataFrame:
    """(window, length, size, offset, token): the word triples of each window, or all its words."""
    sized = windows.withColumn("size", F.least(F.size("words"), F.lit(GRAM)))
    parts = []
    for size in range(1, GRAM + 1):
        parts.append(sized.filter(F.col("size") == size).select(
            "window", F.size("words").alias("length"), "size",
            F.posexplode(_gram_tokens(F.col("words"), size)).alias("offset", "token")))
    return parts[0].union(parts[1]).union(parts[2])


def _token_hits(rows: DataFrame, grams: DataFrame, window: int) -> DataFrame:
    """(key, n_words, size, at, token, before, around): benchmark tokens in documents.

    ``around`` holds the words from ``before`` words ahead of the token to a window's length after it,
    so that no later step needs the text. The tokens are broadcast in parts of BROADCAST_ROWS; the
    documents are read once per part, and never shuffled.
    """
    tokens = stage(grams.select("size", "token").distinct(), "tokens")
    sizes = tokens.groupBy("size").count().collect()  # at most GRAM rows
    worded = rows.select(F.md5("text").alias("key"), words_of(F.col("text")).alias("words"))
    before = F.least(F.col("at"), F.lit(window - 1))
    found = None
    for size, held in sorted((r["size"], r["count"]) for r in sizes) or [(GRAM, 0)]:
        n_parts = -(-held // BROADCAST_ROWS) or 1
        placed = worded.select("key", "words", F.posexplode(_gram_tokens(F.col("words"), size))
                               .alias("at", "token"))
        for part in range(n_parts):
            some = tokens.filter((F.col("size") == size) &
                                 (F.pmod(F.xxhash64("token"), F.lit(n_parts)) == part))
            hits = placed.join(F.broadcast(some.select("token")), "token").select(
                "key", F.size("words").alias("n_words"), F.lit(size).alias("size"), "at", "token",
                before.alias("before"),
                F.slice("words", F.col("at") - before + 1, 2 * window - 1).alias("around"))
            found = hits if found is None else found.union(hits)
    return found


def _rarest_tokens(grams: DataFrame, hits: DataFrame) -> DataFrame:
    """(window, length, size, offset, token): the token of each window with the fewest hits."""
    frequency = stage(hits.groupBy("size", "token").agg(F.count("*").alias("hits")), "frequency")
    return (grams.join(frequency, ["size", "token"], "left")
            .groupBy("window").agg(
                F.count(F.when(F.col("hits").isNull(), 1)).alias("absent"),
                F.min(F.struct("hits", "token", "offset", "length", "size")).alias("best"))
            .filter("absent = 0").select("window", "best.length", "best.size", "best.offset",
                                         "best.token"))


def _occurrences(hits: DataFrame, needed: DataFrame, window: int) -> DataFrame:
    """(key, start, length, window): where a window stands word for word."""
    start = F.col("at") - F.col("offset")
    seen = F.array_join(F.slice("around", F.greatest(F.col("before") - F.col("offset"), F.lit(0)) + 1,
                                F.col("length")), " ")
    return (hits.join(needed, ["token", "size"])
            .filter((start >= 0) & (start + F.col("length") <= F.col("n_words"))
                    & (F.col("offset") <= F.col("before")) & (seen == F.col("window")))
            .select("key", start.cast("int").alias("start"), "length", "window").distinct())
