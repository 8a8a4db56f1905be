"""Toxicity by two class-conditional Kneser-Ney bigram models, compared over every word of a text."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import class_models
from barloom.session import stage

DISCOUNT = 0.75
# Evidence (log-likelihood-ratio statistic of document counts) from which a word or bigram is listed
# among a model's telling terms; scores use all of them.
EVIDENCE = 30.0
# Smallest ratio of the two class probabilities of a listed term, as a logarithm.
CONTRAST = math.log(4)
# Rows of a table up to which it is broadcast; above it both sides are shuffled, with the same result.
BROADCAST_ROWS = 200_000
# Labels up to which they are broadcast to the documents; above it both sides are shuffled.
BROADCAST_LABELS = 250_000
# Differences of texts up to which they are broadcast to the documents.
BROADCAST_TEXTS = 500_000
# Log ratios of the telling terms are whole multiples of this.
UNIT = 1e-9
# Entries that a task folds or holds before it hands them on.
ENTRIES_OUT = 400_000
# Length-normalised differences are told apart in steps of this size when the threshold is learnt.
STEP = 1e-5
# Partitions over which the followers of a context of up to SHORT letters are dealt.
SHORT, PARTS = 3, 64
FOLDED = "before string, part int, words string, toxic array<int>, ordinary array<int>"
EMPTY = ""  # the context before the first word
WORD = " "  # in place of a context: the count of a word itself

_WORDS = regex.compile(r"[\p{L}\p{N}\p{M}]+").findall


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


@dataclass(frozen=True)
class Model:
    """Both class models (none if a class has no text) and the learnt threshold of their difference.

    ``found`` has (print, difference) of all texts given to learn from, labelled or not.
    """

    models: class_models.Models | None
    threshold: float
    slope: float
    texts: DataFrame | None = None
    found: DataFrame | None = None

    @cached_property
    def terms(self) -> DataFrame | None:
        """(term, ratio): what tells the classes apart most, for the reader; scores do not use it.

        Ratios are in multiples of UNIT: a word's, or, for two words and a blank between, what their
        bigram adds to the second word's. Worked out when asked for, from all the texts learnt.
        """
        if self.texts is None:
            return None
        counts = stage(_gathered(self.texts.mapInArrow(_counts, FOLDED)), "counts")
        return stage(_terms(counts, _sizes(self.texts)), "terms")

    @property
    def words(self) -> Iterator[str]:
        """The words among the terms, streamed from the table."""
        if self.terms is not None:
            for row in self.terms.filter("NOT contains(term, ' ')").select("term").toLocalIterator():
                yield row["term"]


def learnable(id_col: str = "doc_id", folds: int = 5, held_out: int = 0) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held_out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit both class models on all given labelled documents; Spark takes the counts over all of them.

    Each distinct text counts once, with the label of its smallest id, and each bigram once per text,
    so that copies and repetitions carry no more weight than one use. All bigrams of all words are
    counted and every one has its weight: see ``class_models.log_ratio``. Rows with a null id, label or
    text teach nothing, repeated rows of the chosen id teach as often; without both classes nothing is
    toxic.
    """
    chosen = _chosen(docs, labels, id_col, text_col, label_col)
    texts = _texts(docs, chosen, id_col, text_col)
    if len(_sizes(texts)) < 2:
        return Model(None, 0.5, 1.0)
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0]
    models = class_models.learn(texts, chars, words_of)
    kind = F.when(F.md5("text") == F.col("print"), F.when(F.col("toxic"), 2).otherwise(1)).otherwise(0)
    marked = _rows(docs, id_col, text_col).join(chosen, "id", "left").select("text", kind.alias("class"))
    # One pass over all texts, labelled or not: their bigrams are shuffled once for both uses.
    found = stage(class_models.differences(marked, models, words_of), "differences")
    return _with_threshold(texts, models, found)


def _sizes(texts: DataFrame) -> dict[bool, int]:
    return {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")


def _chosen(docs, labels, id_col, text_col, label_col) -> DataFrame:
    """(id, toxic, print): the row that stands for each distinct labelled text."""
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("toxic")) \
        .filter("id IS NOT NULL AND toxic IS NOT NULL")
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    prints = _rows(docs, id_col, text_col).join(known, "id").select("id", "toxic", F.md5("text").alias("print"))
    once = stage(prints.groupBy("print").agg(F.min(F.struct("id", "toxic")).alias("one"))
                 .select("one.id", "one.toxic", "print").dropDuplicates(["id"]), "once")
    return F.broadcast(once) if once.count() <= BROADCAST_LABELS else once


def _texts(docs, chosen, id_col, text_col) -> DataFrame:
    # Read anew by each pass: a copy of the texts would cost more than the reading.
    return (_rows(docs, id_col, text_col).join(chosen, "id")
            .filter(F.md5("text") == F.col("print")).select("text", "toxic"))


def _training_texts(docs, labels, id_col, text_col, label_col) -> DataFrame:
    """(text, toxic): each distinct labelled text once."""
    return _texts(docs, _chosen(docs, labels, id_col, text_col, label_col), id_col, text_col)


def _gathered(folded: DataFrame) -> DataFrame:
    """(before, word, toxic, ordinary) from the lists of followers, which are shuffled as they are.

    A list names its context once and holds its words as one text, which is a third of a row for each;
    after that a context's followers are in one partition, or those of a short one in PARTS, and are
    added up there.
    """
    words = F.split("words", " ").alias("words")
    follower = F.explode(F.arrays_zip(words, "toxic", "ordinary")).alias("f")
    return (folded.repartition("before", "part").select("before", "part", follower)
            .groupBy("before", "part", F.col("f.words").alias("word"))
            .agg(F.sum("f.toxic").alias("toxic"), F.sum("f.ordinary").alias("ordinary")).drop("part"))


def _part(before: str, word: str) -> int:
    """Short words are the common ones, as contexts too: their followers are dealt over PARTS."""
    return zlib.crc32(word.encode()) % PARTS if len(before) <= SHORT else 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a word (WORD before it) or a bigram, folded over runs of texts.

    A row holds followers of one context, with their counts.
    """
    def folded(counts: dict[str, dict[str, int]]) -> pa.RecordBatch:
        lists: dict[tuple[str, int], list[str]] = {}
        for before, held in counts.items():
            for word in held:
                lists.setdefault((before, _part(before, word)), []).append(word)
        ends = np.append(0, np.cumsum([len(words) for words in lists.values()])).astype(np.int32)
        for held in lists.values():
            held.sort()  # neighbours that begin alike compress well
        words = [" ".join(held) for held in lists.values()]
        uses = np.fromiter((counts[key[0]][w] for key, held in lists.items() for w in held),
                           np.int64, int(ends[-1]))
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in lists], pa.string()), pa.array([k[1] for k in lists], pa.int32()),
             pa.array(words, pa.string()),
             *(pa.ListArray.from_arrays(ends, pa.array(part.astype(np.int32)))
               for part in (uses >> 32, uses & 0xFFFFFFFF))],
            names=["before", "part", "words", "toxic", "ordinary"])

    # Both counts in one number, toxic ones in its high half.
    counts: dict[str, dict[str, int]] = {}
    entries = 0
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1)):
            words, one = words_of(text.as_py()), 1 << 32 if toxic.as_py() else 1
            for before, word in {*zip([EMPTY, *words], words), *((WORD, w) for w in words)}:
                held = counts.setdefault(before, {})
                uses = held.get(word)
                entries += uses is None
                held[word] = (uses or 0) + one
            if entries >= ENTRIES_OUT:
                yield folded(counts)
                counts, entries = {}, 0
    if counts:
        yield folded(counts)


def _evidence(size: dict[bool, int]) -> Column:
    """Twice the log-likelihood ratio of 'the share of texts is the same in both classes'."""
    t, o = F.col("toxic").cast("double"), F.col("ordinary").cast("double")
    n_t, n_o = float(size[True]), float(size[False])
    both = (t + o) / (n_t + n_o)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(t, both * n_t) + part(o, both * n_o)
                + part(n_t - t, (1 - both) * n_t) + part(n_o - o, (1 - both) * n_o))


def _sized(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _terms(counts: DataFrame, size: dict[bool, int]) -> DataFrame:
    """(term, ratio) of the words and bigrams that tell the classes apart; see ``Model``."""
    n_t, n_o = float(size[True]), float(size[False])
    contrast = F.abs(F.log(((F.col("toxic") + DISCOUNT) / (n_t + DISCOUNT))
                           / ((F.col("ordinary") + DISCOUNT) / (n_o + DISCOUNT))))
    evident = counts.filter(_evidence(size) >= EVIDENCE)
    telling = stage(evident.filter((F.col("before") == WORD) & (contrast >= CONTRAST))
                    .select("word"), "telling")
    bigrams = counts.filter("before <> ' '")
    chosen = stage(evident.filter("before <> ' '"), "chosen")
    whole = counts.agg(*(F.count(F.when(F.expr(which), 1)).alias(name) for name, which in (
        ("n", "before <> ' '"), ("n_toxic", "before <> ' ' AND toxic > 0"),
        ("n_ordinary", "before <> ' ' AND ordinary > 0"),
        ("types_toxic", "before = ' ' AND toxic > 0"),
        ("types_ordinary", "before = ' ' AND ordinary > 0")))).first()
    classes = ("toxic", "ordinary")

    def distinct(name: str) -> list[Column]:
        return [F.count(F.when(F.col(c) > 0, 1)).alias(f"{name}_{c}") for c in classes]

    def share(c: str) -> Column:
        shared = F.col("n") / float(max(whole["n"], 1))
        if not whole[f"n_{c}"]:
            return shared
        own = F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0.0))
        return (own + DISCOUNT * whole[f"types_{c}"] * shared) / float(whole[f"n_{c}"])

    asked = telling.union(chosen.select("word")).distinct()
    words = stage(bigrams.join(_sized(asked), "word", "left_semi").groupBy("word")
                  .agg(F.count("*").alias("n"), *distinct("n"))
                  .select("word", *(share(c).alias(f"share_{c}") for c in classes)), "shares")
    ratio = F.log(F.col("share_toxic") / F.col("share_ordinary"))
    held = stage(words.join(_sized(telling), "word", "left_semi")
                 .select("word", F.round(ratio / UNIT).cast("long").alias("ratio"))
                 .filter(F.abs("ratio") >= CONTRAST / UNIT), "held")

    contexts = (bigrams.join(_sized(chosen.select("before").distinct()), "before", "left_semi")
                .groupBy("before").agg(*(F.sum(c).alias(f"uses_{c}") for c in classes),
                                       *distinct("after")))
    p = {c: F.when(F.col(f"uses_{c}") > 0, (
        F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
        + DISCOUNT * F.col(f"after_{c}") * F.col(f"share_{c}")) / F.col(f"uses_{c}"))
        .otherwise(F.col(f"share_{c}")) for c in classes}
    own = F.round(F.log(p["toxic"] / p["ordinary"]) / UNIT).cast("long")
    pairs = (chosen.join(contexts, "before").join(words, "word").withColumn("own", own)
             .filter(F.abs("own") >= CONTRAST / UNIT).join(held, "word", "left")
             .select(F.concat_ws(" ", "before", "word").alias("term"),
                     (F.col("own") - F.coalesce("ratio", F.lit(0))).alias("ratio")))
    return held.withColumnRenamed("word", "term").union(pairs)


def _with_threshold(texts: DataFrame, models: class_models.Models, found: DataFrame) -> Model:
    """The backoff, and threshold on its difference per word, that err least on the training texts.

    Each is judged by the counts of all the others.
    """
    bounded = F.greatest(F.least("left_out", F.lit(20.0)), F.lit(-1.0))
    counts = (found.filter("class > 0").groupBy("backoff", F.floor(bounded / STEP).alias("at")).agg(
        F.count(F.when(F.col("class") == 2, 1)).alias("t"),
        F.count(F.when(F.col("class") == 1, 1)).alias("o")).orderBy("at").collect())
    if not counts:
        return Model(None, 0.5, 1.0)
    tried = []
    for k, backoff in enumerate(models.backoffs):
        rows = [r for r in counts if r["backoff"] == k]
        at = np.array([r["at"] for r in rows])
        toxic, ordinary = (np.array([r[c] for r in rows], dtype=float) for c in ("t", "o"))
        # Errors of 'toxic from bin j on': toxic texts below, ordinary ones from there.
        errors = np.append(0, np.cumsum(toxic)) + np.append(np.cumsum(ordinary[::-1])[::-1], 0)
        best = int(np.argmin(errors))
        low = at[best - 1] + 1 if best else at[0]
        high = at[best] if best < len(at) else low + 1
        tried.append((errors[best], k, backoff, max((low + high) / 2, 0.5) * STEP))
    _, k, backoff, threshold = min(tried)
    known = found.filter(F.col("backoff") == k).select("print", "difference").dropDuplicates(["print"])
    return Model(replace(models, backoffs=(backoff,)), float(threshold), math.log(9) / float(threshold), texts,
                 stage(known, "known"))


def _few(prints: DataFrame) -> DataFrame:
    return F.broadcast(prints) if prints.count() <= BROADCAST_TEXTS else prints


def score(docs: DataFrame, model: Model, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with the chance of being toxic in ``score_col`` (0 to 1; 0.5 is the threshold).

    Whole texts are scored; null, empty and wordless ones have no difference, which lies below the
    threshold. All rows and other columns stay; a column named ``score_col`` is replaced.
    """
    if model.models is None:
        return docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != score_col),
                           F.lit(1 / (1 + math.exp(model.slope * model.threshold))).alias(score_col))
    found, text = model.found, F.col(f"`{text_col}`").alias("text")
    prints = docs.select(text).filter("text <> ''").select(F.unhex(F.md5("text")).alias("print"))
    fresh = stage(prints.join(_few(found), "print", "left_anti").distinct(), "fresh")
    if not fresh.isEmpty():
        texts = docs.select(text).filter("text <> ''").join(
            _few(fresh), F.unhex(F.md5("text")) == F.col("print"), "left_semi").select("text", F.lit(0).alias("class"))
        found = stage(found.union(class_models.differences(texts, model.models, words_of)
                                  .select("print", "difference").dropDuplicates(["print"])), "differences")
    mark = "print"
    while mark.lower() in {c.lower() for c in docs.columns}:
        mark += "_"
    # The digest is a column before the join, so that texts nobody asks for are not shuffled.
    marked = docs.withColumn(mark, F.unhex(F.md5(F.col(f"`{text_col}`")))).alias("docs")
    steep = model.slope * (F.coalesce("found.difference", F.lit(0.0)) - model.threshold)
    return (marked.join(_few(found).alias("found"), F.col(f"docs.`{mark}`") == F.col("found.print"), "left")
            .select(*(F.col(f"docs.`{c}`") for c in docs.columns if c != score_col),
                    (1 / (1 + F.exp(-F.greatest(F.least(steep, F.lit(500.0)), F.lit(-500.0))))).alias(score_col)))
