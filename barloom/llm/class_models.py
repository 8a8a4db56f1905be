"""Two class-conditional Kneser-Ney bigram models over all words, and texts compared under both.

Words are the ranks of their 64-bit hashes in the sorted vocabulary of the texts learnt from, so that
a bigram is one whole number; words not learnt share one rank. Bigrams are counted, and the bigrams of
the texts to be scored are looked up, in buckets that Spark shuffles. A row of a bucket holds sorted
arrays, each packed into one binary value. What is broadcast is the vocabulary and six counts a word.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

# Discount where no count of one or of two tells how far counts are to be lowered.
DISCOUNT = 0.75
# Strengths of the backoff to the word's own probability, as shares of all uses of the class: in a
# context with that share, the bigram and the word have equal say. The training texts choose one.
BACKOFFS = (0.01, 0.1)
# Weight of the toxic class's own estimates; the rest is the ordinary model, which a toxic text
# follows too but for a few expressions.
WEIGHT = 0.01
# Log ratios are added as whole multiples of this, so that the order of adding changes nothing.
GRAIN = 1e-6
# Characters of the texts that are split into words at once, and of those counted in one bucket.
PIECE, BUCKET = 1 << 19, 12_000_000
# Uses of bigrams that a task holds before it hands them on.
ENTRIES_OUT = 500_000
# The word of a bigram, which is the rank of the word before it, shifted by 32, and the word's rank.
WORD = (1 << 32) - 1
# The class of a text stands above its place in the chunk.
CLASS = 24
PLACE = (1 << CLASS) - 1
FOUND_WORDS = "bucket int, keys binary, c0 binary"
COUNTED = "bucket int, keys binary, c0 binary, c1 binary"
SUMMED = "bucket int, keys binary, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary"
ASKED = "bucket int, chunk long, keys binary, codes binary, uses binary"
ANSWERED = "chunk long, prints binary, codes binary, sums binary"
FOUND = "print binary, class int, backoff int, difference double, left_out double"


def pack(values: np.ndarray, signed: bool = False) -> bytes:
    """Whole numbers in few bytes: by byte planes, compressed; small ones of either sign if ``signed``."""
    values = values.astype(np.int64)
    coded = (values << 1) ^ (values >> 63) if signed else values
    planes = np.ascontiguousarray(coded.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    width = max((k + 1 for k in range(8) if planes[k].any()), default=0)
    body = pa.compress(planes[:width].tobytes(), codec="zstd", asbytes=True)
    return struct.pack("<qqB", len(values), len(body), width) + body


def _unpack(packed: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The numbers packed from ``at`` on, and where they end."""
    n, size, width = struct.unpack_from("<qqB", packed, at)
    low = at + struct.calcsize("<qqB")
    planes = np.zeros((8, n), np.uint8)
    body = pa.decompress(packed[low:low + size], n * width, codec="zstd", asbytes=True)
    planes[:width] = np.frombuffer(body, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8").astype(np.int64), low + size


def unpack(packed: bytes, signed: bool = False) -> np.ndarray:
    coded = _unpack(packed)[0]
    return ((coded >> 1) & np.int64((1 << 63) - 1)) ^ -(coded & 1) if signed else coded


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.int64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed))


def _steps(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Each value less the one before, or itself where a run begins."""
    return np.where(fresh, values, np.diff(values, prepend=np.int64(0)))


def _from_steps(steps: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    total, starts = np.cumsum(steps), np.flatnonzero(fresh)
    return total - np.repeat(total[starts] - steps[starts], np.diff(np.append(starts, len(steps))))


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    first = np.zeros(len(columns[0]), bool)
    for values in columns:
        first |= np.diff(values, prepend=np.int64(-1)) != 0
    return first


def pack_pairs(pairs: np.ndarray, docs: np.ndarray | None = None) -> bytes:
    """Sorted bigrams, which may repeat; ``docs`` ascend among equal ones."""
    before, word = pairs >> 32, pairs & WORD
    packed = pack_sorted(before) + pack(_steps(word, _fresh(before)))
    return packed if docs is None else packed + pack(_steps(docs, _fresh(pairs)))


def unpack_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    steps, at = _unpack(packed)
    before = np.cumsum(steps)
    steps, at = _unpack(packed, at)
    pairs = before << 32 | _from_steps(steps, _fresh(before))
    return pairs, _from_steps(_unpack(packed, at)[0], _fresh(pairs)) if at < len(packed) else None


def _buckets_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """Common words are common after each other: no word has a bucket of its own."""
    return (((pairs >> 32) * 7919 + ((pairs & WORD) >> 8)) % buckets).astype(np.int32)


def _rows(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


@dataclass(frozen=True)
class Words:
    """The words learnt, as sorted hashes, and their ranks by frequency, which leaves bigrams short.

    ``other`` stands for all other words, ``start`` for no word. ``uses``, packed, has how often each
    is used. Broadcast packed: every machine keeps a copy on disk.
    """

    hashes: np.ndarray
    uses: bytes

    def __reduce__(self):
        return _words, (pack_sorted(self.hashes), self.uses)

    @cached_property
    def frequency(self) -> np.ndarray:
        ranks = np.empty(len(self.hashes), np.int32)
        ranks[np.argsort(-unpack(self.uses), kind="stable")] = np.arange(len(ranks), dtype=np.int32)
        return ranks

    @property
    def other(self) -> int:
        return len(self.hashes)

    @property
    def start(self) -> int:
        return len(self.hashes) + 1

    @property
    def base(self) -> int:
        return len(self.hashes) + 2

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.frequency[at], self.other)

    def bigrams(self, ranks: np.ndarray) -> np.ndarray:
        return np.concatenate(([self.start], ranks[:-1])) << 32 | ranks


def _words(hashes: bytes, uses: bytes) -> Words:
    return Words(unpack_sorted(hashes), uses)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int]]]:
    """(texts, classes) of up to PIECE characters, or of one longer text."""
    texts, classes, size = [], [], 0
    for batch in batches:
        for text, kind in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            if texts and size + len(text) > PIECE:
                yield texts, classes
                texts, classes, size = [], [], 0
            texts.append(text)
            classes.append(kind.as_py())
            size += len(text)
    if texts:
        yield texts, classes


def _hashed(texts: list[str], words_of: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, each word's place among them, and where each text ends."""
    flat, ends = [], [0]
    for text in texts:
        flat += words_of(text)
        ends.append(len(flat))
    coded = pa.array(flat, pa.string()).dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(distinct.astype(object), categorize=False)
    return hashes.view(np.int64), coded.indices.to_numpy(), np.array(ends)


def _segments(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for low, high in zip(starts, [*starts[1:], len(bucket)]):
        yield int(bucket[low]), slice(low, high)


def _vocabulary(texts: DataFrame, words_of: Callable) -> Words:
    """All distinct words of the texts, gathered and counted by Spark in ranges of hashes."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            words, place = np.unique(np.concatenate([held, *(h for h, _ in waiting)]), return_inverse=True)
            return words, np.bincount(place, np.concatenate([n, *(c for _, c in waiting)]),
                                      len(words)).astype(np.int64)
        for piece, _ in _pieces(batches):
            hashes, places, _ = _hashed(piece, words_of)
            waiting.append((hashes, np.bincount(places, minlength=len(hashes))))
            size += len(hashes)
            if size > ENTRIES_OUT:
                (held, n), waiting, size = folded(), [], 0
        held, n = folded()
        rows = [(k, pack_sorted(held[at]), pack(n[at])) for k, at in _segments((held >> 58) + 32)]
        if rows:
            yield _rows([list(c) for c in zip(*rows)], _arrow(FOUND_WORDS))

    rows = (texts.mapInArrow(found, FOUND_WORDS).repartition(64, "bucket").groupBy("bucket")
            .applyInArrow(_sums(FOUND_WORDS, pack_sorted, unpack_sorted), FOUND_WORDS).collect())
    rows.sort(key=lambda r: r["bucket"])
    none = [np.empty(0, np.int64)]
    hashes = np.concatenate(none + [unpack_sorted(bytes(r["keys"])) for r in rows])
    return Words(hashes, pack(np.concatenate(none + [unpack(bytes(r["c0"])) for r in rows])))


def _sums(ddl: str, packed: Callable, unpacked: Callable) -> Callable[[pa.Table], pa.Table]:
    """Rows of one bucket folded into one: equal keys' values are added."""
    schema = _arrow(ddl)

    def summed(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpacked(k.as_py()) for k in table["keys"]])
        held, place = np.unique(keys, return_inverse=True)
        values = []
        for name in schema.names[2:]:
            part = np.concatenate([unpack(v.as_py()) for v in table[name]])
            values.append([pack(np.bincount(place, part, len(held)).astype(np.int64))])
        return pa.Table.from_batches([_rows([[table["bucket"][0].as_py()], [packed(held)], *values], schema)])
    return summed


def _pairs_alone(packed: bytes) -> np.ndarray:
    return unpack_pairs(packed)[0]


def _counts(texts: DataFrame, words, buckets: int, words_of: Callable) -> DataFrame:
    """(bucket, keys, toxic, ordinary): in how many texts of each class every bigram stands."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value

        def folded(held: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            toxic = np.where(keys & 1, n, 0)
            pairs, place = np.unique(keys >> 1, return_inverse=True)
            t = np.bincount(place, toxic, len(pairs)).astype(np.int64)
            o = np.bincount(place, n, len(pairs)).astype(np.int64) - t
            bucket = _buckets_of(pairs, buckets)
            order = np.argsort(bucket, kind="stable")
            rows = [(k, pack_pairs(pairs[order[at]]), pack(t[order[at]]), pack(o[order[at]]))
                    for k, at in _segments(bucket[order])]
            return _rows([list(c) for c in zip(*rows)], _arrow(COUNTED))

        held, size = [], 0
        for piece, classes in _pieces(batches):
            hashes, places, ends = _hashed(piece, words_of)
            ranks = known.ranks(hashes)[places]
            for k, kind in enumerate(classes):
                if ends[k] < ends[k + 1]:
                    held.append(np.unique(known.bigrams(ranks[ends[k]:ends[k + 1]])) << 1 | (kind == 1))
                    size += len(held[-1])
            if size >= ENTRIES_OUT:
                yield folded(held)
                held, size = [], 0
        if held:
            yield folded(held)
    return (texts.mapInArrow(counted, COUNTED).repartition(buckets, "bucket")
            .groupBy("bucket").applyInArrow(_sums(COUNTED, pack_pairs, _pairs_alone), COUNTED))


@dataclass(frozen=True)
class Sides:
    """What each class's model needs of single words; arrays by class (toxic, ordinary) and rank.

    ``uses`` and ``after``: texts' uses of the word as a context and its distinct followers;
    ``contexts``: the distinct words before it. Broadcast packed, as the words are.
    """

    uses: tuple[np.ndarray, np.ndarray]
    after: tuple[np.ndarray, np.ndarray]
    contexts: tuple[np.ndarray, np.ndarray]
    discounts: tuple[tuple[float, float], ...]  # by class: of contexts, of bigrams
    totals: tuple[tuple[float, float, float], ...]  # distinct bigrams, words with a context, all uses
    size: int  # words learnt, and one for all others

    def __reduce__(self):
        packed = tuple(pack(values) for values in (*self.uses, *self.after, *self.contexts))
        return _packed_sides, (packed, self.discounts, self.totals, self.size)


def _packed_sides(packed: tuple[bytes, ...], *rest) -> Sides:
    values = [unpack(part).astype(np.int32) for part in packed]
    return Sides(*zip(values[::2], values[1::2]), *rest)


def _discount(ones: float, twos: float) -> float:
    return ones / (ones + 2 * twos) if ones and twos else DISCOUNT


def _sides(counts: DataFrame, known: Words, buckets: int) -> Sides:
    base = known.base
    span = -(-(base + 4) // buckets)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                pairs, *n = (read(batch.column(k)[row].as_py())
                             for k, read in ((1, _pairs_alone), (2, unpack), (3, unpack)))
                # Four ranks behind the last word take how many bigrams have one use and two uses.
                ids, place = np.unique(np.concatenate([pairs >> 32, pairs & WORD]), return_inverse=True)
                first, second = place[:len(pairs)], place[len(pairs):]
                columns = []
                for c in (0, 1):
                    seen = n[c] > 0
                    columns += [np.bincount(first, n[c], len(ids)), np.bincount(first[seen], minlength=len(ids)),
                                np.bincount(second[seen], minlength=len(ids))]
                extra = [(n[c] == k).sum() for c in (0, 1) for k in (1, 2)]
                ids = np.concatenate([ids, base + np.arange(4)])
                columns = [np.concatenate([values, extra]).astype(np.int64) for values in columns]
                rows = [(k, pack_sorted(ids[at]), *(pack(values[at]) for values in columns))
                        for k, at in _segments(ids // span)]
                yield _rows([list(c) for c in zip(*rows)], _arrow(SUMMED))

    rows = (counts.mapInArrow(told, SUMMED).repartition(buckets, "bucket")
            .groupBy("bucket").applyInArrow(_sums(SUMMED, pack_sorted, unpack_sorted), SUMMED).collect())
    whole = np.zeros((6, base + 4), np.int64)
    for r in rows:
        at = unpack_sorted(bytes(r["keys"]))
        for k in range(6):
            whole[k, at] = unpack(bytes(r[f"c{k}"]))
    extra, whole = whole[0, base:].copy(), whole[:, :base].astype(np.int32)
    by = [(whole[k], whole[k + 3]) for k in range(3)]
    discounts = tuple((_discount((by[2][c] == 1).sum(), (by[2][c] == 2).sum()),
                       _discount(extra[2 * c], extra[2 * c + 1])) for c in (0, 1))
    totals = tuple((float(by[2][c].sum()), float((by[2][c] > 0).sum()), float(by[0][c].sum())) for c in (0, 1))
    return Sides(*by, discounts, totals, len(known.hashes) + 1)


def log_ratio(sides: Sides, backoff: float, before: np.ndarray, word: np.ndarray,
              n: tuple[np.ndarray, np.ndarray], own: np.ndarray | int = 0) -> np.ndarray:
    """Logarithm of P(word | before) under the toxic model less that under the ordinary one.

    A class's word probability is its discounted share of distinct contexts, interpolated with equal
    shares of all words; a bigram's is its discounted share of the context's uses, interpolated with
    the word's. ``n`` has the bigram's uses by class; ``own`` the class (1 ordinary, 2 toxic) of which
    one use belongs to the text itself and is left out.
    """
    p = []
    for c in (0, 1):
        d_word, d_pair = sides.discounts[c]
        bigrams, types, uses = sides.totals[c]
        if not bigrams:
            p.append(np.full(len(word), 1 / sides.size))
            continue
        out = np.equal(own, 2 - c).astype(np.int64)
        gone = out * (n[c] == 1)
        contexts, context_uses = sides.contexts[c][word] - gone, sides.uses[c][before] - out
        followers, prior = sides.after[c][before] - gone, backoff * uses
        alone = np.maximum(contexts - d_word, 0) / bigrams + d_word * types / bigrams / sides.size
        p.append((np.maximum(n[c] - out - d_pair, 0) + (d_pair * followers + prior) * alone)
                 / (context_uses + prior))
    return np.log((1 - WEIGHT) + WEIGHT * p[0] / p[1])


@dataclass(frozen=True)
class Models:
    """Both models: bigram counts as a table of buckets, words and their counts as broadcast arrays."""

    counts: DataFrame
    words: object
    sides: object
    buckets: int
    backoffs: tuple[float, ...] = BACKOFFS


def learn(texts: DataFrame, chars: int, words_of: Callable) -> Models:
    """Both models from (text, toxic); all bigrams of all words, each once per text."""
    context = texts.sparkSession.sparkContext
    texts = texts.select("text", F.col("toxic").cast("int").alias("class"))
    buckets = 1 + int(chars) // BUCKET
    known = _vocabulary(texts, words_of)
    words = context.broadcast(known)
    counts = stage(_counts(texts, words, buckets, words_of), "counts")
    return Models(counts, words, context.broadcast(_sides(counts, known, buckets)), buckets)


def differences(texts: DataFrame, models: Models, words_of: Callable) -> DataFrame:
    """(print, class, backoff, difference, left_out) of (text, class), a row for each text and backoff.

    ``print`` is the text's md5, ``difference`` its log-likelihood under the toxic model less that
    under the ordinary one, per word, over all its words, 0 without any. Of a text with a class
    (1 ordinary, 2 toxic; 0 is none) ``left_out`` has its own uses left out of the counts. Null and
    empty texts have no row.
    """
    words, sides, buckets, backoffs = models.words, models.sides, models.buckets, models.backoffs

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        task, turn = TaskContext.get().partitionId(), 0

        def handed_on(prints: list[bytes], sizes: list[int], held: list, codes: list) -> pa.RecordBatch:
            pairs = np.concatenate([k for k, _ in held])
            uses = np.concatenate([n for _, n in held])
            of = np.repeat(np.array(codes), [len(k) for k, _ in held])
            order = np.argsort(pairs, kind="stable")
            bucket = _buckets_of(pairs, buckets)[order]
            again = np.argsort(bucket, kind="stable")
            order, bucket = order[again], bucket[again]
            chunk = task << 32 | turn
            rows = [(k, chunk, pack_pairs(pairs[order[at]], of[order[at]] & PLACE), pack(of[order[at]] >> CLASS),
                     pack(uses[order[at]])) for k, at in _segments(bucket)]
            # The texts themselves pass by in a bucket of their own.
            rows.append((-1 - chunk % buckets, chunk, b"".join(prints), pack(np.array(codes)), pack(np.array(sizes))))
            return _rows([list(c) for c in zip(*rows)], _arrow(ASKED))

        prints, sizes, held, codes, size = [], [], [], [], 0
        for piece, classes in _pieces(batches):
            hashes, places, ends = _hashed(piece, words_of)
            ranks = known.ranks(hashes)[places]
            for k, text in enumerate(piece):
                held.append(np.unique(known.bigrams(ranks[ends[k]:ends[k + 1]]), return_counts=True))
                codes.append(classes[k] << CLASS | len(codes))
                prints.append(hashlib.md5(text.encode()).digest())
                sizes.append(int(ends[k + 1] - ends[k]))
                size += len(held[-1][0]) + 1
            if size >= ENTRIES_OUT:
                yield handed_on(prints, sizes, held, codes)
                prints, sizes, held, codes, size = [], [], [], [], 0
                turn += 1
        if held:
            yield handed_on(prints, sizes, held, codes)

    def answered(asking: pa.Table, counted: pa.Table) -> pa.Table:
        rows = []
        if len(asking) and asking["bucket"][0].as_py() < 0:
            rows = [(row["chunk"], row["keys"], row["codes"], row["uses"]) for row in asking.to_pylist()]
            return pa.Table.from_batches([_rows([list(c) for c in zip(*rows)], _arrow(ANSWERED))])
        side, rows = sides.value, []
        pairs, n = np.full(1, -1), [np.zeros(2, np.int64)] * 2
        if len(counted):
            pairs = _pairs_alone(counted["keys"][0].as_py())
            n = [np.append(unpack(counted[c][0].as_py()), 0) for c in ("c0", "c1")]
        for chunk, keys, kinds, uses in zip(*(asking[c] for c in ("chunk", "keys", "codes", "uses"))):
            wanted, docs = unpack_pairs(keys.as_py())
            kinds, uses = unpack(kinds.as_py()), unpack(uses.as_py())
            at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
            at = np.where(pairs[at] == wanted, at, len(pairs))
            there, place = np.unique(docs, return_inverse=True)
            sums = []
            known = np.flatnonzero(kinds)
            for backoff in backoffs:
                told = [np.rint(log_ratio(side, backoff, wanted[of] >> 32, wanted[of] & WORD,
                                          (n[0][at[of]], n[1][at[of]]), own) / GRAIN) * uses[of]
                        for of, own in ((slice(None), 0), (known, kinds[known]))]
                more = told[1] - told[0][known]
                sums += [np.bincount(place, told[0], len(there)).astype(np.int64),
                         np.bincount(place[known], more, len(there)).astype(np.int64)]
            # The backoffs differ little: after the first, only by how much is told.
            sums = sums[:2] + [value - sums[k % 2] for k, value in enumerate(sums[2:])]
            rows.append((chunk.as_py(), None, pack_sorted(there), pack(np.concatenate(sums), signed=True)))
        columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
        return pa.Table.from_batches([_rows(columns, _arrow(ANSWERED))])

    def folded(table: pa.Table) -> pa.Table:
        """The texts of one chunk with their sums over all buckets."""
        rows = table.to_pylist()
        whole = next(row for row in rows if row["prints"] is not None)
        kinds, sizes = unpack(whole["codes"]) >> CLASS, unpack(whole["sums"])
        total = np.zeros((2 * len(backoffs), len(sizes)), np.int64)
        for row in rows:
            if row["prints"] is None:
                total[:, unpack_sorted(row["codes"])] += unpack(row["sums"], signed=True).reshape(len(total), -1)
        prints = [whole["prints"][k:k + 16] for k in range(0, len(whole["prints"]), 16)]
        sizes = np.maximum(sizes, 1)
        for k in range(2, len(total)):
            total[k] += total[k % 2]
        return pa.Table.from_batches([
            _rows([prints, kinds, np.full(len(sizes), k), total[2 * k] * GRAIN / sizes,
                   (total[2 * k] + total[2 * k + 1]) * GRAIN / sizes], _arrow(FOUND)) for k in range(len(backoffs))])

    asking = texts.mapInArrow(asked, ASKED).repartition(buckets, "bucket")
    answers = asking.groupBy("bucket").cogroup(models.counts.repartition(buckets, "bucket").groupBy("bucket")) \
        .applyInArrow(answered, ANSWERED)
    return answers.groupBy("chunk").applyInArrow(folded, FOUND)
