"""Repeated byte strings removed by prefix-free parsing and suffix arrays of dictionary and parse."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.shingles import U64, mix, text_slices
from barloom.session import Scratch, stage

# Bytes of text parsed at once.
SLICE_BYTES = 1 << 18
# Distinct entries of one trigger that are sorted together; a trigger with more is cut into blocks.
BLOCK_ENTRIES = 512
# Bytes of entries that a task sorts at once, whole blocks of any number of triggers.
SORTED_BYTES = 1 << 20
# Rows of results handed on at once.
ROWS_OUT = 2_000
# The rows without an id come after all others.
LAST_ID = (1 << 63) - 1
# Low bits of a rolling hash give way to the position, so that the leftmost of equal minima wins.
PLACE_BITS = 24

DOC = ["id", "mark"]
ENTRY = "key long, id long, mark long, lo int, hi int, trigger int, held binary"
FOUND = "s1 long, s2 long, id long, mark long, lo int, hi int"


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept), one row per row of ``docs``.

    Texts are taken as UTF-8 bytes. ``spans`` are the maximal runs [start, stop) of bytes covered by
    a string of ``length`` bytes that also starts earlier: in a document of smaller id, or earlier in
    the same one. ``kept`` holds the other bytes. Strings are judged on the texts as given, may
    overlap, and never cross documents.

    Prefix-free parsing: a trigger is the place whose window has the smallest rolling hash among those
    inside some string of ``length`` bytes, so that each such string holds the trigger that content
    alone gives it, and no stretch is without one. A phrase is the run of starts that share a trigger;
    with the bytes that follow up to the end of its last string it is an entry of the parse. Equal
    entries are folded into one dictionary entry with its first place: all others repeat. Entries
    whose trigger window occurs once in the corpus are dropped before, by counting. Of the rest, those
    of one trigger window are sorted twice, by what leads up to the trigger and by what follows it:
    the suffix arrays of dictionary and parse. Two strings are equal if they are neighbours of enough
    common bytes in both, so the two orders combined give the corpus order, and the first of a run of
    equal strings stays. A trigger window shared by very many entries is cut into blocks; each block
    folds its own equal strings, and what is left of the blocks is merged by a digest of 128 bits.

    A null text is empty. Rows of the same id and text are one document and get equal results; of
    equal ids with different texts the smaller hash of the text is the earlier one; rows without an id
    come last. Texts shorter than ``length`` keep all bytes. Other columns are ignored; an empty table
    gives an empty result.
    """
    if length < 16:
        raise ValueError("strings of fewer than 16 bytes hold no useful trigger window")
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")) \
        .withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID))) \
        .withColumn("mark", F.xxhash64("text"))
    texts = rows.filter(F.octet_length("text") >= length).select(*DOC, "text")
    shared = scratch.stage(texts.select("text").mapInArrow(_keys(length), "key long, n long")
                           .groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"),
                           "shared")
    places = scratch.stage(texts.mapInArrow(_placed(length), "key long, id long, mark long, place long")
                           .join(shared, "key").groupBy(*DOC)
                           .agg(F.array_sort(F.collect_set("place")).alias("places")), "places")
    parsed = scratch.stage(
        texts.join(places, DOC).groupBy(*DOC)
        .agg(F.first("text").alias("text"), F.first("places").alias("places"))
        .mapInArrow(_holder(length), "id long, mark long, places array<long>, held binary"), "parsed")
    firsts = scratch.stage(
        parsed.mapInArrow(_printer(length), "p1 long, p2 long, id long, mark long, lo int")
        .groupBy("p1", "p2").agg(F.min(F.struct(*DOC, "lo")).alias("first"))
        .groupBy("first.id", "first.mark").agg(F.collect_list("first.lo").alias("firsts")), "firsts")
    entries = scratch.stage(
        parsed.join(firsts, DOC, "left").mapInArrow(_entries(length), ENTRY), "entries")
    found = scratch.stage(_blocks(entries).mapInArrow(_combined(length), FOUND), "found")
    heads = found.filter("s1 IS NOT NULL")
    earliest = heads.groupBy("s1", "s2").agg(F.min(F.struct(*DOC, "lo")).alias("first"))
    later = heads.join(earliest, ["s1", "s2"]).filter(F.struct(*DOC, "lo") != F.col("first"))
    runs = (entries.filter("key IS NULL").select(*DOC, "lo", "hi")
            .union(found.filter("s1 IS NULL").select(*DOC, "lo", "hi"))
            .union(later.select(*DOC, "lo", "hi")))
    spans = stage(runs.groupBy(*DOC).agg(F.collect_list(F.struct("lo", "hi")).alias("runs")), "spans")
    scratch.clear()
    return rows.join(spans, DOC, "left").select("doc_id", "text", "runs").mapInArrow(
        _cutter(length), "doc_id long, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")


# Parsing -----------------------------------------------------------------------------------------

def _window(length: int) -> int:
    """Bytes of a trigger window: a third of the string, as longer ones leave too few to choose from."""
    return max(8, length // 3)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, those of its inverse, and a random value of each byte."""
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, b, dtype=U64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=U64))
    return out[0], out[1], mix(np.arange(256, dtype=U64))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, by minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    held = np.concatenate([values, np.full(-len(values) % width, np.iinfo(U64).max, U64)])
    blocks = held.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _parse(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, lo, hi, trigger, key) of each phrase, in the order of rows and starts.

    A phrase's strings start at lo to hi; its trigger is where their smallest window begins.
    """
    width = _window(length)
    for start, stop, data, offsets in text_slices(texts, SLICE_BYTES):
        # One longer text is parsed in pieces that share length - 1 bytes.
        steps = range(0, max(len(data), 1), SLICE_BYTES) if stop - start == 1 else (0,)
        for base in steps:
            piece = data[base:base + SLICE_BYTES + length - 1] if stop - start == 1 else data
            ends = np.array([0, len(piece)]) if stop - start == 1 else offsets
            n = len(piece)
            if n < length:
                continue
            powers, inverse, values = _powers(2 * SLICE_BYTES + length)
            sums = np.zeros(n + 1, U64)
            np.cumsum(values[piece] * powers[:n], out=sums[1:])
            hashes = mix((sums[width:] - sums[:-width]) * inverse[:n - width + 1])
            order = hashes >> U64(PLACE_BITS) << U64(PLACE_BITS) | np.arange(len(hashes), dtype=U64)
            trigger = (_smallest(order, length - width + 1)
                       & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
            inside = np.zeros(n + 1, np.int8)
            long = np.diff(ends) >= length
            inside[ends[:-1][long]] = 1
            inside[ends[1:][long] - length + 1] -= 1
            starts = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
            if not len(starts):
                continue
            at = trigger[starts]
            # Starts of one phrase follow one another and share the trigger.
            opens = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (np.diff(starts) != 1)))
            lo, hi = starts[opens], starts[np.append(opens[1:], len(starts)) - 1]
            row = np.searchsorted(ends, lo, side="right") - 1
            shift = base - ends[row]
            yield (start + row, lo + shift, hi + shift, at[opens] + shift,
                   hashes[at[opens]].view(np.int64))


def _keys(length: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, key in _parse(batch.column(0), length):
                held, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["key", "n"])
    return keys


def _packed(length: int) -> int:
    return length.bit_length()


def _placed(length: int):
    """A phrase's place in its text as one number, so that the order of places is that of numbers."""
    bits = _packed(length)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = [batch.column(k).to_numpy() for k in (0, 1)]
            for row, lo, hi, trigger, key in _parse(batch.column(2), length):
                place = ((lo << bits | hi - lo) << bits) | trigger - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (key, doc[0][row], doc[1][row], place)],
                    names=["key", "id", "mark", "place"])
    return placed


def _unpacked(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bits = _packed(length)
    lo, low = places >> 2 * bits, (1 << bits) - 1
    return lo, lo + (places >> bits & low), lo + (places & low)


# Dictionary --------------------------------------------------------------------------------------

def _lists(column: pa.Array, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each value counted from ``start``) of rows of a list column; null is empty."""
    part = column.slice(start, stop - start).fill_null([])
    sizes = part.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return (part.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.repeat(np.arange(stop - start), sizes))


def _holder(length: int):
    """Only the bytes under a listed place are held, one stretch after the other."""
    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in text_slices(batch.column(2), SLICE_BYTES):
                places, row = _lists(batch.column(3), start, stop)
                lo, hi, _ = _unpacked(places, length)
                covered = np.zeros(len(data) + 1, np.int32)
                np.add.at(covered, offsets[row] + lo, 1)
                np.add.at(covered, offsets[row] + hi + length, -1)
                inside = np.cumsum(covered[:-1]) > 0
                ends = np.append(0, np.cumsum(inside))[offsets]
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), stop - start,
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside])])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(start, stop - start) for k in (0, 1, 3)),
                     held.cast(pa.binary())], names=["id", "mark", "places", "held"])
    return hold


def _held(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, lo, hi, trigger, at, data): where each place's bytes begin in the held ones."""
    for start, stop, data, offsets in text_slices(batch.column(3), SLICE_BYTES):
        places, row = _lists(batch.column(2), start, stop)
        lo, hi, trigger = _unpacked(places, length)
        ends = np.append(0, hi + length)[:-1]
        ends[np.append(True, row[1:] != row[:-1])] = 0
        gaps = np.cumsum(np.maximum(lo - ends, 0))
        first = np.searchsorted(row, row)
        before = np.append(0, gaps)[first]
        yield start + row, lo, hi, trigger, offsets[row] + lo - (gaps - before), data


def _bytes_at(data: np.ndarray, at: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """rows x ``width`` bytes from ``at`` on, zero after ``size``; ``width`` is a multiple of 8."""
    step = np.arange(width)
    wide = np.minimum(at[:, None] + step, len(data) - 1)
    return np.where(step < size[:, None], data[wide], np.uint8(0))


def _digest(table: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    words = np.ascontiguousarray(table).view(U64)
    out = size.astype(U64) + U64(salt)
    for k in range(words.shape[1]):
        out = mix(out ^ words[:, k])
    return out.view(np.int64)


def _eights(n: int) -> int:
    return -(-n // 8) * 8


def _printer(length: int):
    """A digest of 128 bits of each entry; of equal ones of a document the first is enough."""
    width = _eights(2 * length)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = [batch.column(k).to_numpy() for k in (0, 1)]
            for row, lo, hi, trigger, at, data in _held(batch, length):
                size = hi - lo + length
                table = _bytes_at(data, at, size, width)
                # The trigger's offset follows from the bytes, so it needs no part in the digest.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digest(table, size, 0)), pa.array(_digest(table, size, 1 << 32)),
                     pa.array(doc[0][row]), pa.array(doc[1][row]), pa.array(lo.astype(np.int32))],
                    names=["p1", "p2", "id", "mark", "lo"])
    return prints


def _entries(length: int):
    """Entries at their first place, with bytes and the key of their trigger window; others repeat.

    A run of starts that repeat has no key.
    """
    width = _window(length)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = [batch.column(k).to_numpy() for k in (0, 1)]
            first_lo, first_row = _lists(batch.column(4), 0, len(batch))
            firsts = np.sort(first_row << 32 | first_lo)
            for row, lo, hi, trigger, at, data in _held(batch, length):
                here = row << 32 | lo
                k = np.minimum(np.searchsorted(firsts, here), max(len(firsts) - 1, 0))
                first = firsts[k] == here if len(firsts) else np.zeros(len(row), bool)
                window = _bytes_at(data, at + trigger - lo, np.full(len(at), width), _eights(width))
                key = _digest(window, np.full(len(at), width), 2 << 32)
                size = np.where(first, hi - lo + length, 0)
                ends = np.append(0, np.cumsum(size)).astype(np.int32)
                step = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
                held = pa.BinaryArray.from_buffers(
                    pa.binary(), len(row), [None, pa.py_buffer(ends),
                                            pa.py_buffer(data[np.repeat(at, size) + step])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=~first), pa.array(doc[0][row]), pa.array(doc[1][row]),
                     *(pa.array(v.astype(np.int32)) for v in (lo, hi, trigger)), held],
                    names=["key", "id", "mark", "lo", "hi", "trigger", "held"])
    return entries


# Suffix arrays -----------------------------------------------------------------------------------

def _blocks(entries: DataFrame) -> DataFrame:
    """Entries of triggers that several have, those of one block together and in a row."""
    known = entries.filter("key IS NOT NULL")
    counted = known.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(
        "key", F.ceil(F.col("n") / BLOCK_ENTRIES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(*DOC, "lo"), F.col("blocks")).cast("int").alias("block")
    return (known.join(counted, "key").select("key", block, "blocks", *DOC, "lo", "hi", "trigger", "held")
            .repartition("key", "block").sortWithinPartitions("key", "block"))


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole blocks, of SORTED_BYTES or one block more; a block is never cut."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def sort_now(rows: pa.Table) -> Iterator[pa.Table]:
        if rows.num_rows:
            yield rows

    for whole in batches:
        for k in range(0, len(whole), ROWS_OUT):
            batch = whole.slice(k, ROWS_OUT)
            waiting.append(batch)
            size += batch.nbytes
            if size < SORTED_BYTES:
                continue
            rows = pa.Table.from_batches(waiting)
            key, block = (rows.column(c).to_numpy() for c in ("key", "block"))
            last = (key == key[-1]) & (block == block[-1])
            cut = len(last) - int(last.sum())
            yield from sort_now(rows.slice(0, cut))
            waiting = rows.slice(cut).to_batches()
            size = sum(b.nbytes for b in waiting)
    if waiting:
        yield from sort_now(pa.Table.from_batches(waiting))


def _suffix_order(table: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows' bytes within their groups, and how many each shares with the one before."""
    words = np.ascontiguousarray(table).view(">u8")
    order = np.lexsort((*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group))
    held, of = table[order], group[order]
    differ = held[1:] != held[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
    return order, np.where(of[1:] == of[:-1], common, -1)


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """A number for each row; equal for rows of a group whose first ``depth`` bytes are equal."""
    out = np.empty(len(order), np.int64)
    out[order] = np.append(0, np.cumsum(common < depth))
    return out


def _combined(length: int):
    """Runs of starts that repeat an earlier one of the same block.

    Of a trigger cut into blocks, also the first start of each distinct string with its digest.
    """
    reach = length - _window(length) + 1
    left_width, right_width = _eights(reach), _eights(length)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_blocks(batches):
            rows = rows.sort_by([("id", "ascending"), ("mark", "ascending"), ("trigger", "ascending")])
            names = ("key", "block", "blocks", "id", "mark", "lo", "hi", "trigger")
            key, block, blocks, doc, mark, lo, hi, trigger = (
                rows.column(c).to_numpy().astype(np.int64) for c in names)
            held = rows.column("held").combine_chunks().cast(pa.large_binary())
            *_, buffer = held.buffers()
            data = np.frombuffer(buffer, np.uint8)
            at = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held)]
            n, size = len(key), hi - lo + length
            group = np.unique(np.stack([key, block]), axis=1, return_inverse=True)[1].ravel()
            back, forth = trigger - lo, size - (trigger - lo)
            table = _bytes_at(data, at + back, np.minimum(forth, length), right_width)
            follow = _suffix_order(table, group)
            step = np.arange(left_width)
            before = np.maximum((at + back - 1)[:, None] - step, 0)
            lead = _suffix_order(np.where(step < back[:, None], data[before], np.uint8(0)), group)
            again, heads = np.zeros((n, reach + 1), bool), []
            for distance in range(reach):
                some = np.flatnonzero((trigger - hi <= distance) & (distance <= back))
                if not len(some):
                    continue
                string = (_classes(*lead, distance) * n + _classes(*follow, length - distance))[some]
                # Rows stand in the order of documents and places, so the first of equals is earliest.
                first = np.unique(string, return_index=True)[1]
                again[some, distance + 1] = True
                again[some[first], distance + 1] = False
                heads.append((some[first], np.full(len(first), distance)))
            edges = np.diff(again.astype(np.int8), axis=1, append=0)
            row, near = np.nonzero(edges == 1)
            far = np.nonzero(edges == -1)[1]
            nothing = np.full(len(row), None)
            yield from _found(nothing, nothing, doc[row], mark[row], trigger[row] - far + 1,
                              trigger[row] - near)
            row, distance = (np.concatenate([h[k] for h in heads]) for k in (0, 1))
            split = blocks[row] > 1
            row, distance = row[split], distance[split]
            for k in range(0, len(row), SORTED_BYTES // right_width):
                r, d = row[k:k + SORTED_BYTES // right_width], distance[k:k + SORTED_BYTES // right_width]
                whole = np.full(len(r), length)
                strings = _bytes_at(data, at[r] + back[r] - d, whole, right_width)
                yield from _found(_digest(strings, whole, 3 << 32), _digest(strings, whole, 4 << 32),
                                  doc[r], mark[r], trigger[r] - d, trigger[r] - d)
    return combine


def _found(s1, s2, doc, mark, lo, hi) -> Iterator[pa.RecordBatch]:
    if len(lo):
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(v, pa.int64()) for v in (s1, s2, doc, mark)),
             *(pa.array(v.astype(np.int32)) for v in (lo, hi))],
            names=["s1", "s2", "id", "mark", "lo", "hi"])


# Result ------------------------------------------------------------------------------------------

def _cutter(length: int):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                runs = batch.column(2).slice(start, stop - start)
                sizes = runs.fill_null([]).value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(stop - start), sizes.astype(np.int64))
                lo, hi = (runs.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64)
                          for k in (0, 1))
                covered = np.zeros(len(data) + 1, np.int32)
                np.add.at(covered, offsets[row] + lo, 1)
                np.add.at(covered, offsets[row] + hi + length, -1)
                gone = np.cumsum(covered[:-1]) > 0
                ends = np.append(0, np.cumsum(~gone))[offsets]
                # A span never runs on into the next text.
                opens = gone & ~np.append(False, gone[:-1])[:len(gone)]
                edge = offsets[:-1][offsets[:-1] < len(data)]
                opens[edge] = gone[edge]
                closes = gone & ~np.append(gone[1:], False)[:len(gone)]
                last = offsets[1:][offsets[1:] > 0] - 1
                closes[last] = gone[last]
                first, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
                of = np.searchsorted(offsets, first, side="right") - 1
                n = np.append(0, np.cumsum(np.bincount(of, minlength=stop - start)))
                spans = pa.ListArray.from_arrays(
                    pa.array(n.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array((first - offsets[of]).astype(np.int32)),
                                                pa.array((end - offsets[of]).astype(np.int32))],
                                               names=["start", "stop"]), type=spans_type)
                kept = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), stop - start,
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[~gone])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start),
                     pa.array(np.diff(offsets).astype(np.int64)), spans, kept.cast(pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"])
    return cut
