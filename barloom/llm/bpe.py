"""Byte-level BPE: a heap of merge ranks over a doubly linked list of symbols; decoding by concatenation."""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: the published split pattern of byte-level BPE vocabularies.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces remembered per worker; beyond it the memory starts afresh. Results do not depend on it.
REMEMBERED = 400_000
# Ids given to Spark at once (and so the largest output batch, but for one longer text).
IDS_OUT = 1_000_000


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else the next free above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Codec:
    """Encodes and decodes single texts with a vocabulary file's vocabulary, merges and added tokens."""

    def __init__(self, definition: str):
        held = json.loads(definition)
        vocab, symbols = held["model"]["vocab"], byte_symbols()
        self._start = [vocab[s] for s in symbols]
        # Rank of a pair of symbols, the pair as one number; symbol that a rank makes.
        self._ranks: dict[int, int] = {}
        self._makes: list[int] = []
        for rank, pair in enumerate(held["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self._makes.append(vocab[left + right])
        byte_of = {s: bytes([b]) for b, s in enumerate(symbols)}
        self._bytes = {i: b"".join(byte_of.get(c, c.encode()) for c in token)
                       for token, i in vocab.items()}
        added = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        self._bytes |= {i: content.encode() for content, i in added.items()}
        self._added = added
        self._split_added = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")"
        ).split if added else lambda text: [text]
        self._pieces = regex.compile(PIECES).findall
        self._known: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        """Give back what the pieces seen so far take."""
        self._known = {}

    def encode(self, text: str, remembered: int = REMEMBERED) -> list[int]:
        ids: list[int] = []
        known = self._known
        # With one group in the pattern, odd parts are the added tokens.
        special = any(t in text for t in self._added)
        for k, part in enumerate(self._split_added(text) if special else [text]):
            if k % 2:
                ids.append(self._added[part])
                continue
            for piece in self._pieces(part):
                found = known.get(piece)
                if found is None:
                    found = tuple(self.merge(piece.encode()))
                    if len(known) >= remembered:
                        known.clear()
                    if len(piece) <= 64:
                        known[piece] = found
                ids += found
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest ranked adjacent pair, leftmost first, until none has a rank."""
        start, ranks, makes = self._start, self._ranks, self._makes
        symbol = [start[b] for b in piece]
        n = len(symbol)
        if n == 1:
            return symbol
        # A heap entry is rank and place in one number.
        heap = [rank << 32 | k for k in range(n - 1)
                if (rank := ranks.get(symbol[k] << 32 | symbol[k + 1])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = pop(heap)
            k, rank = entry & 0xFFFFFFFF, entry >> 32
            nxt = after[k]
            # Stale: the symbol or its neighbour has changed since the entry was made.
            if symbol[k] < 0 or nxt >= n or ranks.get(symbol[k] << 32 | symbol[nxt]) != rank:
                continue
            merged = symbol[k] = makes[rank]
            symbol[nxt] = -1
            after[k] = following = after[nxt]
            if following < n:
                before[following] = k
                if (rank := ranks.get(merged << 32 | symbol[following])) is not None:
                    push(heap, rank << 32 | k)
            if (previous := before[k]) >= 0:
                if (rank := ranks.get(symbol[previous] << 32 | merged)) is not None:
                    push(heap, rank << 32 | previous)
        return [s for s in symbol if s >= 0]

    def decode(self, ids) -> str:
        held = self._bytes
        return b"".join([held.get(i, b"") for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def codec_of(definition: str) -> Codec:
    """The codec of a vocabulary, kept by a worker from task to task."""
    return Codec(definition)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [k for k, column in enumerate(batch.schema.names) if column != name]
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), values],
                                      names=[*(batch.schema.names[k] for k in kept), name])


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name),
                         T.StructField(name, kind)])


def _definition(df: DataFrame, path: str):
    """The vocabulary file, read where the driver runs and broadcast: its size is fixed."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
           remembered: int = REMEMBERED, forget: bool = False) -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids_col`` (array of int).

    ``path`` names a byte-level BPE vocabulary in the tokenizers library's JSON form; its added
    tokens are recognised in texts, none is added. Null and empty texts give an empty list. All
    other columns and all rows stay, repeated rows too; a column named ``ids_col`` is replaced. A
    worker remembers up to ``remembered`` pieces: fewer take less memory and more time, with equal ids;
    with ``forget`` it drops them after each task, for jobs that go on to other work.
    """
    definition = _definition(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(definition.value)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            start, parts, held = 0, [], 0
            for k in range(len(batch)):
                ids = np.array(codec.encode(texts[k].as_py() or "", remembered), dtype=np.int32)
                parts.append(ids)
                held += len(ids)
                if held >= IDS_OUT or k + 1 == len(batch):
                    ends = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
                    yield _with_column(batch.slice(start, len(parts)), ids_col,
                                       pa.ListArray.from_arrays(pa.array(ends),
                                                                pa.array(np.concatenate(parts))))
                    start, parts, held = k + 1, [], 0
        # Workers wait for later tasks and would keep what the batches took.
        if forget:
            codec.forget()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, _extended(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids",
           text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each id list in ``text_col``.

    Bytes that are not UTF-8 become U+FFFD; ids outside the vocabulary and nulls add nothing; a null
    list gives an empty text. A column named ``text_col`` is replaced.
    """
    definition = _definition(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(definition.value)
        for batch in batches:
            lists = batch.column(batch.schema.names.index(ids_col))
            start, parts, held = 0, [], 0
            for k in range(len(batch)):
                ids = lists[k].values.to_numpy(zero_copy_only=False).tolist() if lists[k].is_valid else []
                parts.append(codec.decode(ids))
                held += len(ids)
                if held >= IDS_OUT or k + 1 == len(batch):
                    yield _with_column(batch.slice(start, len(parts)), text_col, pa.array(parts, pa.string()))
                    start, parts, held = k + 1, [], 0
        pa.default_memory_pool().release_unused()

    return encoded.mapInArrow(run, _extended(encoded, text_col, T.StringType()))
