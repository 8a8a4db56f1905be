"""Words and word shingles of whole Arrow string columns as 64-bit hashes.

Everything is array arithmetic over the UTF-8 bytes of a batch, so no Python code runs per word. A
word's hash is a sum of its bytes times a pseudo-random factor per position (a universal hash), a
shingle's hash chains the mixed hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Bytes of text worked on at once, which take some fifty times as many in arrays; one longer text is a
# slice of its own.
SLICE_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = values.astype(U64) + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_slices(column: pa.Array, size: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield (start, stop, data[offsets[start]:offsets[stop]],
               offsets[start:stop + 1] - offsets[start])
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, in order; words are runs without ASCII white space, A-Z lowered."""
    inside = ~_SPACE[data]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    first = np.empty(len(data), dtype=bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    opens = np.flatnonzero(first[at])
    starts = at[opens]
    position = at - np.repeat(starts, np.diff(np.append(opens, len(at))))
    factors = mix(np.arange(int(position.max()) + 1, dtype=U64)) | U64(1)
    terms = (_LOWER[data[at]].astype(U64) + U64(1)) * factors[position]
    return np.add.reduceat(terms, opens), np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin.

    A row of fewer than ``width`` words, but not none, has its whole sequence as one shingle.
    """
    words, row = word_hashes(data, offsets)
    rows = len(offsets) - 1
    n_words = np.bincount(row, minlength=rows)
    begins = np.cumsum(n_words) - n_words
    hashes, owners = [], []
    for size in range(1, width + 1):
        if size == width:
            last = max(len(words) - width + 1, 0)
            at = np.flatnonzero(row[:last] == row[width - 1:]) if last else np.zeros(0, np.int64)
        else:
            at = begins[n_words == size]
        chained = np.full(len(at), size, dtype=U64)
        for k in range(size):
            chained = mix(chained ^ words[at + k])
        hashes.append(chained)
        owners.append(row[at])
    values, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.append(0, np.cumsum(np.bincount(owner, minlength=rows)))


def one_permutation(values: np.ndarray, ends: np.ndarray, bins: int) -> np.ndarray:
    """rows x bins signature: the smallest hash of each bin, empty bins densified.

    The high half of a hash names its bin. An empty bin takes the value of the first filled bin in
    a pseudo-random order of its own (optimal densification), so bins stay independent samples.
    Rows without a shingle stay 0 everywhere.
    """
    rows = len(ends) - 1
    row = np.repeat(np.arange(rows), np.diff(ends))
    slot = row * bins + (((values >> U64(32)) * U64(bins)) >> U64(32)).astype(np.int64)
    first = np.ones(len(slot), dtype=bool)
    first[1:] = slot[1:] != slot[:-1]
    signature, filled = np.zeros(rows * bins, U64), np.zeros(rows * bins, dtype=bool)
    signature[slot[first]] = values[first]
    filled[slot[first]] = True
    empty = np.flatnonzero(~filled & np.repeat(np.diff(ends) > 0, bins))
    attempt = 0
    while len(empty):
        attempt += 1
        source = (mix((empty % bins).astype(U64) * U64(1_000_003) + U64(attempt << 32))
                  % U64(bins)).astype(np.int64)
        source += empty // bins * bins
        ready = filled[source]
        signature[empty[ready]] = signature[source[ready]]
        empty = empty[~ready]
    return signature.reshape(rows, bins)


def band_keys(signature: np.ndarray, per_band: int) -> np.ndarray:
    """rows x bands keys; a key tells its band, so buckets of different bands never meet."""
    rows, bins = signature.shape
    parts = signature.reshape(rows, bins // per_band, per_band)
    keys = np.broadcast_to(np.arange(bins // per_band, dtype=U64), parts.shape[:2])
    for k in range(per_band):
        keys = mix(keys ^ parts[:, :, k])
    return keys


def odd_sketches(values: np.ndarray, ends: np.ndarray, words: int) -> np.ndarray:
    """rows x ``words``: the parity of how many shingles fall on each bit.

    Sets that differ in d shingles have sketches that differ in at most d bits, so the count of
    differing bits is a sure lower bound of the difference of the sets.
    """
    rows = len(ends) - 1
    sketch = np.zeros(rows * words, U64)
    slot = np.repeat(np.arange(rows), np.diff(ends)) * words \
        + ((values >> U64(6)) % U64(words)).astype(np.int64)
    np.bitwise_xor.at(sketch, slot, U64(1) << (values & U64(63)))
    return sketch.reshape(rows, words)


def set_prints(values: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """16 bytes that name each row's whole set; None for an empty set."""
    sums = [np.append(U64(0), np.cumsum(mix(values ^ U64(salt)))) for salt in (1, 2)]
    pair = np.stack([s[ends[1:]] - s[ends[:-1]] for s in sums], axis=1)
    raw = pair.astype(">u8").tobytes()
    return [raw[16 * k:16 * k + 16] if n else None for k, n in enumerate(np.diff(ends))]
