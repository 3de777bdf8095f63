"""Hashes of the words of an Arrow string column, computed in numpy without an object per word.

A word's hash is a polynomial over its bytes, read off one running sum: the sum of
``code[byte] * BASE**position`` up to the word's end less that up to its start, shifted back by
the start. All arithmetic is modulo 2**64. Texts are handled in blocks cut between words, so
memory follows the block and not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Hashing a block takes some 60 times its bytes for a moment, in every Python worker.
BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values over the whole range (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants that depend on the seed alone."""
    start = np.uint64((seed * 0x632BE59BD9B4E019) % (1 << 64))
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def _powers(base: int, size: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or have.size < size:
        steps = np.full(max(size, BLOCK + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have[:size]


class Alphabet:
    """What each byte is: class 0 separates words, a change of class also ends a word.

    ``fold`` lower-cases A-Z. Bytes of 0x80 and above belong to the class given for them, so
    characters outside ASCII are never cut.
    """

    def __init__(self, classes: np.ndarray, fold: bool = True):
        self.classes = classes.astype(np.uint8)
        code = constants(256, 11)
        if fold:
            code[65:91] = code[97:123]
        self.code = code


def whitespace_alphabet() -> Alphabet:
    """Words are runs of anything but space and the bytes 0x09 to 0x0D."""
    classes = np.ones(256)
    classes[[0x20, *range(0x09, 0x0E)]] = 0
    return Alphabet(classes)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, index, data = column.buffers()
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Iterator[tuple[int, int]]:
    """Blocks of about BLOCK bytes that end where a row ends or a separator stands."""
    start, end = 0, data.size
    while start < end:
        stop = min(start + BLOCK, end)
        if stop < end:
            row = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if row > start:
                stop = row
            else:
                stop = _separator(data, start, stop, end, alphabet)
        yield start, stop
        start = stop


def _separator(data: np.ndarray, start: int, stop: int, end: int, alphabet: Alphabet) -> int:
    gaps = np.flatnonzero(alphabet.classes[data[start:stop]] == 0)
    if gaps.size and gaps[-1]:
        return start + int(gaps[-1])
    while stop < end:
        gaps = np.flatnonzero(alphabet.classes[data[stop : stop + BLOCK]] == 0)
        if gaps.size:
            return stop + int(gaps[0])
        stop = min(stop + BLOCK, end)
    return end


def words(
    data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and class of every word, in text order."""
    hashes, places, kinds = [], [], []
    for low, high in _cuts(data, offsets, alphabet):
        block = data[low:high]
        kind = alphabet.classes[block]
        edge = np.empty(block.size + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        inner = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")]
        edge[inner - low] = True
        at = np.flatnonzero(edge)
        starts, ends = at[:-1], at[1:]
        solid = kind[starts] != 0
        starts, ends = starts[solid], ends[solid]
        total = np.zeros(block.size + 1, np.uint64)
        np.cumsum(alphabet.code[block] * _powers(_BASE, block.size), out=total[1:])
        value = (total[ends] - total[starts]) * _powers(_INVERSE, block.size + 1)[starts]
        hashes.append(mix(value + (ends - starts).astype(np.uint64)))
        places.append(starts + low)
        kinds.append(kind[starts])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    place = np.concatenate(places)
    row = np.searchsorted(offsets, place, "right") - 1
    return np.concatenate(hashes), row, np.concatenate(kinds)


def ngrams(hashes: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (rows are not looked at)."""
    if hashes.size < n:
        return np.zeros(0, np.uint64)
    value = np.zeros(hashes.size - n + 1, np.uint64)
    for i, factor in enumerate(constants(n, seed)):
        value += hashes[i : i + value.size] * factor
    return mix(value)


def sequence_hash(hashes: np.ndarray, seed: int = 7) -> int:
    """Hash of a whole sequence, of another family than the runs of any fixed length."""
    length = hashes.size
    value = (hashes * constants(length, seed + 1)).sum(dtype=np.uint64)
    return int(mix(np.array([value + np.uint64(length)], np.uint64))[0])
