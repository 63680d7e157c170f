"""Words and word hashes of whole Arrow batches, with a Python step per distinct word of a batch at most.

Words are numbered by their bytes, so different words are never taken for one another; hashes are XXH3 of the bytes. A word is a maximal run of bytes other than space and tab to carriage return, so white space above
ASCII belongs to words. All functions work on UTF-8 bytes; a null text has no words.
"""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash

#: Text that operators with much state per word take at a time.
PIECE = 1 << 21

#: Bytes between words.
WHITE = b" \t\n\v\f\r"

_P = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Kinds of bytes: letters, digits, other ASCII, and those that bind a word together, as in contractions and special tokens.
_LETTER, _DIGIT, _OTHER, _STICKY = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[128:] = _KIND[39] = _KIND[124] = _STICKY


class Spelled(NamedTuple):
    """Words of a batch in reading order."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # first byte of each text, and the number of bytes
    starts: np.ndarray  # first byte of each word in data
    ends: np.ndarray
    codes: np.ndarray  # which distinct word each one is
    distinct: list[bytes]  # the distinct words
    first: np.ndarray  # index of the first word of each text, and the number of words


class Words(NamedTuple):
    """Spelled words with a hash of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    distinct: list[bytes]
    hashes: np.ndarray  # uint64
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def spell(texts: pa.Array, lower: bool = False, breaks: bytes = WHITE, refine: Callable | None = None) -> Spelled:
    """Words of each text; breaks are the bytes between words. Equal words, byte for byte, have equal codes.

    ``refine`` may cut words further and respell them: of bytes, starts and ends it makes starts, ends and bytes.
    """
    data, offsets = text_buffer(texts)
    white = np.zeros(256, bool)
    white[list(breaks)] = True
    solid = ~white[data]
    # A word begins at a solid byte after white space or at the start of a text.
    before = np.concatenate([[False], solid[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.concatenate([solid[1:], [False]])
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    spelled = _LOWER[data] if lower else data
    if refine is not None:
        starts, ends, spelled = refine(data, starts, ends)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = spelled[solid]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    # Bytes of the distinct words, sliced where each is first met.
    at = np.zeros(len(coded.dictionary), np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = letters.tobytes()
    distinct = [raw[a:b] for a, b in zip(bounds[at].tolist(), bounds[at + 1].tolist(), strict=True)]
    return Spelled(data, offsets, starts, ends, codes, distinct, np.searchsorted(starts, offsets))


def latin_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts words of ASCII and of letters from U+00C0 to U+00FF, without apostrophe and vertical bar, into lower-cased runs of letters, single digits and runs of other characters."""
    kind, lower = _KIND[data], _LOWER[data]
    # In UTF-8 these letters are 0xC3 and one more byte, in which 0x97 and 0xB7 are signs and small letters are 0x20 above capital ones.
    lead = np.flatnonzero(data == 0xC3)
    second = data[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)
    kind[lead[letter]] = kind[lead[letter] + 1] = _LETTER
    lower[lead[letter & (second < 0x9F)] + 1] += 0x20
    sticky = np.concatenate([[0], np.cumsum(kind == _STICKY)])
    plain = sticky[ends] == sticky[starts]
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts[plain]] += 1
    steps[ends[plain]] -= 1
    inside = np.cumsum(steps[:-1], dtype=np.int8) > 0
    cut = ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & inside[1:] & inside[:-1]
    opens, closes = np.zeros(len(data), bool), np.zeros(len(data), bool)
    opens[starts], closes[ends - 1] = True, True
    opens[1:] |= cut
    closes[:-1] |= cut
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1, np.where(inside, lower, data)


def words_of(texts: pa.Array, lower: bool = False, breaks: bytes = WHITE) -> Words:
    found = spell(texts, lower, breaks)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found.distinct), np.uint64, len(found.distinct))
    return Words(found.data, found.starts, found.ends, found.codes, found.distinct, hashes[found.codes], found.first)


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, texts not told apart: entry i covers words i to i + k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_P) + hashes[j : j + n]
    return mix(out)


class Shingles(NamedTuple):
    hashes: np.ndarray  # distinct per text, ascending
    first: np.ndarray  # offsets by text


def shingles_of(texts: pa.Array, k: int = 5, lower: bool = True) -> Shingles:
    """Distinct k-word shingles of each text; a text of fewer words has its whole sequence as its only one."""
    words = words_of(texts, lower)
    counts = np.diff(words.first)
    windows = window_hashes(words.hashes, k)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(first[-1]), np.uint64)
    fresh = np.ones(len(out), bool)
    for i in np.flatnonzero(sizes):
        a, w = first[i], words.first[i]
        part = out[a : first[i + 1]]
        if counts[i] >= k:
            part[:] = windows[w : w + counts[i] - k + 1]
            part.sort()
            fresh[a + 1 : first[i + 1]] = part[1:] != part[:-1]
        else:
            own = words.hashes[w : w + counts[i]]
            part[:] = window_hashes(own, int(counts[i])) ^ np.uint64(counts[i])
    return Shingles(out[fresh], np.concatenate([[0], np.cumsum(fresh)])[first])


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many bytes of text, one row at least."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def worker_state(owner: str) -> dict:
    """What outlives a task in a reused Python worker; functions shipped by value lose their globals.

    A worker holds the state of one owner: when another one asks, the tables of the last are let go.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; a library's threads would only contend for it
    held = sys.modules.setdefault("_tillstar_worker", types.ModuleType("_tillstar_worker")).__dict__
    if held.get("owner") != owner:
        held.update(owner=owner, state={})
        give_back()
    return held["state"]


def give_back() -> None:
    """Return memory that allocators keep after an earlier stage of a reused worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library of Linux: what is kept is used again
        pass


class WordTable:
    """What a function gives for each distinct word, kept while words repeat.

    compute takes a list of words (bytes) and returns a list of integers for each, or a pair of arrays: how many integers each word
    has, and all of them in a row. The table is bounded: beyond
    ``most`` words it starts anew with those of the current batch, which costs time and changes no result.
    """

    def __init__(self, compute: Callable[[list[bytes]], list | tuple], most: int = 1 << 19) -> None:
        self.compute, self.most = compute, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.sizes, self.first, self.values = np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def rows(self, words: Spelled) -> np.ndarray:
        """Index in the table of every word, after missing ones are computed."""
        spelled = words.distinct
        fresh = [w for w in spelled if w not in self.index]
        if len(self.index) + len(fresh) > self.most:
            self._clear()
            fresh = spelled
        if fresh:
            results = self.compute(fresh)
            if isinstance(results, tuple):
                sizes, values = results
            else:
                sizes = np.fromiter(map(len, results), np.int64, len(results))
                values = np.fromiter(chain.from_iterable(results), np.int64, int(sizes.sum()))
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh)), strict=True))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            self.sizes, self.values = np.concatenate([self.sizes, sizes]), np.concatenate([self.values, values])
        return np.fromiter(map(self.index.__getitem__, spelled), np.int64, len(spelled))[words.codes]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] entries, then the same for each further pair."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
