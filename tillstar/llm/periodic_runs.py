"""Periodic runs of words, found on an enhanced suffix array of each text.

A run of period q is a stretch of words in which words q apart are identical, q is the smallest such distance, and
neither neighbour can join. Runs of at least ``min_length`` words and ``min_exponent`` periods are reported.

Suffixes of all texts of a batch are sorted by prefix doubling; the first key is (text, word), so suffixes of different texts
share nothing. Ranks of every round stay, which gives common prefixes, to the right and to the left, by binary
descent. For each interval of the array with common prefix d, only suffixes of its smaller children are
tested: if the suffix d words further, or d words back, lies in another child of the interval, a square of two times d words
ends there whose next word differs. Turned left as far as words allow, squares grow to runs; equal stretches are
merged under the least d. Intervals are ranges of the array; no tree is built.

Sorting starts from words that may lie in a run at all: those in a three-word sequence that the text repeats as often as a run
of the least length and exponent must. Other words only separate stretches, which loses no run.

A null or empty text has no runs and collapses to an empty text. Rows are judged one by one, so repeated rows and
ids give repeated results. Extra columns are ignored. A text is taken whole; the arrays take about 100 bytes per word that may lie in a run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.textops import WHITE, Spelled, ranges, slices, spell

#: Text handled at a time; a longer text is taken whole.
PART_BYTES = 4 << 20
#: Suffixes of smaller children tested at a time.
TESTS = 1 << 21

_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE)] = True


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key among the distinct ones, ascending, and how often each occurs."""
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return back, counts


def _candidates(doc: np.ndarray, ids: np.ndarray, min_length: int, min_exponent: float) -> np.ndarray:
    """Marks words that may lie in a run: parts of three-word sequences that repeat within the text as those of a run do."""
    n = len(ids)
    least = [(max(min_length, math.ceil(min_exponent * q)) - 2) // q for q in range(1, 5)]
    if min(least) < 2 or n < 3:
        return np.ones(n, bool)
    back, counts = _dense(doc * (int(ids.max()) + 1) + ids)
    rank, often = back, counts[back] >= min(least)
    for step in (1, 2):
        at = np.flatnonzero(often[: n - step])
        at = at[doc[at] == doc[at + step]]
        if not len(at):
            return np.zeros(n, bool)
        key, counts = _dense(rank[at] * n + back[at + step])
        often = np.zeros(n, bool)
        often[at] = counts[key] >= min(least)
        rank = np.zeros(n, np.int64)
        rank[at] = key
    at = np.flatnonzero(often)
    marked = np.zeros(n, bool)
    for step in range(3):
        marked[at + step] = True
    return marked


class SuffixArray(NamedTuple):
    order: np.ndarray  # suffixes in ascending order
    place: np.ndarray  # inverse of order
    levels: list[np.ndarray]  # ranks by the first 1, 2, 4, ... symbols
    common: np.ndarray  # common prefix of each suffix with the one before it


def suffix_array(symbols: np.ndarray) -> SuffixArray:
    """By prefix doubling; only suffixes that still share their prefix are sorted again. The last symbol occurs once."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order][1:] != symbols[order][:-1]
    heads = np.flatnonzero(fresh)
    place = np.empty(n, np.int32)
    place[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels = [place.copy()]
    width = 1
    while True:
        lone = fresh.copy()
        lone[:-1] &= fresh[1:]
        at = np.flatnonzero(~lone)
        if not len(at):
            break
        # Suffixes in a group share ``width`` symbols, so none of them reaches the end.
        suffixes = order[at]
        key = place[suffixes].astype(np.int64) * n + place[suffixes + width]
        turn = np.argsort(key, kind="stable")
        order[at], key = suffixes[turn], key[turn]
        fresh[at[1:]] |= key[1:] != key[:-1]
        heads = np.flatnonzero(fresh[at])
        place[order[at]] = np.repeat(at[heads], np.diff(np.append(heads, len(at))))
        levels.append(place.copy())
        width *= 2
    common = np.zeros(n, np.int64)
    if n > 1:
        common[1:] = _shared(levels, order[:-1], order[1:], 1)
    return SuffixArray(order, place, levels, common)


def _shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
    """Equal symbols from a and b on to the right (way 1), or before a and b to the left (way -1)."""
    n = len(levels[0])
    length = np.zeros(len(a), np.int64)
    for power in range(len(levels) - 1, -1, -1):
        width, rank = 1 << power, levels[power]
        x, y = (a + length, b + length) if way > 0 else (a - length - width, b - length - width)
        inside = np.flatnonzero((x >= 0) & (y >= 0) & (x < n) & (y < n))
        equal = inside[rank[x[inside]] == rank[y[inside]]]
        length[equal] += width
    return length


def _intervals(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds between children (places with common prefix above 0), each with the interval [left, right) that it splits."""
    inner = np.flatnonzero(common > 0)
    lefts, rights = [0] * len(inner), [0] * len(inner)
    stack: list[tuple[int, int, int, int]] = []  # number, place, left bound of its interval, common prefix
    before, base = -2, 0
    for i, (k, value) in enumerate(zip(inner.tolist(), common[inner].tolist(), strict=True)):
        if k != before + 1:  # a place without common prefix lies between
            for j, *_ in stack:
                rights[j] = before + 1
            stack.clear()
            base = k - 1
        while stack and stack[-1][3] > value:
            rights[stack.pop()[0]] = k
        bound = base
        if stack:
            _, place, left, shared = stack[-1]
            bound = left if shared == value else place
        lefts[i] = bound
        stack.append((i, k, bound, value))
        before = k
    for j, *_ in stack:
        rights[j] = before + 1
    return inner, np.array(lefts, np.int64), np.array(rights, np.int64)


def squares(array: SuffixArray, min_size: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Starts and half lengths of squares whose next symbol differs, from intervals of at least so many suffixes."""
    order, place, common = array.order, array.place, array.common
    n = len(order)
    bounds, left, right = _intervals(common)
    big = right - left >= min_size
    bounds, left, right = bounds[big], left[big], right[big]
    if not len(bounds):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turn = np.lexsort((bounds, right, left))
    bounds, left, right = bounds[turn], left[turn], right[turn]
    opens = np.ones(len(bounds), bool)
    opens[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    which = np.cumsum(opens) - 1
    low, high, depth = left[opens], right[opens], common[bounds[opens]]
    # Children: from the left bound to the first split, and from each split to the next or the right bound.
    begin = np.concatenate([low, bounds])
    owner = np.concatenate([np.arange(len(low)), which])
    turn = np.lexsort((begin, owner))
    begin, owner = begin[turn], owner[turn]
    end = np.append(begin[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True)
    end[last] = high[owner[last]]
    size = end - begin
    # The largest child of each interval is left out, the first of equal ones.
    turn = np.lexsort((begin, -size, owner))
    largest = turn[np.append(True, owner[turn][1:] != owner[turn][:-1])]
    small = np.ones(len(begin), bool)
    small[largest] = False
    begin, end, owner, size = begin[small], end[small], owner[small], size[small]
    starts, halves = [], []
    ends = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TESTS, side="right")))
        spread = np.repeat(np.arange(a, b), size[a:b])
        suffix = order[ranges(begin[a:b], size[a:b])]
        span = depth[owner[spread]]
        for way in (1, -1):
            other = suffix + way * span
            inside = np.flatnonzero((other >= 0) & (other < n))
            child, at = spread[inside], place[other[inside]]
            hit = (at >= low[owner[child]]) & (at < high[owner[child]]) & ~((at >= begin[child]) & (at < end[child]))
            inside = inside[hit]
            starts.append(np.minimum(suffix[inside], other[inside]))
            halves.append(span[inside])
        a = b
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(doc: np.ndarray, ids: np.ndarray, min_length: int = 6, min_exponent: float = 4.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of the runs of texts in a row, by start, then period; doc ascends."""
    none = np.zeros(0, np.int64)
    if not len(ids):
        return none, none, none
    marked = np.flatnonzero(_candidates(doc, ids, min_length, min_exponent))
    if not len(marked):
        return none, none, none
    # Stretches of marked words, each followed by a symbol of its own.
    breaks = np.append((np.diff(marked) > 1) | (np.diff(doc[marked]) > 0), True)
    stretch = np.cumsum(np.append(0, breaks[:-1]))
    size = len(marked) + int(stretch[-1]) + 1
    own, _ = _dense(doc[marked] * (int(ids.max()) + 1) + ids[marked])
    symbols = np.empty(size, np.int64)
    origin = np.full(size, -1, np.int64)
    at = np.arange(len(marked)) + stretch
    symbols[at], origin[at] = own + size, marked
    separators = np.ones(size, bool)
    separators[at] = False
    symbols[separators] = np.arange(int(separators.sum()))
    array = suffix_array(symbols)
    start, half = squares(array, max(2, math.floor(min_exponent)))
    if not len(start):
        return none, none, none
    turned = _shared(array.levels, start, start + half, -1)
    start, end = start - turned, start + 2 * half
    long = (end - start >= min_length) & (end - start >= min_exponent * half)
    start, end, half = origin[start[long]], origin[end[long] - 1] + 1, half[long]
    turn = np.lexsort((half, end, start))
    start, end, half = start[turn], end[turn], half[turn]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, half = start[first], end[first], half[first]
    turn = np.lexsort((half, start))
    return start[turn], end[turn], half[turn]


def _collapsed(words: Spelled, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts made of the words that stay, one space between them."""
    stays = ~dropped
    # A byte after a word that stays serves as the space, unless no other word of its text stays behind it.
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    kept = np.flatnonzero(stays)
    follow = np.append(doc[kept][1:] == doc[kept][:-1], False) if len(kept) else np.zeros(0, bool)
    picked = ~_WHITE[words.data]
    gone = np.flatnonzero(dropped)
    picked[ranges(words.starts[gone], words.ends[gone] - words.starts[gone])] = False
    picked[words.ends[kept[follow]]] = True
    sums = np.concatenate([[0], np.cumsum(picked)])
    out = words.data[picked]
    out[_WHITE[out]] = 32
    return out, sums[words.offsets]


def find_runs(texts: pa.Array, min_length: int = 6, min_exponent: float = 4.0) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each text: number of words, list of (start, length, period) and the text without later periods of its runs."""
    words = spell(texts)
    counts = np.diff(words.first)
    doc = np.repeat(np.arange(len(counts)), counts)
    start, end, period = runs_of(doc, words.codes.astype(np.int64), min_length, min_exponent)
    edges = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, end, -1)
    data, offsets = _collapsed(words, np.cumsum(edges[:-1]) > 0)
    by_text = np.searchsorted(start, words.first)
    inside = start - words.first[:-1][doc[start]]
    fields = [pa.array(x, pa.int64()) for x in (inside, end - start, period)]
    runs = pa.ListArray.from_arrays(pa.array(by_text, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    text = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.array(counts, pa.int64()), runs, text.cast(pa.string())


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_words, runs (start, length and period in words, by start, then period) and the collapsed text."""
    key = docs.schema[id_col].dataType.simpleString()
    shape = f"`{id_col}` {key}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", PART_BYTES):
                found = find_runs(part.column("_text"), min_length, min_exponent)
                yield pa.RecordBatch.from_arrays([part.column(0), *found], [id_col, "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(judge, shape)
