"""Find benchmark items in documents, re-parameterised ones included, by templates of canonical words.

Words lose outer punctuation and case; numbers, names and units become typed slots. A name is a capitalised word
that doesn't open a sentence, a unit a unit word after a number. Windows of template words are hash-joined
with those of the benchmark. An item is found in a document when enough of its windows match and its slots are
filled consistently: one value of the item always meets one value of the document. Both are judged for each
occurrence, a run of matches in the order of the item, so other fillings of its template elsewhere don't count
against it; and for all matches of the document together, which finds items in scattered parts.

The benchmark's windows go to the tasks as a sorted array when they are counted to fit LOOKUP_WINDOWS; else
windows of documents and items are joined by a shuffle. Both ways give the same rows.

An item shorter than a window is one window, and documents have windows of each length that such items have. Where it
is nothing but slots its values count instead, as any number or name would match. A long verbatim passage of an item is found
whatever its share of the item. Null and empty texts have no words, match nothing and are
clean. Rows with null or repeated ids are judged by their own text. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.textops import Spelled, WordTable, mix, slices, spell, window_hashes, worker_state

WINDOW = 8
#: Share of an item's windows that have to match, and of its slots that have to agree.
MIN_COVERAGE, MIN_CONSISTENT = 0.5, 0.8
#: Words of an item that a document has to repeat in a row, values of slots included, to hold it whatever the coverage.
MIN_RUN = 13
#: Words by which the offset between document and item may change from one match of an occurrence to the next.
#: Adjacent copies of an item of two windows are further apart.
MOST_SHIFT = WINDOW - 1
#: Windows of the benchmark that a task holds: 16 bytes each.
LOOKUP_WINDOWS = 4_000_000

#: Fixed values.
UNITS = frozenset(
    "% mm cm m km inch inches in ft feet foot yard yards mile miles mg g kg ton tons lb lbs oz ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh hz khz mhz ghz w kw kwh v a "
    "kb mb gb tb dollar dollars euro euros cent cents usd eur gbp degree degrees c f k percent".split()
)
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion".split())
NUMBER = re.compile(r"^[+\-$€£]*\d[\d.,:/]*(%|st|nd|rd|th)?$")
OUTER = "\"'`.,;:!?()[]{}<>*_~…“”‘’«»¿¡"
PLAIN, NUM, UNIT, CAPITAL = 0, 1, 2, 4
ENDS = 8
JUDGED = "id long, row long, item_id long, n_windows long, coverage double, consistent double, run long"
_SLOT = {NUM: np.uint64(0x6E756D), UNIT: np.uint64(0x756E6974), CAPITAL: np.uint64(0x6E616D65)}


def word_class(word: bytes) -> list[int]:
    """Flags of a word, and a hash of its canonical form."""
    text = word.decode()
    inner = text.strip(OUTER)
    lower = inner.lower()
    flags = ENDS if text.rstrip("\"')]}”’»").endswith((".", "!", "?")) else 0
    if NUMBER.match(inner) or lower in NUMBERS:
        flags |= NUM
    elif lower in UNITS:
        flags |= UNIT
    elif inner[:1].isupper():
        flags |= CAPITAL
    return [flags, int.from_bytes(blake2b(lower.encode(), digest_size=8).digest(), "little", signed=True)]


def canonical(words: Spelled) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hash, type of slot (0 for none) and value of every word."""
    table = worker_state("decontamination").setdefault("words", WordTable(lambda words: [word_class(w) for w in words]))
    rows = table.rows(words)  # may replace the table's arrays
    first = table.first[rows]
    flags, values = table.values[first], mix(table.values[first + 1].view(np.uint64))
    opens = np.ones(len(flags), bool)
    opens[1:] = (flags[:-1] & ENDS) > 0
    opens[words.first[:-1][words.first[:-1] < len(flags)]] = True
    after_number = np.zeros(len(flags), bool)
    after_number[1:] = (flags[:-1] & NUM) > 0
    kind = np.where(flags & NUM, NUM, np.where((flags & UNIT > 0) & after_number, UNIT, np.where((flags & CAPITAL > 0) & ~opens, CAPITAL, PLAIN)))
    template = values.copy()
    for slot, code in _SLOT.items():
        template[kind == slot] = mix(np.array([code], np.uint64))[0]
    return template, kind, values


def windows(texts: pa.Array, size: int, lengths: Iterable[int] | None = None) -> tuple[np.ndarray, ...]:
    """Text, place, hash, slot types and slot values of all windows; the last two for each word of a window.

    Besides windows of the full size there are those of the given shorter lengths; without lengths, a text shorter than the size is one window.
    """
    words = spell(texts)
    template, kind, values = canonical(words)
    counts = np.diff(words.first)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(template)) - words.first[text]
    left = counts[text] - place
    at = np.flatnonzero(left >= size)
    plain = np.concatenate([[0], np.cumsum(kind == PLAIN)])

    def hashed(at: np.ndarray, n: int) -> np.ndarray:
        """A window's template, or its values if it is nothing but slots: any list of numbers has the template of any other."""
        return np.where(plain[at + n] > plain[at], window_hashes(template, n)[at], window_hashes(values, n)[at])

    found = [(at, np.full(len(at), size), hashed(at, size))]
    for n in sorted({int(x) for x in counts if 0 < x < size} if lengths is None else lengths):
        at = np.flatnonzero((left >= n) if lengths is not None else (place == 0) & (left == n))
        if len(at):
            found.append((at, np.full(len(at), n), mix(hashed(at, n) ^ np.uint64(n))))
    at, span, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    return text[at], place[at], hashes, at, span, kind, values


def _slots(at: np.ndarray, span: np.ndarray, kind: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values of the slots in each window."""
    lists = [values[a : a + n][kind[a : a + n] > 0].view(np.int64) for a, n in zip(at.tolist(), span.tolist(), strict=True)]
    return pa.array(lists, pa.list_(pa.int64()))


def _windows_of(batches: Iterator[pa.RecordBatch], size: int, lookup: np.ndarray | None, lengths: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            text, place, hashes, at, span, kind, values = windows(part.column("text"), size, lengths)
            if lookup is not None and len(hashes):
                found = np.minimum(np.searchsorted(lookup, hashes), len(lookup) - 1)
                hit = lookup[found] == hashes
                text, place, hashes, at, span = text[hit], place[hit], hashes[hit], at[hit], span[hit]
            names = [x for x in part.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(x).take(pa.array(text)) for x in names), pa.array(place, pa.int64()), pa.array(span, pa.int64()), pa.array(hashes.view(np.int64)), _slots(at, span, kind, values)],
                [*names, "place", "span", "hash", "slots"],
            )


def occurrences(matches: list[tuple]) -> list[list[tuple]]:
    """Matches (place, item_place, ...) in order of place, as runs that go forward in document and item with small shifts."""
    runs: list[list[tuple]] = []
    latest: dict[int, int] = {}  # the last run at each offset
    shifts = [0, *(d for n in range(1, MOST_SHIFT + 1) for d in (n, -n))]
    for match in matches:
        place, item_place = match[:2]
        for shift in shifts:
            run = latest.get(place - item_place + shift)
            if run is not None and runs[run][-1][0] < place and runs[run][-1][1] < item_place:
                del latest[place - item_place + shift]
                break
        else:
            run = len(runs)
            runs.append([])
        runs[run].append(match)
        latest[place - item_place] = run
    return runs


def _agreement(matches: Iterable[tuple]) -> tuple[int, float]:
    """Windows of the item among matches (item_place, slots, item_slots), and the share of slots that meet their usual value."""
    met: dict[int, dict[int, int]] = {}
    places = set()
    for item_place, own, other in matches:
        places.add(item_place)
        for x, y in zip(own, other, strict=False):
            values = met.setdefault(y, {})
            values[x] = values.get(x, 0) + 1
    total = sum(sum(v.values()) for v in met.values())
    agreed = sum(max(v.values()) for v in met.values())
    return len(places), agreed / total if total else 1.0


def _longest_run(matches: list[tuple], window: int) -> int:
    """Most words in a row that are the item's, values of slots included."""
    same = sorted({(place - item_place, place) for place, item_place, own, other in matches if own == other})
    longest = run = 0
    last = None
    for offset, place in same:
        run = run + 1 if last == (offset, place - 1) else 1
        last = offset, place
        longest = max(longest, run)
    return longest + window - 1 if longest else 0


def _judged(key: tuple, group: pd.DataFrame, window: int) -> pd.DataFrame:
    """One document and item: matched windows and agreement of all matches, and of the occurrences that no other one beats in both."""
    columns = (group["place"].tolist(), group["item_place"].tolist(), map(tuple, group["slots"]), map(tuple, group["item_slots"]))
    matches = sorted(zip(*columns, strict=True))
    found = {_agreement({m[1:] for m in matches})}
    found.update(_agreement(m[1:] for m in run) for run in occurrences(matches))
    best, rows = -1.0, []
    n_windows = group["n_windows"].iloc[0]
    run = _longest_run(matches, min(window, int(group["span"].iloc[0])))
    for windows_met, consistent in sorted(found, reverse=True):
        if consistent > best:
            best = consistent
            rows.append([key[0], key[1], key[2], windows_met, windows_met / n_windows, consistent, run])
    return pd.DataFrame(rows)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(id, row, item_id, n_windows, coverage, consistent, run) of every document and item that share a window; row is a hash of the text, run the most words in a row that are the item's.

    A document and item have a row for all matches, and further ones for occurrences of less coverage that agree better.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").dropDuplicates()
    shape = "place long, span long, hash long, slots array<long>"
    item_windows = items.mapInArrow(lambda b: _windows_of(b, window, None), f"item long, {shape}")
    of_item = item_windows.groupBy("item").agg(F.countDistinct("place").alias("n_windows"))
    item_side = item_windows.join(of_item, "item").select(F.col("item").alias("item_id"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"), "n_windows")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    lengths = [r[0] for r in item_windows.where(F.col("span") < window).select("span").distinct().collect()]
    lookup = None
    if item_windows.count() <= LOOKUP_WINDOWS:
        lookup = np.unique(np.array([r[0] for r in item_windows.select("hash").distinct().collect()], np.int64).view(np.uint64))
    if lookup is not None and not len(lookup):
        return docs.sparkSession.createDataFrame([], JUDGED)
    found = texts.mapInArrow(lambda b: _windows_of(b, window, lookup, lengths), f"id long, row long, {shape}")
    met = found.join(item_side, "hash").select("id", "row", "item_id", "place", "span", "item_place", "slots", "item_slots", "n_windows")
    met = met.dropDuplicates(["id", "row", "item_id", "place", "item_place", "slots", "item_slots"])
    return met.groupBy("id", "row", "item_id").applyInPandas(lambda key, group: _judged(key, group, window), JUDGED)


def contaminated(found: DataFrame, min_coverage: float = MIN_COVERAGE, min_consistent: float = MIN_CONSISTENT, min_run: int = MIN_RUN) -> DataFrame:
    """(id, row) of documents that hold an item, with the item of the highest coverage."""
    hits = found.where((F.col("coverage") >= min_coverage) & (F.col("consistent") >= min_consistent) | (F.col("run") >= min_run))
    best = F.max(F.struct("coverage", (-F.col("item_id")).alias("m"), "item_id", "n_windows")).alias("best")
    return hits.groupBy("id", "row").agg(best, F.countDistinct("item_id").alias("n_items")).select("id", "row", "best.item_id", "best.n_windows", "best.coverage", "n_items")


def judge_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, contaminated, and for contaminated ones item_id, n_windows, coverage and n_items."""
    hits = contaminated(find_items(docs, benchmark, id_col, text_col))
    hits = hits.withColumnsRenamed({"id": "hit_id", "row": "hit_row"})
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"))
    judged = rows.join(hits, rows["id"].eqNullSafe(hits["hit_id"]) & (F.col("row") == F.col("hit_row")), "left")
    return judged.select(F.col("id").alias(id_col), F.col("hit_row").isNotNull().alias("contaminated"), "item_id", "n_windows", "coverage", F.coalesce("n_items", F.lit(0)).alias("n_items"))


def without_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the contaminated ones."""
    hits = contaminated(find_items(docs, benchmark, id_col, text_col)).select(F.col("id").alias("__id"), F.col("row").alias("__row"))
    return docs.join(hits, docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__row")), "left_anti")
