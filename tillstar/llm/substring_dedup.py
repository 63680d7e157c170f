"""Remove passages of documents that occur in a document with a smaller id, by FM-indexes over shards of passages.

Shards are cut by content: each window of ``length`` words belongs to its least k-gram (by hash), so equal windows
meet in one shard wherever they come from, and a run of windows with one least k-gram travels as one passage.

1. Least k-grams that only one document has are dropped with all their windows: nothing can match there.
2. Equal passages are one, held by its smallest id; its words go to the shard of its k-gram.
3. A shard indexes its passages and streams them through the index. Backward search gives the interval of
   every window, and the interval the smallest id that holds the window.
4. Windows whose smallest id is below a document's own are cut from that document.

Words are kept as 48-bit hashes inside a shard. A shard holds the passages of its k-grams, SHARD_WORDS words on
average; all passages around one k-gram are in one shard, equal ones once.

Null and empty texts have no words. A null id is neither smaller nor larger than any other: such rows
stay whole and cut nothing, nor do rows that repeat an id cut each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.fm_index import FmIndex
from tillstar.llm.textops import PIECE, mix, ranges, slices, text_buffer, window_hashes, words_of
from tillstar.sources.workspace import persisted

K = 5
#: Windows of one passage: a place in a 64-bit mask each.
MOST_WINDOWS = 64
SHARD_WORDS = 300_000


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i : i + width] for every i."""
    have, least = 1, values
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:]) if len(least) > have else least[:0]
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def passages(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, start, windows and least k-gram of every passage; first: bounds of the texts in hashes."""
    counts = np.diff(first)
    own = np.flatnonzero(counts >= length)
    starts = ranges(first[own], counts[own] - length + 1)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    text = np.repeat(own, counts[own] - length + 1)
    least = sliding_minimum(window_hashes(hashes, K), length - K + 1)[starts]
    opens = np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(opens)
    sizes = np.diff(np.concatenate([at, [len(starts)]]))
    cuts = -(-sizes // MOST_WINDOWS)
    part = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(at, cuts) + part * MOST_WINDOWS
    n = np.minimum(MOST_WINDOWS, np.repeat(at + sizes, cuts) - begin)
    return text[begin], starts[begin] - first[text[begin]], n, least[begin]


def _sequence_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for j in range(int(lengths.max()) if len(lengths) else 0):
        on = lengths > j
        out[on] = out[on] * np.uint64(0x9E3779B97F4A7C15) + hashes[starts[on] + j]
    return mix(out ^ lengths.astype(np.uint64))


def _listed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", PIECE * 2):
            words = words_of(part.column("text"))
            text, start, n, least = passages(words.hashes, words.first, length)
            content = _sequence_hashes(words.hashes, words.first[text] + start, n + length - 1)
            ids, rows = (part.column(c).to_numpy(zero_copy_only=False)[text] for c in ("id", "row"))
            yield pa.RecordBatch.from_arrays(
                [least.view(np.int64), content.view(np.int64), ids, rows, start.astype(np.int32), n.astype(np.int32)], ["gram", "content", "id", "row", "start", "n"]
            )


def _shipped(batches: Iterator[pa.RecordBatch], length: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Words of the passages that a document holds for all others."""
    for batch in batches:
        for part in slices(batch, "text", PIECE * 2):
            words = words_of(part.column("text"))
            held = part.column("held")
            flat, counts = held.flatten(), np.diff(held.offsets.to_numpy())
            text = np.repeat(np.arange(part.num_rows), counts)
            gram, content, start, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("gram", "content", "start", "n"))
            a = words.first[text] + start
            six = np.ascontiguousarray(words.hashes).view(np.uint8).reshape(-1, 8)[:, :6]
            packed = [six[i : i + w].tobytes() for i, w in zip(a.tolist(), (n + length - 1).tolist(), strict=True)]
            shard = (mix(gram.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            ids = part.column("id").to_numpy(zero_copy_only=False)[text]
            yield pa.RecordBatch.from_arrays([shard, gram, content, ids, pa.array(packed, pa.binary())], ["shard", "gram", "content", "least", "words"])


def _searched(table: pa.Table, length: int) -> pa.Table:
    """Per passage of a shard and window, the smallest id that holds the window."""
    packed = table.column("words").to_pylist()
    lengths = np.array([len(p) // 6 for p in packed], np.int64)
    wide = np.zeros((int(lengths.sum()), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
    index = FmIndex(wide.view(np.uint64).ravel(), lengths, length)
    found = index.least_at_matches(table.column("least").to_numpy())
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]), pa.int32()), pa.array(np.concatenate(found)))
    return pa.table({"gram": table.column("gram"), "content": table.column("content"), "least": lists})


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            raw = data.tobytes()
            words = (raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            counted = [(len(w), _digest(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("row"), pa.array([c[0] for c in counted], pa.int64()), pa.array([c[1] for c in counted])], ["id", "row", "n_words", "sha"]
            )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Documents without the words of their covered windows. cuts: start of a passage and a mask of its windows."""
    for batch in batches:
        n_removed, shas, texts = [], [], []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
            words = text.encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for cut in cuts:
                windows = cut["start"] + np.flatnonzero((np.uint64(cut["mask"] & (2**64 - 1)) >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
                np.add.at(gone, windows, 1)
                np.add.at(gone, windows + length, -1)
            kept = np.cumsum(gone[:-1]) == 0
            left = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
            n_removed.append(len(words) - len(left))
            shas.append(_digest(left))
            texts.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(n_removed, pa.int64()), pa.array(shas), pa.array(texts, pa.string())], ["id", "row", "n_removed", "sha", "kept"])


def cut_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows as (id, row, n_words, sha), and of those that lose words (id, row, n_removed, sha, kept).

    row tells rows with one id apart by their text.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("row", F.xxhash64("text"))
    whole = texts.mapInArrow(_whole, "id long, row long, n_words long, sha string")
    shape = "gram long, content long, id long, row long, start int, n int"
    listed = persisted(texts.where("id is not null").mapInArrow(lambda b: _listed(b, length), shape), "passages", shuffle=False)
    grams = listed.groupBy("gram").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("gram")
    shared = persisted(listed.join(grams, "gram"), "shared_passages", shuffle=False)
    holder = F.min(F.struct("id", "row", "start", "n")).alias("h")
    held = shared.groupBy("gram", "content").agg(holder).select("h.id", "h.row", F.struct("gram", "content", "h.start", "h.n").alias("held"))
    held = persisted(held.groupBy("id", "row").agg(F.collect_list("held").alias("held")), "held_passages", shuffle=False)
    total = held.select(F.coalesce(F.sum(F.expr(f"aggregate(held, 0L, (a, x) -> a + x.n + {length - 1})")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    touched = shared.select("id", "row").distinct().join(held, ["id", "row"], "left")
    touched = persisted(texts.join(touched, ["id", "row"]).dropDuplicates(["id", "row"]), "touched_texts", shuffle=False)

    sent = touched.where("held is not null").mapInArrow(lambda b: _shipped(b, length, shards), "shard long, gram long, content long, least long, words binary")
    found = sent.groupBy("shard").applyInArrow(lambda t: _searched(t, length), "gram long, content long, least array<long>")
    met = shared.join(found, ["gram", "content"]).where(F.array_min("least") < F.col("id"))
    mask = F.expr("aggregate(transform(least, (x, j) -> if(x < id, shiftleft(1L, j), 0L)), 0L, (a, x) -> a | x)")
    cuts = met.select("id", "row", F.struct("start", mask.alias("mask")).alias("cut")).groupBy("id", "row").agg(F.collect_list("cut").alias("cuts"))
    cut = touched.select("id", "row", "text").join(cuts, ["id", "row"]).mapInArrow(lambda b: _cut(b, length), "id long, row long, n_removed long, sha string, kept string")
    return whole, cut


def removed_words(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_words, n_removed and the digest of the kept words, one space between them."""
    whole, cut = cut_repeats(docs, length, id_col, text_col)
    cut = cut.select(F.col("id").alias("cut_id"), F.col("row").alias("cut_row"), "n_removed", F.col("sha").alias("cut_sha"))
    both = whole.join(cut, (F.col("id") == F.col("cut_id")) & (F.col("row") == F.col("cut_row")), "left")
    return both.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("cut_sha", "sha").alias("kept_sha256")
    )
