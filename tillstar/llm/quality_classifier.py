"""Quality by co-training: one classifier sees the text, another the metadata; each teaches the other.

Both are logistic regressions trained on a bounded sample of labelled documents. In every round each view judges all
unlabelled documents, labels those that it is surest of, and the other view learns from them. Views are calibrated
on held-out labelled documents, and their log odds add up, less the prior's, to the score of every document.

The text view is a histogram of characters and word lengths with figures on repetition; the metadata
view is language, source and size.

A null text counts as empty; null language or source are values of their own. Documents without a label are scored
like any other. Without labels of both kinds nothing can be learned: the score is null and every document
is kept. Rows with null or repeated ids are scored by their own columns; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillstar.llm.textops import mix, slices, text_buffer, words_of
from tillstar.sources.workspace import persisted

#: Bound of the labelled sample, in documents, drawn by hash of the id.
MOST_LABELLED = 4000
#: Rounds, and documents that a view teaches the other in each of them: the surest of all unlabelled ones.
ROUNDS, TAUGHT = 4, 100
#: Probability from which a view's label is passed on.
SURE = 0.97
#: Share of the labelled sample that only calibrates.
HELD_OUT = 0.25
MIN_GOOD = 0.5
LENGTHS, META = 24, 96
TEXT = 129 + LENGTHS + 4


def text_features(texts: pa.Array) -> np.ndarray:
    """Shares of each ASCII character, of other bytes and of word lengths; repeated words, distinct words, size."""
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    out = np.zeros((n, TEXT), np.float32)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    code = np.minimum(data, 128).astype(np.int64)
    out[:, :129] = np.bincount(owner * 129 + code, minlength=n * 129).reshape(n, 129) / np.maximum(1, sizes)[:, None]
    words = words_of(texts)
    counts = np.diff(words.first)
    of = np.repeat(np.arange(n), counts)
    lengths = np.minimum(words.ends - words.starts, LENGTHS) - 1
    per_word = np.maximum(1, counts)
    out[:, 129 : 129 + LENGTHS] = np.bincount(of * LENGTHS + lengths, minlength=n * LENGTHS).reshape(n, LENGTHS) / per_word[:, None]
    h, rest = words.hashes, 129 + LENGTHS
    for lag in (1, 2):
        same = np.zeros(len(h), bool)
        same[lag:] = (h[lag:] == h[:-lag]) & (of[lag:] == of[:-lag])
        out[:, rest + lag - 1] = np.bincount(of[same], minlength=n) / per_word
    keyed = np.unique(mix(h + mix(of.astype(np.uint64))), return_index=True)[1]
    out[:, rest + 2] = np.bincount(of[keyed], minlength=n) / per_word
    out[:, rest + 3] = np.log1p(counts) / 10
    return out


def meta_features(langs: list, sources: list, sizes: np.ndarray) -> np.ndarray:
    """Hashed language and source, and the magnitude of the size."""
    out = np.zeros((len(langs), META), np.float32)
    rows = np.arange(len(langs))
    out[rows, [zlib.crc32(b"\x00" if x is None else x.encode()) % 16 for x in langs]] = 1
    out[rows, [16 + zlib.crc32(b"\x00" if x is None else x.encode()) % 64 for x in sources]] = 1
    out[rows, 80 + np.minimum(15, np.log2(np.maximum(1, sizes)).astype(np.int64))] = 1
    return out


class Logistic(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return np.clip(self.slope * z + self.shift, -30, 30)


def _newton(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, gradient)
        w += move / max(1.0, float(np.abs(move).max()) / 5)
        if np.abs(move).max() < 1e-5:
            break
    return w


def train(x: np.ndarray, y: np.ndarray) -> Logistic:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    return Logistic(mean, scale, _newton((x - mean) / scale, y, ridge=1.0))


def calibrate(model: Logistic, x: np.ndarray, y: np.ndarray) -> Logistic:
    """Platt scaling on held-out rows."""
    slope, shift = _newton(model.log_odds(x)[:, None], y, ridge=1e-2)
    return model._replace(slope=max(float(slope), 0.0), shift=float(shift))


class Teaching(NamedTuple):
    """What co-training has come to: rows and labels by view, held-out rows, and models."""

    rows: list[np.ndarray]
    labels: list[np.ndarray]
    held: tuple[list[np.ndarray], np.ndarray]
    models: list[Logistic]

    def trained(self) -> Teaching:
        views, y = self.held
        return self._replace(models=[calibrate(train(x, t), v, y) for x, t, v in zip(self.rows, self.labels, views, strict=True)])

    def taught(self, pupil: int, x: np.ndarray, good: np.ndarray) -> None:
        self.rows[pupil] = np.concatenate([self.rows[pupil], x])
        self.labels[pupil] = np.concatenate([self.labels[pupil], good])


def begin(views: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> Teaching:
    """Models of labelled rows alone. Rows come in drawn order, so the last ones are held out."""
    cut = max(2, int(len(y) * (1 - HELD_OUT)))
    if len(set(y[:cut])) < 2 or len(set(y[cut:])) < 2:
        cut = len(y)
    held = slice(cut, None) if cut < len(y) else slice(None)
    return Teaching([x[:cut] for x in views], [y[:cut].astype(float) for _ in views], ([x[held] for x in views], y[held]), []).trained()


def prior_of(y: np.ndarray) -> float:
    return float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))


def _views(part: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    sizes = np.asarray(part.column("n_chars"), np.int64)
    return text_features(part.column(text)), meta_features(part.column("lang").to_pylist(), part.column("source").to_pylist(), sizes)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of both views as half-precision numbers in a row."""
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            both = np.concatenate(_views(part), axis=1).astype("<f2")
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * (TEXT + META)), len(both), [None, pa.py_buffer(both.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column("draw"), packed.cast(pa.binary())], ["draw", "features"])


def _unpacked(features: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(features), "<f2").reshape(len(features), TEXT + META).astype(float)
    return both[:, :TEXT], both[:, TEXT:]


def _surest(batches: Iterator[pa.RecordBatch], models: list[Logistic], taken: frozenset[int], quota: dict[bool, int]) -> Iterator[pa.RecordBatch]:
    """Of each batch, the rows that a view is surest of, by view and kind."""
    shape = pa.schema([("view", pa.int32()), ("good", pa.bool_()), ("odds", pa.float64()), ("draw", pa.int64()), ("features", pa.binary())])
    for batch in batches:
        draws = batch.column("draw").to_numpy(zero_copy_only=False)
        free = np.array([d not in taken for d in draws.tolist()], bool)
        for view, (model, x) in enumerate(zip(models, _unpacked(batch.column("features").to_pylist()), strict=True)):
            odds = model.log_odds(x)
            for good, most in quota.items():
                at = np.flatnonzero(free & ((odds > 0) == good) & (np.abs(odds) >= np.log(SURE / (1 - SURE))))
                # Repeated rows are one lesson.
                at = at[np.unique(draws[at], return_index=True)[1]]
                at = at[np.lexsort((draws[at], -np.abs(odds[at])))][:most]
                columns = [pa.array(np.full(len(at), view, np.int32)), pa.array(np.full(len(at), good)), pa.array(np.abs(odds[at])), batch.column("draw").take(pa.array(at)), batch.column("features").take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(columns, schema=shape)


def _scored(batches: Iterator[pa.RecordBatch], models: list[Logistic], prior: float, column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, column, 2 << 20):
            text, meta = (m.log_odds(x) for m, x in zip(models, _views(part, column), strict=True))
            p = [1 / (1 + np.exp(-z)) for z in (text, meta, np.clip(text + meta - prior, -30, 30))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c.startswith("own_")), *map(pa.array, p)], [c for c in part.schema.names if c.startswith("own_")] + ["p_text", "p_meta", "p_good"])


def _inputs(docs: DataFrame, id_col: str) -> list:
    has = set(docs.columns)
    text = F.col("text").cast("string")
    pick = lambda c: (F.col(c) if c in has else F.lit(None)).cast("string").alias(c)
    return [text.alias("text"), pick("lang"), pick("source"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars")]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[list[Logistic], float] | None:
    """Models from labels (id, quality) and from all documents without a label, which every round reads as features."""
    draw = F.xxhash64(F.col(id_col), F.lit("quality"))
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("quality"))
    known = known.select(draw.alias("draw"), (F.col("quality") > 0).cast("int").alias("good")).orderBy("draw").limit(MOST_LABELLED)
    # Rows without an id differ by their texts.
    place = F.when(F.col(id_col).isNull(), F.xxhash64("text")).otherwise(draw)
    inputs = docs.select(place.alias("draw"), *_inputs(docs, id_col))
    features = persisted(inputs.mapInArrow(_featured, "draw long, features binary"), "quality_features", shuffle=False)

    sample = features.join(F.broadcast(known), "draw").orderBy("draw", "features").limit(2 * MOST_LABELLED).collect()
    y = np.array([r["good"] for r in sample], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    state, prior = begin(_unpacked([bytes(r["features"]) for r in sample]), y), prior_of(y)
    labelled = labels.where(F.col(id_col).isNotNull()).select(draw.alias("draw")).distinct()
    pool = persisted(features.join(labelled, "draw", "left_anti"), "quality_pool", shuffle=False)
    # As many of each kind as the labelled documents have, the surest first.
    quota = {True: max(1, int(TAUGHT / (1 + np.exp(-prior)))), False: max(1, int(TAUGHT / (1 + np.exp(prior))))}
    best = Window.partitionBy("view", "good").orderBy(F.col("odds").desc(), "draw", "features")
    taken: frozenset[int] = frozenset()
    for _ in range(ROUNDS):
        models = state.models
        found = pool.mapInArrow(lambda b, m=models, t=taken: _surest(b, m, t, quota), "view int, good boolean, odds double, draw long, features binary")
        # One row a document: which of equal copies teaches makes no difference.
        once = found.groupBy("view", "good", "draw").agg(F.max("odds").alias("odds"), F.min("features").alias("features"))
        lessons = once.withColumn("rank", F.row_number().over(best)).where(F.when(F.col("good"), quota[True]).otherwise(quota[False]) >= F.col("rank")).orderBy("view", "good", "rank").collect()
        if not lessons:
            break
        for view in (0, 1):
            own = [r for r in lessons if r["view"] == view]
            if own:
                x = _unpacked([bytes(r["features"]) for r in own])[1 - view]
                state.taught(1 - view, x, np.array([float(r["good"]) for r in own]))
        taken |= {r["draw"] for r in lessons}
        state = state.trained()
    return state.models, prior


def score(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...], id_col: str = "doc_id", min_good: float = MIN_GOOD) -> DataFrame:
    """The columns ``keep`` of docs with p_text, p_meta, p_good and kept, for every row. One pass, no shuffle."""
    learned = learn(docs, labels, id_col)
    if learned is None:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("p_text", "p_meta", "p_good")]
        return docs.select(*keep, *nothing, F.lit(True).alias("kept"))
    models, prior = learned
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    shape = ", ".join([*(f"`own_{c}` {types[c]}" for c in keep), "p_text double", "p_meta double", "p_good double"])
    # A text that is kept goes to the workers once.
    carried = "text" in keep and types["text"] == "string"
    column, inputs = ("own_text", _inputs(docs, id_col)[1:]) if carried else ("text", _inputs(docs, id_col))
    rows = docs.select(*(F.col(c).alias(f"own_{c}") for c in keep), *inputs).mapInArrow(lambda b: _scored(b, models, prior, column), shape)
    return rows.select(*(F.col(f"own_{c}").alias(c) for c in keep), "p_text", "p_meta", "p_good", (F.col("p_good") >= min_good).alias("kept"))
