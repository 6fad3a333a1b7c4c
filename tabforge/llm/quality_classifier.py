"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: byte n-grams of one to three
bytes, and word pairs of equal words. Every feature is scaled by its log-count
ratio between the classes, counted over all labelled training rows, and a linear
model is fitted to a bounded sample of them with the hinge loss by dual
coordinate descent. Margins become probabilities by a logistic fit on sample
rows that the model was not fitted to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import broadcast_if_small, draw, table, text_of, written
from tabforge.llm.textbytes import Words, mixed, text_chunks

#: Features are hashed into 2**BITS places.
BITS = 17
GRAMS = (1, 2, 3)
#: Rows that the linear model is fitted to at most, drawn by a hash of their ids; a third of them calibrate it.
SAMPLE = 9_000
ALPHA, COST, BETA, EPOCHS = 1.0, 1.0, 0.25, 8
THRESHOLD = 0.7


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the places of its n-grams, in any order and with repeats."""
    mask = np.uint64((1 << BITS) - 1)
    for _, _, raw, ends in text_chunks(column):
        places = []
        wide = raw.astype(np.uint64)
        code = np.zeros(len(raw), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            shifted = wide[n - 1 :]
            code = (code[: len(shifted)] << np.uint64(8)) | shifted
            # up to 2**16 codes have places of their own in the lower half, longer ones share the upper half
            places.append((code + np.uint64(256 * (n == 2)) if n < 3 else (mixed(code) & (mask >> np.uint64(1))) + (mask >> np.uint64(1)) + np.uint64(1)).astype(np.uint32))
        w = Words(raw, ends)
        twin = np.concatenate([w.hash[1:] == w.hash[:-1], [False]]) if len(w.hash) else np.zeros(0, bool)
        begin = 0
        for k, end in enumerate(ends):
            stop = end - 1  # without the separator
            own = [p[begin : max(begin, stop - n + 1)] for n, p in zip(range(1, max(GRAMS) + 1), places)]
            a, b = w.of[k], w.of[k + 1]
            pairs = int(twin[a : max(a, b - 1)].sum())
            # one indicator for each power of two that the share of equal pairs passes
            levels = np.arange(1, 9)
            own.append((mixed(levels.astype(np.uint64) + np.uint64(1 << 40)) & mask).astype(np.uint32)[pairs * 2**levels >= max(1, b - a)])
            yield np.concatenate(own)
            begin = end


def class_counts(rows: DataFrame) -> DataFrame:
    """(place, good, bad): rows of either class that have the feature; from rows of (text, quality)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 << BITS), np.int64)
        seen = np.zeros(1 << BITS, bool)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for places, label in zip(features(batch.column("text")), batch.column("quality").to_pylist()):
                seen[places] = True
                total[int(label)] += seen
                rows[int(label)] += 1
                seen[places] = False
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[1, at], rows[1])), pa.array(np.append(total[0, at], rows[0]))], names=["place", "good", "bad"])

    parts = rows.mapInArrow(count, "place long, good long, bad long")
    return parts.groupBy("place").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def log_count_ratio(counts: pd.DataFrame) -> np.ndarray:
    good, bad = np.full(1 << BITS, ALPHA), np.full(1 << BITS, ALPHA)
    own = counts[counts["place"] >= 0]
    good[own["place"]] += own["good"]
    bad[own["place"]] += own["bad"]
    rows = counts[counts["place"] < 0]
    g, b = (float(rows[k].sum()) + 2 * ALPHA for k in ("good", "bad"))
    return np.log(good / g) - np.log(bad / b)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss model over the scaled indicators, the last one the constant's.

    One dual variable a row, between 0 and COST; a step solves one of them
    exactly and moves the weights along. Rows are scaled to unit length.
    """
    values = [ratio[r] for r in rows]
    norms = [max(1e-9, float(np.sqrt(v @ v + 1))) for v in values]
    values = [v / n for v, n in zip(values, norms)]
    w, dual, order = np.zeros(len(ratio) + 1), np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            x, v, one = rows[i], values[i], 1 / norms[i]
            slope = y[i] * (w[x] @ v + w[-1] * one) - 1
            new = min(max(dual[i] - slope, 0.0), COST)  # the row's squared length is one
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[x] += step * v
                w[-1] += step * one
                dual[i] = new
    return w


def logistic_fit(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of class 1 by margin, with smoothed targets, by Newton's method."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))])
    theta = np.array([1.0, np.log((good + 1) / (bad + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        gradient = x @ (p - target) + 1e-3 * theta
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2), gradient)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


class Model:
    """``weight`` of each place's indicator before scaling to unit length, and what makes a margin a probability."""

    def __init__(self, ratio: np.ndarray, w: np.ndarray, slope: float, offset: float):
        self.ratio, self.slope, self.offset = ratio.astype(np.float32), slope, offset
        self.weight, self.constant = (w[:-1] * ratio).astype(np.float32), float(w[-1])

    def margins(self, column: pa.Array) -> np.ndarray:
        seen, square = np.zeros(1 << BITS, np.float32), self.ratio**2
        out = []
        for places in features(column):
            seen[places] = 1
            out.append((float(seen @ self.weight) + self.constant) / np.sqrt(float(seen @ square) + 1))
            seen[places] = 0
        return np.array(out)

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(column) + self.offset, -30, 30)))


def fit(docs: DataFrame, known: DataFrame, sample: int = SAMPLE, seed: str = "quality") -> Model | None:
    """The model for the rows of ``docs`` (doc_id, text) with a label in ``known`` (doc_id, quality 0/1; a written
    table); None unless both classes occur.

    Ratios count all labelled rows. The linear model is fitted in one task to
    the rows of at most ``sample`` labels. What reaches the driver has 2**BITS
    entries at most.
    """
    text = docs.select("doc_id", text_of("text").alias("text"))
    counts = class_counts(text.join(broadcast_if_small(known, 16), "doc_id").select("text", "quality")).toPandas()
    sizes = counts[counts["place"] < 0]
    if not len(sizes) or not sizes["good"].sum() or not sizes["bad"].sum():
        return None
    ratio = log_count_ratio(counts)
    picked = written(known.orderBy(draw(seed, F.col("doc_id")), "doc_id", "quality").limit(sample), "quality-sample")
    drawn = text.join(broadcast_if_small(picked, 16), "doc_id").select("text", "quality", "doc_id")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        places, y = [], []
        for batch in batches:
            places += [np.unique(p) for p in features(batch.column("text"))]
            y += batch.column("quality").to_pylist()
        y = np.where(np.array(y) > 0, 1.0, -1.0)
        held = np.arange(len(y)) % 3 == 0
        if len(set(y[~held])) < 2:
            held[:] = False
        w = dual_coordinate_descent([p for p, h in zip(places, held) if not h], y[~held], ratio)
        mean = np.abs(w[:-1]).mean()
        w[:-1] = (1 - BETA) * mean + BETA * w[:-1]  # towards plain naive Bayes
        test = held if held.any() else ~held
        x = [p for p, t in zip(places, test) if t]
        margins = np.array([((w[p] @ ratio[p]) + w[-1]) / np.sqrt(ratio[p] @ ratio[p] + 1) for p in x])
        slope, offset = logistic_fit(margins, y[test])
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([slope]), pa.array([offset])], names=["w", "slope", "offset"])

    got = drawn.repartition(1).sortWithinPartitions("doc_id", "quality").mapInArrow(train, "w binary, slope double, offset double").first()
    return Model(ratio, np.frombuffer(got["w"]), got["slope"], got["offset"])


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(row, score, predicted) for every row of ``docs``, which travels as the struct ``row`` with all its columns.

    Score is 0 to 1, predicted 1 from THRESHOLD on. Null text is empty and
    scored like any other. Without a model every row has score 1: nothing is
    known against it.
    """
    rows = docs.select(F.struct("*").alias("row"))
    if model is None:
        return rows.withColumns({"score": F.lit(1.0), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # two vectors of 2**BITS floats, three numbers
    text_at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.__new__(Model)
        vars(own).update(shared.value)
        for batch in batches:
            s = own.scores(batch.column(0).flatten()[text_at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             schema=pa.schema([batch.schema.field(0), ("score", pa.float64()), ("predicted", pa.int32())]))

    return rows.mapInArrow(score, rows.select("row", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from, as a written table. Rows labelled twice count twice."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    return written(known.select("doc_id", "quality"), "quality-labels")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify(docs, fit(docs, training_labels(table(spark, sf_dir, "labels"))))
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted")
