"""Quality classifier: Naive Bayes support vectors.

The n-grams of a text are indicators; each is scaled by the log-count ratio of the two classes, and a linear model of
hinge loss is fitted to the scaled indicators by dual coordinate descent. N-grams are of words, and of the shapes of
words (runs of capitals, small letters, digits and each other character), hashed into a table of fixed size. A logistic
curve through margins of rows that the fit did not see turns a margin into a score.

The fit is done in one task on a sample of at most `SAMPLE` rows of each label, those of the smallest hashed ids;
scoring covers every row.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstats.llm.common import add_columns, fresh
from fleetstats.llm.substring_dedup import BASE, mixed, word_hashes

SAMPLE = 3000  # rows of each label that the model is fitted to
TABLE_BITS = 18
WORD_GRAMS, SHAPE_GRAMS = 2, 3
SMOOTHING, COST, EPOCHS = 1.0, 1.0, 12
THRESHOLD = 0.3

# What each byte is to the shape of a word.
SHAPES = bytes(
    32 if b in b" \t\n\x0b\x0c\r" else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57
    else 97 if 97 <= b <= 122 or b >= 128 else b for b in range(256)
)


def grams(hashes: np.ndarray, longest: int, kind: int) -> list[np.ndarray]:
    """Hashes of the n-grams of up to `longest` words."""
    out, held = [], np.full(len(hashes), kind + 1, dtype=np.uint64)
    for n in range(min(longest, len(hashes))):
        held = mixed(held[: len(hashes) - n] * BASE + hashes[n:])
        out.append(held)
    return out


def features(text: str | None) -> np.ndarray:
    """The places in the table of the n-grams of a text, each once."""
    data = (text or "").encode("utf-8", "surrogatepass")
    classes = np.frombuffer(data.translate(SHAPES), dtype=np.uint8)
    shape = classes[np.concatenate([[True], classes[1:] != classes[:-1]])].tobytes() if len(classes) else b""
    found = [*grams(word_hashes(data.lower()), WORD_GRAMS, 0), *grams(word_hashes(shape), SHAPE_GRAMS, 1)]
    if not found:
        return np.zeros(0, dtype=np.int32)
    return np.unique(np.concatenate(found) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


class Model:
    """Weights by place, a bias, and the logistic curve from margins to scores."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.ratios, self.weights = ratios.astype(np.float32), weights.astype(np.float32)
        self.bias, self.slope, self.offset = bias, slope, offset

    def margin(self, places: np.ndarray) -> float:
        scaled = self.ratios[places]
        return float(scaled @ self.weights[places]) / max(float(np.linalg.norm(scaled)), 1e-12) + self.bias

    def score(self, text: str | None) -> float:
        return logistic(self.slope * self.margin(features(text)) + self.offset)


class Constant:
    """What stands for a model where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def score(self, text: str | None) -> float:
        return self.value


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -30.0), 30.0))))


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    counts = [np.full(1 << TABLE_BITS, SMOOTHING) for _ in range(2)]
    for places, label in zip(rows, positive):
        counts[int(label)][places] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model of hinge loss; rows have unit length and a constant beside."""
    weights, bias = np.zeros(1 << TABLE_BITS), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    random = np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in random.permutation(len(rows)):
            places, value, sign = rows[i], values[i], signs[i]
            gradient = sign * (weights[places] @ value + bias) - 1
            step = min(max(alpha[i] - gradient / square[i], 0.0), COST) - alpha[i]
            if step:
                alpha[i] += step
                weights[places] += step * sign * value
                bias += step * sign
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve, by Newton's method on smoothed targets."""
    ones = positive.sum()
    target = np.where(positive, (ones + 1) / (ones + 2), 1 / (len(positive) - ones + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (p - target) + 1e-6 * at
        bend = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], labels: list[int]):
    """The model of some rows of features and their labels."""
    positive = np.array(labels, dtype=bool)
    if positive.all() or not positive.any():
        return Constant(float(positive.mean()) if len(positive) else 0.5)
    # every fifth row of each label is kept for the curve
    order = np.zeros(len(rows), dtype=int)
    for label in (False, True):
        order[positive == label] = np.arange((positive == label).sum())
    aside = order % 5 == 4
    if len(set(positive[aside])) < 2:
        aside[:] = False
    taught = [rows[i] for i in np.flatnonzero(~aside)]
    ratios = log_count_ratios(taught, positive[~aside])
    values = [ratios[r] / max(np.linalg.norm(ratios[r]), 1e-12) for r in taught]
    weights, bias = dual_coordinate_descent(taught, values, np.where(positive[~aside], 1.0, -1.0))
    model = Model(ratios, weights, bias, 1.0, 0.0)
    tested = np.flatnonzero(aside) if aside.any() else np.arange(len(rows))
    margins = np.array([model.margin(rows[i]) for i in tested])
    model.slope, model.offset = logistic_curve(margins, positive[tested])
    return model


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from: one id in five. A null id is not held out."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality"):
    """A model of the labels, learned from a bounded sample of the rows that are not held out.

    Several labels of one id count as the more frequent one; ids of evenly split or null labels teach nothing. Without
    any labelled row the model scores 0.5, with rows of one label only that label.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
        .agg(F.avg(label).alias("label")).where("id IS NOT NULL AND label <> 0.5")
        .select("id", F.round("label").cast("int").alias("label"))
    )
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most two times SAMPLE rows of two numbers
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")
    found = add_columns(
        rows, "t", T.StructType([T.StructField("places", T.ArrayType(T.IntegerType()))]),
        lambda texts: [[features(t) for t in texts]],
    ).select(F.xxhash64("id", "t").alias("key"), "label", "places")

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught = []
        for batch in batches:
            keys, values = batch.column("key").to_pylist(), batch.column("label").to_pylist()
            taught += [(k, v, p.values.to_numpy()) for k, v, p in zip(keys, values, batch.column("places"))]
        taught.sort(key=lambda row: (row[0], row[1]))
        model = fit([row[2] for row in taught], [row[1] for row in taught])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    fitted = found.repartition(1).mapInArrow(fit_all, "model binary").collect()
    return pickle.loads(fitted[0][0]) if fitted else Constant(0.5)


def score(docs: DataFrame, model, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with the score of their text, from 0 to 1; null and empty texts have that of no n-grams.

    Rows are independent: repeated rows give repeated results, an empty table an empty one.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = T.StructType([T.StructField(out, T.DoubleType(), False)])
    return add_columns(docs, text, added, functools.partial(scored, held))


def scored(held, texts: list[str | None]) -> list[list[float]]:
    model = held.value
    return [[model.score(t) for t in texts]]


def keep_good(docs: DataFrame, model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold."""
    name = fresh(docs.columns, "_score")
    return score(docs, model, text, name).where(F.col(name) >= threshold).drop(name)
