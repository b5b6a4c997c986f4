"""Batch scoring of feature vectors with pluggable scorers: scorer(matrix) -> matrix of logits."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions.responses import sigmoid_predict, softmax_predict
from tagflow.operators.evaluation import threshold_sweep
from tagflow.sources.scratch import discard, written

Scorer = Callable[[np.ndarray], np.ndarray]


@dataclass
class LinearHead:
    """The shipped scorer. Its classes are in the order of its columns."""

    classes: Sequence[str]
    weights: np.ndarray  # features x classes
    bias: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def logits(features: DataFrame, scorer: Scorer, key: str = "name", column: str = "features") -> DataFrame:
    """key, logits. The scorer is sent to the tasks once."""
    shared = features.sparkSession.sparkContext.broadcast(scorer)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({key: frame[key], "logits": list(np.asarray(shared.value(np.stack(frame[column].to_numpy()).astype(float)), float))})

    kind = dict(features.dtypes)[key]
    return features.select(key, column).mapInPandas(score, f"{key} {kind}, logits array<double>")


def score_single(features: DataFrame, scorer: Scorer, classes: Sequence[str], key: str = "name") -> DataFrame:
    """key, prediction, confidence, probs."""
    return logits(features, scorer, key).select(key, softmax_predict(F.col("logits"), classes).alias("r")).select(key, "r.*")


def score_multi(features: DataFrame, scorer: Scorer, attrs: Sequence[str], threshold: float = 0.5, key: str = "name") -> DataFrame:
    """Long form: key, attr, score, pred."""
    cells = F.arrays_zip(F.array(*[F.lit(a) for a in attrs]).alias("attr"), F.col("logits").alias("logit"))
    long = logits(features, scorer, key).select(key, F.explode(cells).alias("c")).select(key, F.col("c.attr").alias("attr"), sigmoid_predict(F.col("c.logit"), threshold).alias("r"))
    return long.select(key, "attr", "r.score", "r.pred")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def score_cascade(features: DataFrame, stage1: LinearHead, stage2: Mapping[str, LinearHead], key: str = "name") -> DataFrame:
    """key, category, category_conf, subcategory, subcategory_conf in one pass without a shuffle.

    Within each batch the rows of a predicted category go to its second stage; a category
    without one has the subcategory unknown, 0.0.
    """
    shared = features.sparkSession.sparkContext.broadcast((stage1, dict(stage2)))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = shared.value
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["features"].to_numpy()).astype(float)
            p = _softmax(one(x))
            top = p.argmax(1)
            sub, conf = np.full(len(x), "unknown", object), np.zeros(len(x))
            for k in np.unique(top):
                head = two.get(one.classes[k])
                if head is not None:
                    rows = np.flatnonzero(top == k)
                    q = _softmax(head(x[rows]))
                    sub[rows] = np.array(head.classes, object)[q.argmax(1)]
                    conf[rows] = q.max(1)
            yield pd.DataFrame({key: frame[key], "category": np.array(one.classes, object)[top], "category_conf": p.max(1).round(4), "subcategory": sub, "subcategory_conf": conf.round(4)})

    kind = dict(features.dtypes)[key]
    return features.select(key, "features").mapInPandas(score, f"{key} {kind}, category string, category_conf double, subcategory string, subcategory_conf double")


def zero_shot(embeddings: DataFrame, pairs: Mapping[str, tuple[np.ndarray, np.ndarray]], scale: float = 100.0, threshold: float = 0.5, key: str = "name", column: str = "embedding") -> DataFrame:
    """Long form: key, attr, score (4 places), pred (score before rounding >= threshold).

    pairs: for each attribute the vectors of a positive and a negative text. Vectors are
    compared by cosine; the score is the positive's share of a softmax over the pair.
    """
    attrs = list(pairs)
    unit = lambda v: np.asarray(v, float) / max(np.linalg.norm(v), 1e-12)
    matrix = np.stack([unit(pairs[a][0]) - unit(pairs[a][1]) for a in attrs], 1)
    scorer = _ZeroShot(matrix, scale)
    long = logits(embeddings, scorer, key, column).select(key, F.posexplode("logits").alias("i", "z"))
    p = 1 / (1 + F.exp(-F.col("z")))
    return long.select(key, F.element_at(F.array(*[F.lit(a) for a in attrs]), F.col("i") + 1).alias("attr"), F.round(p, 4).alias("score"), (p >= threshold).cast("int").alias("pred"))


@dataclass
class _ZeroShot:
    matrix: np.ndarray
    scale: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scale * (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)) @ self.matrix


def fit_head(embeddings: DataFrame, label: str, classes: Sequence[str], weights: DataFrame | None = None, column: str = "embedding", steps: Sequence[float] = (0.0, 0.01), split: str | None = None, tolerance: float = 1e-6) -> LinearHead:
    """A class-weighted classification head on frozen embeddings, trained by Spark ML.

    embeddings: column, label and, with split, a column train/val: then the regularisation in
    steps with the best accuracy on val is taken, the first of equals.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label))
    data = embeddings.where(place > 0).withColumn("y", (place - 1).cast("double")).withColumn("x", array_to_vector(F.col(column).cast("array<double>")))
    data = data.withColumn("w", F.lit(1.0)) if weights is None else data.join(weights.select(label, F.col("weight").alias("w")), label)
    rows = data.where(F.col(split) == "train") if split else data
    best, best_score = None, -1.0
    for reg in steps if split else steps[:1]:
        model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=reg, maxIter=100, tol=tolerance, family="multinomial").fit(rows)
        # scored by the head itself: the model holds its session, which cannot be sent to tasks once it has observed a query
        head = LinearHead(list(classes), model.coefficientMatrix.toArray().T, model.interceptVector.toArray())
        score = 0.0
        if split:
            held = data.where(F.col(split) == "val").select("y", F.col(column).cast("array<double>").alias("features"))
            right = F.array_position("logits", F.array_max("logits")) - 1 == F.col("y")
            score = logits(held, head, "y").agg(F.avg(right.cast("double"))).first()[0] or 0.0
        if score > best_score:
            best, best_score = head, score
    return best


def multi_loss(x: np.ndarray, y: np.ndarray, positive: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over rows and attributes of the weighted cross-entropy of x @ theta[:-1] + theta[-1] with y (0 or 1), and its gradient.

    positive: what a positive counts, by attribute; a negative counts 1.
    """
    z = x @ theta[:-1] + theta[-1]
    # log(1 + e**-z) and log(1 + e**z)
    soft = np.logaddexp(0, -z)
    loss = positive * y * soft + (1 - y) * (soft + z)
    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    slope = (1 - y) * p - positive * y * (1 - p)
    return float(loss.sum()), np.concatenate([x.T @ slope, slope.sum(0, keepdims=True)])


def _partial_losses(data: DataFrame, lanes: int, n_attrs: int, positive: np.ndarray, theta: np.ndarray) -> tuple[int, float, np.ndarray]:
    """(rows, loss, gradient) over data(x, y): a sum for each task, then for each of lanes, then in the driver."""
    shared = data.sparkSession.sparkContext.broadcast((positive, theta))
    schema = "lane int, n long, loss double, gradient binary"

    def one(lane: int, n: int, loss: float, gradient: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lane], pa.int32()), pa.array([n]), pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], ["lane", "n", "loss", "gradient"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        positive, theta = shared.value
        n, loss, gradient = 0, 0.0, np.zeros_like(theta)
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                own = multi_loss(x, batch.column("y").flatten().to_numpy().reshape(-1, n_attrs), positive, theta)
                n, loss, gradient = n + batch.num_rows, loss + own[0], gradient + own[1]
        yield one(TaskContext.get().partitionId() % lanes, n, loss, gradient)

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(g) for g in rows.column("gradient").to_pylist())
        return pa.Table.from_batches([one(rows.column("lane")[0].as_py(), sum(rows.column("n").to_pylist()), math.fsum(rows.column("loss").to_pylist()), total)])

    rows = data.mapInArrow(part, schema).groupBy("lane").applyInArrow(add, schema).collect()
    return sum(r.n for r in rows), math.fsum(r.loss for r in rows), sum((np.frombuffer(r.gradient) for r in rows), np.zeros(theta.size)).reshape(theta.shape)


def minimise(function: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """Where a smooth convex function (value, gradient) is least, by limited-memory quasi-Newton steps from start.

    Ends when no part of the gradient is above tolerance, when no step lowers the value any more, or after rounds steps.
    """
    at, (value, slope) = start, function(start)
    past: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=memory)
    for _ in range(rounds):
        if np.abs(slope).max(initial=0.0) <= tolerance:
            break
        way, factors = slope.copy(), []
        for s, y in reversed(past):
            a = (s * way).sum() / (s * y).sum()
            factors.append(a)
            way -= a * y
        if past:
            s, y = past[-1]
            way *= (s * y).sum() / (y * y).sum()
        else:
            way /= max(1.0, np.linalg.norm(way))
        for (s, y), a in zip(past, reversed(factors), strict=True):
            way += s * (a - (y * way).sum() / (s * y).sum())
        step, down = 1.0, (slope * way).sum()
        while step > 1e-8:
            new = at - step * way
            new_value, new_slope = function(new)
            if new_value <= value - 1e-4 * step * down:
                break
            step /= 2
        else:
            break
        s, y = new - at, new_slope - slope
        if (s * y).sum() > 1e-14:
            past.append((s, y))
        at, value, slope = new, new_value, new_slope
    return at


def fit_multi_head(
    embeddings: DataFrame, labels: str, attrs: Sequence[str], positive: Mapping[str, float] | None = None, column: str = "embedding", steps: Sequence[float] = (0.0, 1e-3),
    split: str | None = None, rounds: int = 200, tolerance: float = 1e-6,
) -> LinearHead:
    """A head of one output for each attribute, by full-batch logistic regression with positive weights.

    embeddings: column, labels (an array of attributes; null: none) and, with split, a column train/val: then the shrinkage in steps with the best macro F1 on
    val, at the best thresholds, is taken, the first of equals. Rows without a vector are left out. What is minimised is the mean over rows of the sum over
    attributes of the weighted cross-entropy, and half the shrinkage times the squared weights. Each step is a job that sends one
    gradient a task; the rows stay where they are. An attribute that no row or every row has gets a large bias.
    """
    tokens = F.coalesce(F.col(labels), F.array().cast("array<string>"))
    flags = F.array(*[F.array_contains(tokens, a).cast("double") for a in attrs])
    rows = embeddings.where(F.col(column).isNotNull())
    if split:
        rows = rows.where(F.col(split) == "train")
    data = written(rows.select(F.col(column).cast("array<double>").alias("x"), flags.alias("y")), "training_rows")
    width, tasks = data.select(F.size("x").alias("size"), F.spark_partition_id().alias("part")).agg(F.max("size"), F.count_distinct("part")).first()
    width, lanes = width or 0, math.isqrt(tasks) + 1
    weight = np.array([1.0 if positive is None else float(positive.get(a, 1.0)) for a in attrs])
    best, best_score = None, -1.0
    for reg in steps if split else steps[:1]:

        def function(theta: np.ndarray, reg=reg) -> tuple[float, np.ndarray]:
            n, loss, gradient = _partial_losses(data, lanes, len(attrs), weight, theta)
            shrunk = np.concatenate([theta[:-1], np.zeros((1, len(attrs)))])
            return loss / max(1, n) + reg / 2 * float((shrunk * shrunk).sum()), gradient / max(1, n) + reg * shrunk

        theta = minimise(function, np.zeros((width + 1, len(attrs))), rounds, tolerance)
        head = LinearHead(list(attrs), theta[:-1], theta[-1])
        score = 0.0
        if split:
            found = head_thresholds(embeddings.where((F.col(split) == "val") & F.col(column).isNotNull()), head, labels, column)
            score = found.agg(F.avg("f1")).first()[0] or 0.0
        if score > best_score:
            best, best_score = head, score
    discard(data)
    return best


def head_thresholds(rows: DataFrame, head: LinearHead, labels: str, column: str = "embedding") -> DataFrame:
    """attr, threshold, f1: the thresholds that suit a head best on rows(column, labels), by threshold_sweep."""
    keyed = rows.select(F.struct(F.coalesce(F.col(labels), F.array().cast("array<string>")).alias("own")).alias("key"), F.col(column).alias("features"))
    scored = score_multi(keyed, head, head.classes, key="key")
    return threshold_sweep(scored.select("attr", F.array_contains("key.own", F.col("attr")).cast("int").alias("gt"), "score"))
