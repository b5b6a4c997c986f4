"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are read in overlapping chunks that cover all of it. Filters over WIDTH
bytes slide over each chunk; the largest response of each filter in the chunk is its
feature (max-pooling). The chunk features are combined by their mean and their maximum
over the document, and a logistic layer gives one probability. A byte's embedding and a
filter's weights multiply out to one table of numbers for each place in the filter, so
the tables themselves are what is learned.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.shared import text_batches, written
from tagflow.llm.words import text_bytes

WIDTH = 6
FILTERS = 8
CHUNK = 512  # places a filter is tried at in a chunk; chunks overlap by WIDTH - 1 bytes
STEP = 1 << 18  # places convolved at a time
PENALTY = 1e-4


@dataclass
class Model:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS: for the mean and for the maximum over chunks
    out_bias: float
    constant: float | None = None  # the probability where nothing could be learned


def _chunk_features(model: Model, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each chunk of each text the largest response of each filter, and where it was; chunks' starts by text.

    Every text is followed by WIDTH - 1 zero bytes, so each has a place for each byte, and
    an empty text one place.
    """
    n = len(at) - 1
    lens = np.diff(at)
    padded = lens + WIDTH - 1
    places = np.maximum(1, lens)
    pad_at = np.concatenate([[0], np.cumsum(np.maximum(padded, WIDTH))])
    data = np.zeros(pad_at[-1], np.uint8)
    keep = np.ones(pad_at[-1], bool)
    tail = np.repeat(pad_at[:-1] + lens, pad_at[1:] - pad_at[:-1] - lens)
    if len(tail):
        step = np.arange(len(tail)) - np.repeat(np.concatenate([[0], np.cumsum(pad_at[1:] - pad_at[:-1] - lens)])[:-1], pad_at[1:] - pad_at[:-1] - lens)
        keep[tail + step] = False
    data[keep] = raw
    chunks = -(-places // CHUNK)
    chunk_at = np.concatenate([[0], np.cumsum(chunks)])
    own = np.repeat(np.arange(n), chunks)
    begin = pad_at[own] + (np.arange(chunk_at[-1]) - chunk_at[own]) * CHUNK
    end = np.minimum(begin + CHUNK, pad_at[own] + places[own])
    best = np.empty((chunk_at[-1], FILTERS), np.float32)
    where = np.empty((chunk_at[-1], FILTERS), np.int64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + STEP, "right")))
        low, high = int(begin[i]), int(end[j - 1])
        act = model.tables[0][data[low:high]]
        for k in range(1, WIDTH):
            act += model.tables[k][data[low + k : high + k]]
        # the places between two texts belong to no chunk: every second cut is a chunk
        cuts = np.stack([begin[i:j], end[i:j]], 1).reshape(-1) - low
        if cuts[-1] == high - low:
            cuts = cuts[:-1]
        best[i:j] = np.maximum.reduceat(act, cuts, axis=0)[::2]
        if model.constant is None and where is not None and getattr(model, "trace", False):
            for c in range(i, j):
                where[c] = begin[c] + act[begin[c] - low : end[c] - low].argmax(0)
        i = j
    return best + model.bias, chunk_at, (where, data)


def _document(model: Model, best: np.ndarray, chunk_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    active = np.tanh(best)
    total = np.add.reduceat(active, chunk_at[:-1], axis=0) / np.diff(chunk_at)[:, None]
    return active, np.concatenate([total, np.maximum.reduceat(active, chunk_at[:-1], axis=0)], 1)


def probabilities(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of label 1 of each text; null is empty."""
    if not len(column):
        return np.zeros(0)
    if model.constant is not None:
        return np.full(len(column), model.constant)
    raw, at = text_bytes(column)
    out = np.empty(len(column))
    i = 0
    while i < len(column):  # texts by about a MB
        j = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 20), "right")) - 1)
        best, chunk_at, _ = _chunk_features(model, raw[at[i] : at[j]], at[i : j + 1] - at[i])
        _, feature = _document(model, best, chunk_at)
        out[i:j] = 1 / (1 + np.exp(-(feature @ model.out + model.out_bias).astype(float)))
        i = j
    return out


def gradients(model: Model, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict:
    """Of the weighted mean log loss (and a small penalty on out) by each part of a model that traces its maxima."""
    at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    best, chunk_at, (where, data) = _chunk_features(model, np.frombuffer(b"".join(texts), np.uint8), at)
    active, feature = _document(model, best, chunk_at)
    p = 1 / (1 + np.exp(-(feature @ model.out + model.out_bias)))
    wrong = (p - y) * weight / len(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(chunk_at))
    back = wrong[doc, None] * model.out[:FILTERS] / np.diff(chunk_at)[doc, None]
    top = active == feature[doc, FILTERS:]
    ties = np.add.reduceat(top.astype(float), chunk_at[:-1], axis=0)  # chunks that share a document's maximum share its gradient
    back = back + wrong[doc, None] * model.out[FILTERS:] * top / ties[doc]
    back = (back * (1 - active**2)).astype(np.float32)
    grad = {"tables": np.zeros_like(model.tables), "bias": back.sum(0), "out": feature.T @ wrong + PENALTY * model.out, "out_bias": float(wrong.sum())}
    for k in range(WIDTH):
        np.add.at(grad["tables"][k], (data[where + k], np.arange(FILTERS)[None, :]), back)
    return grad


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 10, seed: int = 7, batch: int = 64, rate: float = 0.02) -> Model:
    """Adam on the log loss, both labels weighing the same; deterministic for the same rows in the same order."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS), 0.0, float(y[0]) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.full(FILTERS, -1.0, np.float32), rng.normal(0, 0.3, 2 * FILTERS), 0.0)
    model.trace = True
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    names = ("tables", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(model, k)) if k != "out_bias" else 0.0 for k in names}
    second = {k: np.zeros_like(getattr(model, k)) if k != "out_bias" else 0.0 for k in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), batch):
            pick = order[begin : begin + batch]
            grad = gradients(model, [texts[i] for i in pick], y[pick], weight[pick])
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                move = now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                new = getattr(model, k) - move
                setattr(model, k, new.astype(np.float32) if k in ("tables", "bias") else new)
    model.trace = False
    return model


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, rows_each: int = 2000, bytes_each: int = 2000 * 12_288, epochs: int = 10) -> Model:
    """A model from a bounded sample: of each label the documents least by hash among those with may_learn,
    whole texts of any length, until there are rows_each or the next would make more than bytes_each
    bytes. The sample is trained on in one task.

    Labels other than 0 and 1, null ones, and those of documents that are not in docs are left out; of several labels of one document
    the largest counts, of several texts the shortest and least. Without labels the model gives 0.5,
    with one label only that label. If a label has documents but each is longer than bytes_each, that is an error. A warning
    says if there are labels of both kinds but docs holds documents of one only.
    """
    every = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(may_learn).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    # labels of documents that are not here would fill the sample
    usable = every.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    picks = written(usable.where("label = 0").orderBy(order).limit(2 * rows_each).union(usable.where("label = 1").orderBy(order).limit(2 * rows_each)), "picks")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    # lengths first, so that no more than the sample's texts are gathered; at most 4 * rows_each rows
    lengths = written(docs.select("doc_id", size.alias("size")).join(F.broadcast(picks), "doc_id").groupBy("doc_id", "label").agg(F.min("size").alias("size")), "lengths")
    by_label = W.partitionBy("label").orderBy(order, "doc_id").rowsBetween(W.unboundedPreceding, 0)
    fitting = lengths.where(F.col("size") <= bytes_each).withColumn("n", F.count("*").over(by_label)).withColumn("bytes", F.sum("size").over(by_label))
    chosen = written(fitting.where((F.col("n") <= rows_each) & (F.col("bytes") <= bytes_each)).select("doc_id", "label", "size"), "chosen")
    labels_of = lambda df: {r.label for r in df.select("label").distinct().collect()}
    if none := labels_of(lengths) - labels_of(chosen):
        raise ValueError(f"no document of label {min(none)} fits a sample of {bytes_each} bytes")
    if len(labels_of(lengths)) == 1 and len(labels_of(every)) == 2:
        warnings.warn("there are labels of both kinds, but all of one kind are of other documents: the score is a constant", stacklevel=2)
    texts = text_batches(docs).select("doc_id", "text", size.alias("size")).join(F.broadcast(chosen), ["doc_id", "size"])
    got = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: r["doc_id"])
        model = train([(r["text"] or "").encode() for r in rows], np.array([r["label"] for r in rows]), epochs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (model.tables.tobytes(), model.bias.tobytes(), model.out.astype(float).tobytes())]
            + [pa.array([float(model.out_bias)]), pa.array([model.constant], pa.float64())], ["tables", "bias", "out", "out_bias", "constant"])

    row = got.coalesce(1).mapInArrow(learn, "tables binary, bias binary, out binary, out_bias double, constant double").first()
    if row is None:
        return train([], np.zeros(0))
    return Model(
        np.frombuffer(row.tables, np.float32).reshape(WIDTH, 256, FILTERS), np.frombuffer(row.bias, np.float32), np.frombuffer(row.out, float), row.out_bias, row.constant)


def score_column(model: Model, text: Column) -> Column:
    """The probability as a column; each task gets the model, some kB, with its code."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(probabilities(model, column), pa.float64())

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, **sample) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, held_out, score, predicted.

    Nothing is learned from documents with held_out. Null and empty texts get the score of
    an empty text; a null doc_id counts as held out. Other columns are ignored.
    """
    held = F.coalesce(held_out, F.lit(True))
    model = fit(docs, labels, ~held, **sample)
    return docs.select("doc_id", held.alias("held_out"), score_column(model, F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, **sample) -> DataFrame:
    """The rows of docs whose score is at least threshold, all columns as they are. A null text is judged like an empty one,
    a row with a null doc_id by its text like any other (its label is not learned from)."""
    model = fit(docs, labels, ~F.coalesce(held_out, F.lit(True)), **sample)
    return docs.where(score_column(model, F.col("text")) >= threshold)
