"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are partitioned by the size of their shingle set; the class with at most U
shingles (U a power of two) is looked for in windows of 2 * U shingles, one every U, so an
item's passage lies whole in some window of its class however long the document is.
Windows and items are compared by MinHash values: one shared value makes a candidate,
and the item's shingles are then counted in the whole document. The minima of larger
windows come from those of smaller ones, so a shingle is hashed once for all classes.
Items of at most EXACT shingles are too small a part of a window for that: each of their
shingles is a sign of its own, and one that occurs makes a candidate.

A value is named by a sign, a hash of the class, the number of the hash and the value. The items' signs are
a table; what goes to the tasks is a table of bits of bounded size, by which a document gives
only those of its signs that an item may have. A join on signs then finds the items. So the
documents are read once for their signs and the candidates among them once more for their sets, whatever the
number of items, and neither items nor documents come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.prefix_join import bit_table, is_set, set_table
from tagflow.llm.shared import discard, text_batches, written
from tagflow.llm.words import shingles, slices, word_hashes

U = np.uint64
LEAST = 8  # shingles in the smallest class
EXACT = 4  # items of at most so many shingles are looked up by each of them
LARGEST = 30  # classes by the power of two; no text has more shingles


def _multipliers(n: int, seed: int = 611) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, dtype=np.uint64) * U(2) + U(1)


def _naming(top: int, hashes: int) -> np.ndarray:
    """What a class multiplies the value of each hash with to name it; class 0 holds shingles themselves."""
    return _multipliers(hashes, 1000 + top.bit_length())


def item_signs(h: np.ndarray, hashes: int) -> tuple[int, np.ndarray]:
    """Class and signs of an item with the distinct shingles h."""
    if len(h) <= EXACT:
        return 0, h * _naming(0, 1)[0]
    top = LEAST
    while top < len(h):
        top *= 2
    return top, np.array([(h * m).min() for m in _multipliers(hashes)], np.uint64) * _naming(top, hashes)


def _halved(minima: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima over pairs of neighbouring blocks of each text."""
    count = np.diff(at)
    half = -(-count // 2)
    new_at = np.concatenate([[0], np.cumsum(half)])
    doc = np.repeat(np.arange(len(count)), half)
    begin = at[doc] + 2 * (np.arange(new_at[-1]) - new_at[doc])
    other = np.minimum(begin + 1, at[doc + 1] - 1)
    return np.minimum(minima[begin], minima[other]), new_at


def text_signs(h: np.ndarray, at: np.ndarray, classes: list[int], hashes: int, keep) -> tuple[np.ndarray, np.ndarray]:
    """(text, sign) for the windows of each class in classes, where keep(signs) holds; some more than once."""
    texts, signs = [], []

    def add(values: np.ndarray, begin: np.ndarray) -> None:
        hit = np.flatnonzero(keep(values))
        if len(hit):
            texts.append(np.searchsorted(begin, hit, "right") - 1)
            signs.append(values[hit])

    if 0 in classes:
        add(h * _naming(0, 1)[0], at)
    count = np.diff(at)
    blocks = -(-count // LEAST)
    block_at = np.concatenate([[0], np.cumsum(blocks)])
    doc = np.repeat(np.arange(len(count)), blocks)
    begin = at[doc] + LEAST * (np.arange(block_at[-1]) - block_at[doc])
    largest = max(classes, default=0)
    naming = {top: _naming(top, hashes) for top in classes if top}
    for j, times in enumerate(_multipliers(hashes) if len(begin) and largest else []):
        minima, where, top = np.minimum.reduceat(h * times, begin), block_at, LEAST
        while True:
            if top in naming:
                ends = np.zeros(len(minima), bool)
                ends[where[1:][np.diff(where) > 0] - 1] = True
                window = minima.copy()
                window[:-1] = np.where(ends[:-1], minima[:-1], np.minimum(minima[:-1], minima[1:]))
                add(window * naming[top][j], where)
            if top >= largest:
                break
            minima, where = _halved(minima, where)
            top *= 2
    return (np.concatenate(texts), np.concatenate(signs)) if texts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _item_table(benchmark: DataFrame, width: int, hashes: int) -> DataFrame:
    """item (a key), item_id, n_shingles, own (packed set), class, signs of the items of at least width words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = word_hashes(batch.column("text"))
            h, at = shingles(*words, width)
            count, keys, ids = np.diff(words[1]), batch.column("item").to_pylist(), batch.column("item_id").to_pylist()
            out: list[list] = [[] for _ in range(6)]
            for i in np.flatnonzero(count >= width):
                own = np.unique(h[at[i] : at[i + 1]])
                top, signs = item_signs(own, hashes)
                for k, v in enumerate((keys[i], ids[i], len(own), own.tobytes(), top, signs.view(np.int64).tolist())):
                    out[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["item", "item_id", "n_shingles", "own", "class", "signs"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    return text_batches(rows).select("item_id", "text", F.xxhash64("item_id", "text").alias("item")).mapInArrow(
        sign, "item long, item_id long, n_shingles long, own binary, class long, signs array<long>")


def _count(percent: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for whole, own in zip(batch.column("shingles"), batch.column("own"), strict=True):
                x, y = np.frombuffer(whole.as_buffer(), np.uint64), np.frombuffer(own.as_buffer(), np.uint64)
                common.append(int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum()) if len(x) else 0)
            n = np.array(common, np.int64)
            keep = pa.array(100 * n >= percent * batch.column("n_shingles").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("item_id"), batch.column("n_shingles"), pa.array(n)], ["id", "item_id", "n_shingles", "n_common"]).filter(keep)

    return count


def row_id(doc_id: Column, text: Column) -> Column:
    """A key of a row of documents, equal for equal id and text."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("-")), text)


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, hashes: int = 48) -> DataFrame:
    """Rows (doc_id, item_id, n_shingles, n_common): items of which at least percent of the distinct
    width-word shingles occur in the document. Letters A-Z count as a-z.

    Items of fewer than width words (null and empty ones too) cannot be told from chance and match
    nothing; null and empty documents hold nothing. Repeated document rows give repeated rows; rows of one item_id
    with different texts are items of their own. Recall: items of at most EXACT shingles are always found.
    A larger one whose shingles stand together in the document has a Jaccard similarity of more than 0.19 with some window
    (full containment: 0.25), so 48 hashes miss it with a chance of (1 - 0.19)^48, under 0.0001
    (full: 0.75^48, about 1e-6); one whose shingles are scattered over a long document is
    missed more often. Nothing is reported that is not verified.
    The bits hold the signs of some ten thousand items without many false ones; of more items more signs are sent to the join.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    return _contained(rows, benchmark, width, percent, hashes).join(
        rows.select("doc_id", row_id(F.col("doc_id"), F.col("text")).alias("id")), "id").select("doc_id", "item_id", "n_shingles", "n_common")


def _contained(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, hashes: int = 48) -> DataFrame:
    """id (row_id), item_id, n_shingles, n_common, once for each row_id and item."""
    items = written(_item_table(benchmark, width, hashes), "items")
    signs = written(items.select("item", F.explode("signs").alias("sign")), "signs")
    classes = [r["class"] for r in items.select("class").distinct().limit(LARGEST).collect()]
    bits, table = bit_table(signs, F.col("sign"), 27, 4096)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            h, at = shingles(*word_hashes(batch.column("text")), width)
            text, sign = text_signs(h, at, classes, hashes, lambda x: is_set(bits, shared.value, x))
            found = np.unique(np.stack([batch.column("id").to_numpy()[text], sign.view(np.int64)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["id", "sign"])

    hits = text_batches(docs).select(row_id(F.col("doc_id"), F.col("text")).alias("id"), "text").where("text IS NOT NULL").mapInArrow(scan, "id long, sign long")
    pairs = written(hits.join(signs, "sign").select("id", "item").distinct(), "candidates")
    sets = set_table(docs.where("text IS NOT NULL"), row_id(F.col("doc_id"), F.col("text")), pairs.select("id").distinct(), width).dropDuplicates(["id"])
    checked = pairs.join(sets, "id").join(items.select("item", "item_id", "n_shingles", "own"), "item").select("id", "item_id", "n_shingles", "shingles", "own")
    out = written(checked.mapInArrow(_count(percent), "id long, item_id long, n_shingles long, n_common long"), "contained")
    discard(items, signs, pairs)
    return out


def without_items(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without the documents that contain an item: all rows of a doc_id of which a row does, and rows without a
    doc_id by their text alone."""
    key = row_id(F.col("doc_id"), F.col("text"))
    found = _contained(docs, benchmark, width, percent).select("id").distinct()
    marked = docs.select("doc_id", key.alias("id")).join(found, "id")
    ids = written(marked.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct(), "contaminated")
    texts = written(marked.where("doc_id IS NULL").select(F.col("id").alias("__id")).distinct(), "contaminated")
    named = docs.where("doc_id IS NOT NULL").join(ids, F.col("doc_id") == F.col("__id"), "left_anti")
    return named.unionByName(docs.where("doc_id IS NULL").join(texts, key == F.col("__id"), "left_anti"))
