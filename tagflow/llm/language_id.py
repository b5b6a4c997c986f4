"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters is one space. The counts of all
training documents are gathered; the matrix of log-probabilities (one row for each
of the hashed n-grams, one column for each language) is of fixed size and is broadcast.
It holds whole multiples of 2**-POINT, so that a text's sums are exact: they do not depend on
which texts share its batch.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.shared import text_batches
from tagflow.llm.words import slices

SIZES = (1, 2, 3)
BITS = 15
CELLS = 1 << BITS
STEP = 1 << 18  # places scored at a time, fewer with many languages
HELD = 128  # languages whose counts a task holds at a time
POINT = 20
U32 = np.uint32


@functools.cache
def _lower() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between single spaces and with single spaces inside, and where each begins."""
    joined = "".join(f"\0{x or ''}\0" for x in texts)
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # a NUL in a text looks like a text's begin: begins are known by the lengths
    begins = np.concatenate([[0], np.cumsum([len(x or "") + 2 for x in texts])])
    c = _lower()[raw]
    space = c == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[begins[:-1]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[begins]
    return c[keep], at


def _cells(c: np.ndarray, size: int) -> np.ndarray:
    """The hashed n-gram that begins at each place but the last size - 1."""
    n = len(c) - size + 1
    h = np.full(max(0, n), size, np.uint32)
    for k in range(size):
        h = (h ^ c[k : k + n]) * U32(0x9E3779B1)
        h ^= h >> U32(15)
    return (h >> U32(32 - BITS)).astype(np.int64)


def _inside(c: np.ndarray, at: np.ndarray, size: int, begin: int = 0) -> np.ndarray:
    """Of the n-grams that begin in c, whether each lies in one text and is no blank. at: where texts begin, less begin."""
    ok = np.ones(max(0, len(c) - size + 1), bool)
    for k in range(1, size):
        cross = at[1:-1] - k - begin
        ok[cross[(cross >= 0) & (cross < len(ok))]] = False
    if size == 1:
        ok &= c != 32
    return ok


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    lane = TaskContext.get().partitionId() % 256
    total: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for x, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([x]), pa.array([lane], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["lang", "lane", "counts"])
        total.clear()

    for batch in slices(batches, "text", 1 << 20):
        names = batch.column("lang").to_pylist()
        for lang in sorted(set(names)):
            c, at = _letters([t for t, x in zip(batch.column("text").to_pylist(), names, strict=True) if x == lang])
            if lang not in total and len(total) == HELD:
                yield from out()
            own = total.setdefault(lang, np.zeros(CELLS, np.int64))
            for size in SIZES:
                own += np.bincount(_cells(c, size)[_inside(c, at, size)], minlength=CELLS)
    yield from out()


def _add(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in rows.column("counts").to_pylist())
    return pa.table({"lang": rows.slice(0, 1).column("lang"), "lane": pa.array([0], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def fit(docs: DataFrame, may_learn: Column, most_languages: int = 500) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the int32 matrix (CELLS, languages) of log-probabilities in units of 2**-POINT.

    Learns from every row with may_learn and a non-null lang; a null text counts as empty. The
    matrix must fit a task (64 MB for 500 languages): more than most_languages languages is an error.
    """
    rows = text_batches(docs).where(may_learn).where("lang IS NOT NULL").select("text", "lang")
    langs = sorted(r.lang for r in rows.select("lang").distinct().limit(most_languages + 1).collect())
    if len(langs) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not langs:
        return [], np.zeros((CELLS, 0), np.int32)
    schema = "lang string, lane int, counts binary"
    summed = rows.mapInArrow(_count, schema).groupBy("lang", "lane").applyInArrow(_add, schema).groupBy("lang").applyInArrow(_add, schema).collect()
    matrix = np.empty((CELLS, len(langs)), np.int32)
    counts_of = {r.lang: r.counts for r in summed}
    for i, x in enumerate(langs):
        counts = 0.1 + (np.frombuffer(zlib.decompress(counts_of[x]), np.int64) if x in counts_of else np.zeros(CELLS))
        matrix[:, i] = np.rint(np.log(counts / counts.sum()) * (1 << POINT))
    return langs, matrix


def _score(langs: list[str], matrix: np.ndarray, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    names, score = ["und"] * len(texts), np.zeros(len(texts))
    c, at = _letters(texts)
    letters = np.concatenate([[0], np.cumsum(c != 32)])
    some = letters[at[1:]] > letters[at[:-1]]
    if not langs or not some.any():
        return names, score
    total = np.zeros((len(texts), len(langs)), np.int64)
    step = max(1 << 10, min(STEP, STEP * 16 // len(langs)))
    for begin in range(0, len(c), step):
        piece = c[begin : begin + step + max(SIZES) - 1]
        for size in SIZES:
            cells = _cells(piece, size)[:step]
            if not len(cells):
                continue
            p = matrix[cells]
            p[~_inside(piece, at, size, begin)[:step]] = 0
            first = int(np.searchsorted(at, begin, "right")) - 1
            last = int(np.searchsorted(at, begin + len(cells)))
            starts = np.maximum(at[first:last] - begin, 0)
            total[first:last] += np.add.reduceat(p, starts, axis=0, dtype=np.int64)
    best = total.argmax(1)
    score[:] = 1 / np.exp((total - total.max(1, keepdims=True)) / (1 << POINT)).sum(1)
    for i in np.flatnonzero(some):
        names[i] = langs[best[i]]
    return names, np.where(some, score, 0.0)


def predict(docs: DataFrame, may_learn: Column) -> DataFrame:
    """One row per row of docs(doc_id, text, lang): doc_id, held_out, lang_pred, score.

    held_out: not may_learn; a null doc_id counts as held out. score is the posterior
    probability of lang_pred with equal priors. A null text and one without a letter give
    "und" and 0, as does every text if there is nothing to learn from. Ties go to the first
    language in code-point order. Other columns are ignored.
    """
    learn = F.coalesce(may_learn, F.lit(False))
    langs, matrix = fit(docs, learn)
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = shared.value
        for batch in slices(batches, "text", 1 << 20):
            names, score = _score(langs, matrix, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~learn).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
