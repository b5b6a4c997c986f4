"""Phrase collocation mining by weighted acyclic automata.

Counts of phrases grow a word at a time. In each block of texts the phrases of k words whose two parts of
k - 1 words are frequent are sorted and built into automata with counts, one for each range of their first words; the
automata of a range are united, their counts summed, and the frequent phrases kept. A range of
first words is parted by a hash of the whole phrase, as many times as the corpus is large, so that a first word of any frequency
is spread, and a block sends each phrase once however often it repeats it. Frequent parts go to the tasks as bits, which let a few others pass: the
sums alone decide. What a phrase's parts count is looked up by composing phrases and counts: a join on the part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.automata import build, union, unpacked
from tagflow.llm.prefix_join import bit_table, is_set
from tagflow.llm.shared import discard, text_batches, written
from tagflow.llm.words import mix, slices, text_bytes, word_hashes

U = np.uint64
LONGEST = 5
HEADS = 16  # ranges of first words
RANGE_WORDS = 2_000_000  # a part of a range for about so many words of the corpus
BLOCK_BYTES = 16 << 20
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[np.frombuffer(b".,;:!?", np.uint8)] = 10
#: Exact, in up to 38 digits.
SCORE = "CAST((CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS LONG)"
_FOLD = U(0x9E3779B97F4A7C15)


def pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, with a line feed for each mark that ends a piece, and where the pieces begin (one more at the end)."""
    raw, at = text_bytes(column)
    flat = _FLAT[raw]
    edge = np.zeros(len(flat) + 1, bool)
    edge[:-1] = (flat >= 10) & (flat <= 13)
    edge[at] = True
    return flat, np.flatnonzero(edge)


def piece_words(flat: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all pieces one after another, and where each piece's words begin."""
    return word_hashes(pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]))


def word_spans(flat: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words that piece_words names, in the same order."""
    inside = (flat != 32) & ((flat < 9) | (flat > 13))
    edge = np.zeros(len(flat) + 1, bool)
    edge[cut] = True
    begins = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    ends = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def signs(lang: str, h: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of length words and its language."""
    n = max(0, len(h) - length + 1)
    total = np.full(n, zlib.crc32(lang.encode()) * length, np.uint64)
    for k in range(length):
        total = total * _FOLD + h[k : k + n]
    return mix(total)


def _by_lang(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, gathered from batches until they have about block_bytes together."""
    held: dict[str, list[pa.Array]] = {}
    size = 0
    for batch in slices(batches, "text", block_bytes):
        names = batch.column("lang")
        for lang in names.unique().to_pylist():
            held.setdefault(lang, []).append(batch.column("text").filter(pa.compute.equal(names, lang)))
        size += len(text_bytes(batch.column("text"))[0])
        if size >= block_bytes:
            yield from ((x, pa.chunked_array(y).combine_chunks()) for x, y in held.items())
            held, size = {}, 0
    yield from ((x, pa.chunked_array(y).combine_chunks()) for x, y in held.items())


def _count_words(block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for lang, texts in _by_lang(batches, block_bytes):
            flat, cut = pieces(texts)
            h, _ = piece_words(flat, cut)
            names, first, n = np.unique(h, return_index=True, return_counts=True)
            begins, ends = (x[first] for x in word_spans(flat, cut))
            raw = flat.tobytes()
            words = [raw[i:j].lower().decode("utf-8", "replace") for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
            sign = signs(lang, names, 1)
            for i in range(0, len(names), 1 << 15):
                part = slice(i, i + (1 << 15))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words[part])), pa.array(names[part].view(np.int64)), pa.array(sign[part].view(np.int64)), pa.array(words[part], pa.string()), pa.array(n[part])],
                    ["lang", "h", "sign", "word", "n"])

    return run


def _frequent_places(lang: str, h: np.ndarray, at: np.ndarray, length: int, bits: int, table: np.ndarray) -> np.ndarray:
    """Where a run of length words begins that is in one piece and whose two parts of one word less have their bits set."""
    rest = np.repeat(at[1:], np.diff(at)) - np.arange(len(h))
    known = is_set(bits, table, signs(lang, h, length - 1))
    n = max(0, len(h) - length + 1)
    return np.flatnonzero((rest[:n] >= length) & known[:n] & known[1 : n + 1])


def _automata(lang: str, h: np.ndarray, places: np.ndarray, length: int, parts: int) -> pa.RecordBatch:
    """The packed automata of the runs of length words that begin at places, by range."""
    symbols, code = np.unique(h, return_inverse=True)
    rank = code[places]
    for k in range(1, length):  # ranks of longer and longer runs, in lexicographic order
        _, first, rank, n = np.unique(rank * len(symbols) + code[places + k], return_index=True, return_inverse=True, return_counts=True)
    begins = places[first]
    sign = signs(lang, h, length)[begins]
    of = (h[begins] >> U(60)).astype(np.int64) * parts + (mix(sign) % U(parts)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(of[order]) != 0, [True]]))
    grams = h[begins[order][:, None] + np.arange(length)]
    made = [build(grams[i:j], n[order][i:j]).packed() for i, j in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(made)), pa.array(of[order][edges[:-1]]), pa.array(made, pa.binary())], ["lang", "range", "automaton"])


def _summed(least: int):
    """The phrases of a range that occur least times, from its automata."""

    def add(rows: pa.Table) -> pa.Table:
        lang = rows.column("lang")[0].as_py()
        grams, n = union([unpacked(x) for x in rows.column("automaton").to_pylist()])
        kept = n >= least
        grams, n = grams[kept], n[kept]
        length = grams.shape[1]
        sign = signs(lang, grams.reshape(-1), length)[::length] if len(n) else np.zeros(0, np.uint64)
        words = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * length, pa.int32()), pa.array(grams.reshape(-1).view(np.int64)))
        return pa.table({"lang": pa.array([lang] * len(n), pa.string()), "phrase": words, "sign": pa.array(sign.view(np.int64)), "a": pa.array(n)})

    return add


def phrase_counts(docs: DataFrame, least: int, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[DataFrame]]:
    """(words: lang, h, word, sign, n of every word; for each length from 2 the phrases that occur least times: lang, phrase (hashes of its words), sign, a).

    docs: lang (without nulls), text. Written tables, to be discarded.
    """
    spark = docs.sparkSession
    seen = text_batches(docs).mapInArrow(_count_words(block_bytes), "lang string, h long, sign long, word string, n long")
    words = written(seen.groupBy("lang", "h").agg(F.min("word").alias("word"), F.min("sign").alias("sign"), F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = 1 + total // (HEADS * RANGE_WORDS)
    known = words.where(F.col("n") >= least)
    found: list[DataFrame] = []
    runs: DataFrame | None = None
    for length in range(2, longest + 1):
        bits, table = bit_table(known, F.col("sign"))
        shared = spark.sparkContext.broadcast(table)

        def texts(batches: Iterator[pa.RecordBatch], length=length, bits=bits, shared=shared) -> Iterator[pa.RecordBatch]:
            import pyarrow.compute  # noqa: F401

            for lang, column in _by_lang(batches, block_bytes):
                h, at = piece_words(*pieces(column))
                places = _frequent_places(lang, h, at, length, bits, shared.value)
                if len(places):
                    yield _automata(lang, h, places, length, parts)

        def stretches(batches: Iterator[pa.RecordBatch], length=length, bits=bits, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, raw, at in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "at")), strict=True):
                    h = np.frombuffer(raw, np.uint64)
                    places = _frequent_places(lang, h, np.frombuffer(at, np.int64), length, bits, shared.value)
                    if len(places):
                        yield _automata(lang, h, places, length, parts)

        def cut(batches: Iterator[pa.RecordBatch], bits=bits, shared=shared) -> Iterator[pa.RecordBatch]:
            """Stretches of three words and more in which every pair is frequent: all that longer phrases are made of."""
            import pyarrow.compute  # noqa: F401

            for lang, column in _by_lang(batches, block_bytes):
                h, at = piece_words(*pieces(column))
                places = _frequent_places(lang, h, at, 3, bits, shared.value)
                starts = np.flatnonzero(np.diff(places, prepend=-2) != 1)
                count = np.diff(np.append(starts, len(places))) + 2
                ends = np.concatenate([[0], np.cumsum(count)])
                of = np.repeat(np.arange(len(count)), count)
                own = h[places[starts][of] + np.arange(ends[-1]) - ends[of]]
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([own.tobytes()], pa.binary()), pa.array([ends.astype(np.int64).tobytes()], pa.binary())], ["lang", "words", "at"])

        if length == 3:
            runs = written(text_batches(docs).mapInArrow(cut, "lang string, words binary, at binary"), "runs")
        sent = text_batches(docs).mapInArrow(texts, "lang string, range long, automaton binary") if runs is None else runs.mapInArrow(stretches, "lang string, range long, automaton binary")
        known = written(sent.groupBy("lang", "range").applyInArrow(_summed(least), "lang string, phrase array<long>, sign long, a long"), "phrases")
        found.append(known)
    if runs is not None:
        discard(runs)
    return words, found


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's first phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    docs: lang (null: und), text (null: empty); other columns are ignored. n: all words of the language. A phrase of 2 to longest words that
    occurs a >= least times, overlaps included, is cut after its first k words into parts that occur l and r times, where
    1000 * a * n / (l * r), rounded down, is lowest (of equal ones the least k): its score. A phrase that lies inside a longer one that occurs as
    often goes. The first top by score and a, both descending, then by the phrase's bytes. Equal texts count as often as they
    occur. Without frequent phrases the result is empty. Words are told apart by 64-bit hashes.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words, found = phrase_counts(texts, least, longest, block_bytes)
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    candidates = candidates.drop("sign")
    counts = words.where(F.col("n") >= least).select("lang", F.array("h").alias("part"), F.col("n").alias("f")).unionByName(candidates.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    # composed with the counts on both parts of each cut
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    cuts = cuts.withColumns({"left": F.slice("phrase", F.lit(1), F.col("k")), "right": F.slice("phrase", F.col("k") + 1, F.size("phrase"))})
    of = lambda side, out: counts.select("lang", F.col("part").alias(side), F.col("f").alias(out))
    weighed = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(words.groupBy("lang").agg(F.sum("n").alias("n")), "lang")
    scored = weighed.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    size = F.size("phrase")
    inner = candidates.where(size > 2).withColumn("length", F.explode(F.sequence(F.lit(2), size - 1))).withColumn("begin", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)))
    inside = inner.groupBy("lang", F.slice("phrase", F.col("begin"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a").drop("longer")
    # texts only for those that may be among the first: all that tie with the last are kept until their bytes decide
    best = [F.col("score").desc(), F.col("a").desc()]
    first = written(kept.withColumn("place", F.rank().over(W.partitionBy("lang").orderBy(*best))).where(F.col("place") <= top).drop("place"), "first")
    spelled = (
        first.select("lang", "phrase", F.posexplode("phrase").alias("i", "h")).join(words.select("lang", "h", "word"), ["lang", "h"])
        .groupBy("lang", "phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("spelled")))
    ranked = first.join(spelled, ["lang", "phrase"]).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best, "spelled")))
    out = written(ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score"), "collocations")
    discard(words, first, *found)
    return out
