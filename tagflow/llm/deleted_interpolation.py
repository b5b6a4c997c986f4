"""LM scoring by deleted interpolation of bigram and unigram estimates.

P(w | h) = a(k) * c(h w) / c(h) + b(k) * c(w) / N + u(k) * [w never seen], where k is the
bucket of the context's frequency c(h) and a(k) + b(k) + u(k) = 1. The weights are learned by
expectation-maximisation on a part of the training documents whose counts are left out
while they are learned; the scores then use the counts of all training documents.

Texts are packed into blocks of some MB. The totals of a block's distinct n-grams come from
a tree. A block sends its sorted n-grams, cut into 2**bits ranges of their hashes, to a
node that merges 2**bits blocks; a node is one group for each range, so it holds no more than a block does.
A node sends what it has merged, each range cut into 2**bits again, to the next level,
until one node is left, and the totals come back the same way. So the rows of each level are a fixed
number for each block, and a level is added when the blocks become 2**bits times as many. Counts never leave the
executors, except N, V and a table of quantised estimates of fixed size from which the weights are learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.shared import discard, shuffles_removed, text_batches, written
from tagflow.llm.words import mix, slices, text_bytes, word_hashes

U = np.uint64
END = U(0x5851F42D4C957F2D)
START = U(0x14057B7EF767814F)
BUCKETS = 24  # of context frequency: 0, then one for each power of two, the last open
BINS = 4  # to a power of two, for the table the weights are learned from
KEY_BITS = 56  # of a bigram's hash


def _pack(x: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, without the planes that are zero."""
    planes = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = len(raw) // n
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = np.frombuffer(raw, np.uint8).reshape(planes, n).T
    return out.reshape(-1).view("<u8")


def blocks(docs: DataFrame, held_out, tuning, block_bytes: int) -> DataFrame:
    """Rows of packed texts: part (of docs), place (in the part), tuning, n_docs, n_bytes, ids, held, texts. Map-only."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        parts: dict[bool, list] = {False: [], True: []}
        sizes = {False: 0, True: 0}

        def out(which: bool) -> pa.RecordBatch:
            nonlocal made
            made += 1
            rows = pa.Table.from_batches(parts[which]).combine_chunks()
            raw, at = text_bytes(rows.column("text"))
            doc = pa.compute.fill_null(rows.column("doc_id").cast(pa.int64()), 0).to_numpy()
            null = rows.column("doc_id").is_null().to_numpy()
            parts[which], sizes[which] = [], 0
            packed = zstandard.ZstdCompressor(level=1).compress(raw.tobytes())
            lens = np.diff(at).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([made - 1], pa.int64()), pa.array([which]), pa.array([len(rows)], pa.int64()), pa.array([len(raw)], pa.int64())]
                + [pa.array([x], pa.binary()) for x in (doc.tobytes(), null.tobytes(), rows.column("held_out").to_numpy().tobytes(), lens.tobytes(), packed)],
                ["part", "place", "tuning", "n_docs", "n_bytes", "ids", "nulls", "held", "lens", "texts"])

        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text", block_bytes):
            flag = batch.column("tuning")
            for which in (False, True):
                own = batch.filter(flag if which else pa.compute.invert(flag))
                if own.num_rows:
                    parts[which].append(own)
                    sizes[which] += len(text_bytes(own.column("text"))[0]) + 8 * own.num_rows
                    if sizes[which] >= block_bytes:
                        yield out(which)
        for which in (False, True):
            if parts[which]:
                yield out(which)

    schema = "part long, place long, tuning boolean, n_docs long, n_bytes long, ids binary, nulls binary, held binary, lens binary, texts binary"
    return text_batches(docs).select("doc_id", "text", held_out.alias("held_out"), tuning.alias("tuning")).mapInArrow(pack, schema)


class _Block:
    """Tokens of a block: unigram and bigram keys of each, sorted distinct keys, and where each token's key is."""

    def __init__(self, row: dict) -> None:
        lens = np.frombuffer(row["lens"], np.int64)
        at = np.concatenate([[0], np.cumsum(lens)])
        raw = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, int(at[-1])))
        column = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(raw)])
        h, starts = word_hashes(column)
        self.held = np.frombuffer(row["held"], bool)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        n_docs = len(lens)
        self.at = starts + np.arange(n_docs + 1)  # each text has one token more, its end
        total = len(h) + n_docs
        self.words = np.full(total, END, np.uint64)
        ends = self.at[1:] - 1
        inner = np.ones(total, bool)
        inner[ends] = False
        self.words[inner] = h
        before = np.empty(total, np.uint64)
        before[1:] = self.words[:-1]
        before[self.at[:-1]] = START
        pair = mix(before * U(0x9E3779B97F4A7C15) + self.words) >> U(64 - KEY_BITS)
        self.pair = pair << U(64 - KEY_BITS)
        self.uni, self.uni_of = np.unique(self.words, return_inverse=True)
        self.bi, self.bi_of = np.unique(self.pair, return_inverse=True)
        self.counted = np.repeat(~self.held, np.diff(self.at))

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        names, of = (self.uni, self.uni_of) if order == 1 else (self.bi, self.bi_of)
        return names, np.bincount(of[self.counted], minlength=len(names)).astype(np.uint64)

    def context(self, uni: np.ndarray) -> np.ndarray:
        """The count of each token's context, from the unigram counts; a start is as frequent as an end."""
        own = uni[self.uni_of]
        out = np.empty(len(own), np.int64)
        out[1:] = own[:-1]
        out[self.at[:-1]] = uni[np.searchsorted(self.uni, END)]
        return out


#: What a child sends to its node: its sorted n-grams of one range. child is a block, or a node of the level below with the range's upper bits.
SENT = "ngrams int, node long, range long, child long, n long, keys binary, counts binary, tunes binary"
#: What comes back to it: whole, the counts of all training documents, and tune, those of tuning documents. node is the child, sub the range's lower bits.
BACK = "ngrams int, node long, range long, sub long, n long, whole binary, tune binary, types long, tokens long, tuned long"


def _table(columns: dict[str, list], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({c: pa.array(columns[c], kinds[t]) for c, t in (x.split() for x in schema.split(", "))})


def _cut(ngrams: int, child: int, names: np.ndarray, counts: np.ndarray, tunes: np.ndarray, level: int, bits: int, out: dict[str, list]) -> None:
    """Adds the rows that a child sends to the given level: one for each range of level * bits bits."""
    top = names >> U(64 - level * bits)
    begin = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(names) else []
    for i, j in zip(begin, [*begin[1:], len(names)], strict=True):
        gaps = names[i:j] >> U(64 - KEY_BITS if ngrams == 2 else 0)
        gaps[1:] -= gaps[:-1].copy()
        for k, v in (("ngrams", ngrams), ("node", child >> bits), ("range", int(top[i])), ("child", child), ("n", j - i), ("keys", _pack(gaps)), ("counts", _pack(counts[i:j])), ("tunes", _pack(tunes[i:j]))):
            out[k].append(v)


def _requests(bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block = _Block(row)
                out: dict[str, list] = {x.split()[0]: [] for x in SENT.split(", ")}
                for order in (1, 2):
                    names, counts = block.keys(order)
                    _cut(order, row["block"], names, counts, counts if row["tuning"] else np.zeros_like(counts), 1, bits, out)
                yield from _table(out, SENT).to_batches()

    return send


def _merged(got: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of what the children of a group sent: distinct n-grams, the place of each sent one among them, sums of counts and tunes."""
    up = U(64 - KEY_BITS if got[0]["ngrams"] == 2 else 0)
    names, of = np.unique(np.concatenate([np.cumsum(_unpack(r["keys"], r["n"]), dtype=np.uint64) for r in got]), return_inverse=True)
    sums = [np.bincount(of, weights=np.concatenate([_unpack(r[k], r["n"]) for r in got]).astype(float), minlength=len(names)).astype(np.uint64) for k in ("counts", "tunes")]
    return names << up, of, *sums


def _climb(level: int, bits: int):
    """What the groups of a level send to the next."""

    def send(rows: pa.Table) -> pa.Table:
        got = rows.to_pylist()
        names, _, whole, tune = _merged(got)
        out: dict[str, list] = {x.split()[0]: [] for x in SENT.split(", ")}
        _cut(got[0]["ngrams"], got[0]["node"], names, whole, tune, level + 1, bits, out)
        return _table(out, SENT)

    return send


def _answers(got: list[dict], of: np.ndarray, whole: np.ndarray, tune: np.ndarray, bits: int, leaves: bool, root: bool) -> pa.Table:
    """Totals for each child of a group; of a root also a row with node -1 for the group's own sums.

    leaves: the children are blocks, of which only those of tuning documents (all counts of such a block are tunes) get tune.
    """
    out: dict[str, list] = {x.split()[0]: [] for x in BACK.split(", ")}

    def add(*values) -> None:
        for k, v in zip(out, values, strict=True):
            out[k].append(v)

    if root:
        add(got[0]["ngrams"], -1, 0, 0, 0, b"", b"", int((whole > 0).sum()), int(whole.sum()), int(tune.sum()))
    at = 0
    for r in got:
        own = of[at : at + r["n"]]
        at += r["n"]
        pack = lambda x: zstandard.compress(_pack(x[own]), 1)
        add(r["ngrams"], r["child"], r["range"] >> bits, r["range"] & ((1 << bits) - 1), r["n"], pack(whole), b"" if leaves and not any(r["tunes"]) else pack(tune), 0, 0, 0)
    return _table(out, BACK)


def _root(bits: int, leaves: bool):
    def answer(rows: pa.Table) -> pa.Table:
        got = rows.to_pylist()
        _, of, whole, tune = _merged(got)
        return _answers(got, of, whole, tune, bits, leaves, True)

    return answer


def _totals_of(rows: list[dict], which: str) -> np.ndarray:
    """The totals of a child's sorted n-grams, from what came back of its ranges."""
    return np.concatenate([_unpack(zstandard.decompress(r[which]), r["n"]) for r in sorted(rows, key=lambda r: r["sub"])])


def _descend(bits: int, leaves: bool):
    """From what came back to a group to what it sends back to its children."""

    def answer(sent: pa.Table, back: pa.Table) -> pa.Table:
        got, totals = sent.to_pylist(), back.to_pylist()
        if not got:
            return _table({x.split()[0]: [] for x in BACK.split(", ")}, BACK)
        return _answers(got, _merged(got)[1], _totals_of(totals, "whole"), _totals_of(totals, "tune"), bits, leaves, False)

    return answer


def totals(packed: DataFrame, blocks: int, bits: int) -> DataFrame:
    """Rows BACK for each of the blocks (numbers below blocks), and those of the root with node -1."""
    group, asked = ["ngrams", "node", "range"], packed.mapInArrow(_requests(bits), SENT)
    # what blocks send is made anew where it is needed: kept, it would be the largest table of all
    sent = [asked]
    while blocks > 1 << (bits * len(sent)):
        sent.append(written(sent[-1].groupBy(*group).applyInArrow(_climb(len(sent), bits), SENT), "sent"))
    back = written(sent[-1].groupBy(*group).applyInArrow(_root(bits, len(sent) == 1), BACK), "back")
    discard(*sent[1:][-1:])
    for k, below in reversed(list(enumerate(sent[:-1]))):
        down = below.groupBy(*group).cogroup(back.where("node >= 0").groupBy(*group)).applyInArrow(_descend(bits, k == 0), BACK)
        answered = written(back.where("node < 0").unionByName(down), "back")
        discard(back, *([below] if k else []))
        back = answered
    return back


def _returned(rows: list[dict], fit: bool) -> dict[int, np.ndarray]:
    """Totals of a block's sorted n-grams, for each order; with fit without the tuning documents."""
    out = {}
    for order in (1, 2):
        own = [r for r in rows if r["ngrams"] == order]
        out[order] = _totals_of(own, "whole").astype(np.int64)
        if fit:
            out[order] -= _totals_of(own, "tune").astype(np.int64)
    return out


def frequency_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0), BUCKETS - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    """0 for nothing, else 1 + the quarter octave of 1/p."""
    return np.where(p > 0, 1 + np.rint(-np.log2(np.where(p > 0, p, 1.0)) * BINS), 0).astype(np.int64)


def _evidence(fit_tokens: int):
    """For the tokens of a tuning block: how often each (frequency bucket, bigram bin, unigram bin) occurs."""

    def count(block: pa.Table, totals: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        found: dict[tuple, int] = {}
        for row in rows:
            b, fit = _Block(row), _returned(totals.to_pylist(), True)
            context = b.context(fit[1])
            one = fit[1][b.uni_of] / max(1, fit_tokens)
            two = fit[2][b.bi_of] / np.maximum(1, context)
            code = (frequency_bucket(context) * 1024 + _bin(two)) * 1024 + _bin(one)
            for k, n in zip(*np.unique(code, return_counts=True), strict=True):
                found[int(k)] = found.get(int(k), 0) + int(n)
        return pa.table({"code": pa.array(list(found), pa.int64()), "n": pa.array(list(found.values()), pa.int64())})

    return count


def learn_weights(codes: np.ndarray, counts: np.ndarray, steps: int = 200) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and never seen, by EM; half a count for each keeps all above 0."""
    k, two, one = codes // 1048576, codes // 1024 % 1024, codes % 1024
    value = lambda x: np.where(x > 0, 2.0 ** (-(x - 1) / BINS), 0.0)
    parts = np.stack([value(two), value(one), (one == 0).astype(float)], 1)
    usable = np.ones((BUCKETS, 3))
    usable[0, 0] = 0  # a context never seen has no bigram estimate
    weights = usable / usable.sum(1, keepdims=True)
    for _ in range(steps):
        share = weights[k] * parts
        share *= (counts / np.maximum(share.sum(1), 1e-300))[:, None]
        new = np.stack([np.bincount(k, share[:, j], BUCKETS) for j in range(3)], 1) + 0.5 * usable
        new /= new.sum(1, keepdims=True)
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-9:
            break
    return weights


def _scores(weights: np.ndarray, tokens: int, types: int):
    def score(block: pa.Table, totals: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            b, whole = _Block(row), _returned(totals.to_pylist(), False)
            context, one, two = b.context(whole[1]), whole[1][b.uni_of], whole[2][b.bi_of]
            w = weights[frequency_bucket(context)]
            p = w[:, 0] * two / np.maximum(1, context) + w[:, 1] * one / max(1, tokens) + w[:, 2] * (one == 0)
            if not tokens:
                p = np.ones(len(one))
            base = np.log10((one + 0.1) / (tokens + 0.1 * (types + 1)))
            first = b.at[:-1]
            out.append(pa.table({
                "doc_id": pa.array(b.ids, mask=b.nulls), "held_out": pa.array(b.held), "n_tokens": pa.array(np.diff(b.at), pa.int64()),
                "n_known": pa.array(np.add.reduceat((one > 0).astype(np.int64), first)), "train_tokens": pa.array(np.full(len(first), tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(np.log10(p), first))}))
        return pa.concat_tables(out)

    return score


def interpolated_scores(docs: DataFrame, held_out, tuning, block_bytes: int = 4 << 20, bits: int = 8) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out: column, true for documents that nothing is learned from. tuning: true for
    the training documents on whose left-out counts the weights are learned.
    A null or empty text is its end token alone. Without training documents every token
    is unknown: train_tokens is 0 and the scores are 0. Without tuning documents the
    weights are equal. Repeated rows count as often as they occur. Other columns are
    ignored; a null doc_id is returned as null. A text of any length is in one block.
    bits: of the tree's ranges and of the children of a node; changes the work, not the result.
    """
    held = F.coalesce(held_out, F.lit(True))
    made = written(blocks(docs, held, F.coalesce(tuning, F.lit(False)) & ~held, block_bytes), "blocks")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    parts, most = made.agg(F.max("part"), F.max("place")).first()
    if parts is None:
        return docs.sparkSession.createDataFrame([], schema)
    packed = made.withColumn("block", F.col("part") * (most + 1) + F.col("place"))
    with shuffles_removed(docs.sparkSession):
        back = totals(packed, (parts + 1) * (most + 1), bits)
    sums = back.where("node < 0").groupBy("ngrams").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), F.sum("tuned").alias("tuned"))
    types, tokens, tuned = next(((r.types, r.tokens, r.tuned) for r in sums.collect() if r.ngrams == 1), (0, 0, 0))
    own = back.where("node >= 0").withColumnRenamed("node", "block")
    evidence = (
        packed.where("tuning").groupBy("block").cogroup(own.where("length(tune) > 0").groupBy("block"))
        .applyInArrow(_evidence(tokens - tuned), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    weights = learn_weights(evidence["code"].to_numpy(np.int64), evidence["n"].to_numpy(float))
    return packed.groupBy("block").cogroup(own.select("block", "ngrams", "sub", "n", "whole").groupBy("block")).applyInArrow(_scores(weights, tokens, types), schema)
