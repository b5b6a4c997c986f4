"""Alignment of two tokenizers by interval coalescing.

The tokens of both are intervals of the bytes of a text. All are sorted by their start and the running maximum of
their ends is taken: where a start reaches it, both tokenizers have ended and a group ends. Within groups each A token is linked
with the B tokens whose intervals overlap its own.

Texts come in blocks of some MB. Neither tokenizer joins what stands before and after a single space between visible characters,
so a block's texts are cut there, and each distinct piece is encoded and aligned once, however often it occurs. How often two tokens are
linked in the corpus is summed over blocks, each sending a pair once, and comes back to the blocks by a join on the pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.shared import discard, text_batches, written
from tagflow.llm.words import slices, text_bytes

BLOCK_BYTES = 5 << 20
STEP = 1 << 16  # bytes encoded in one call
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF, all visible


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... count[0] of them, and so on."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - count), count)


class _Vocabulary:
    """The bytes of each id."""

    def __init__(self, names: dict[int, bytes]) -> None:
        own = [names.get(i, b"") for i in range(max(names) + 1)]
        self.size = np.array([len(x) for x in own], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(own), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.raw[_ranges(self.at[ids], self.size[ids])]


class Encoders:
    """Both tokenizers, from the contents of their files: encode() takes bytes that begin with a space and gives A's and B's ids."""

    def __init__(self, a: bytes, b: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_buffer(a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b)
        # visible bytes stand for themselves in A's vocabulary, the others for the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
        self.a = _Vocabulary({i: bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode() for x, i in self._a.get_vocab().items()})
        piece = self._b.id_to_piece
        self.b = _Vocabulary({i: bytes([int(piece(i)[3:5], 16)]) if self._b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self._b.get_piece_size())})

    def encode(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        text = raw.decode()
        return np.array(self._a.encode(text, add_special_tokens=False).ids, np.int64), np.array(self._b.encode(text[1:], num_threads=1), np.int64)


@dataclass
class Aligned:
    """By distinct piece: numbers of A and B tokens, groups and links, the groups' text, and whether the tokens spell it. By link: its
    piece and the ids of its tokens."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    spelled: np.ndarray
    link_piece: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def cut_pieces(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts raw[at[i]:at[i + 1]] begin, each of which begins with a space: at each text, and at single spaces
    between characters that are surely visible, ASCII or U+00C0 to U+00FF."""
    space = np.flatnonzero(raw == 32)
    space = space[(space > 1) & (space + 1 < len(raw))]
    before, after = raw[space - 1], raw[space + 1]
    inner = space[(_VISIBLE[before] | ((raw[space - 2] == _LATIN) & (before >= 128))) & (_VISIBLE[after] | (after == _LATIN))]
    begins = np.zeros(len(raw), bool)
    begins[at[:-1]] = begins[inner] = True
    return np.flatnonzero(begins)


def coalesced(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The group of each interval, in the order of starts: a group breaks where a start reaches the maximum of all ends before."""
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(np.concatenate([[0], start[order][1:] >= reach[:-1]])) if len(start) else 0
    return group


def _encoded(encoders: Encoders, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A's ids, the ends of its tokens in the pieces' bytes laid end to end, the same of B, and which pieces both spell.

    Pieces that begin and end with visible characters, but for the first space, are encoded many in a call, the others alone.
    """
    raw, at = text_bytes(pieces)
    n = len(pieces)
    size = np.diff(at)
    first, last, earlier = raw[np.minimum(at[:-1] + 1, len(raw) - 1)], raw[at[1:] - 1], raw[np.maximum(at[1:] - 2, 0)]
    plain = (size > 1) & (_VISIBLE[first] | (first == _LATIN)) & (_VISIBLE[last] | ((size > 2) & (earlier == _LATIN) & (last >= 128)))
    edges = [0]
    while edges[-1] < n:
        i = edges[-1]
        stop = i + 1
        if plain[i]:
            far = int(np.searchsorted(at, at[i] + STEP, "right"))
            odd = np.flatnonzero(~plain[i : max(far, i + 1)])
            stop = max(i + 1, min(n, i + int(odd[0]) if len(odd) else far))
        edges.append(stop)
    data, spelled = raw.tobytes(), np.ones(n, bool)
    ids: tuple[list, list] = ([], [])
    ends: tuple[list, list] = ([], [])

    def take(i: int, j: int) -> None:
        begin, stop = int(at[i]), int(at[j])
        found = encoders.encode(data[begin:stop])
        if all(v.size[x].sum() == stop - begin and (v.joined(x) == raw[begin:stop]).all() for v, x in zip((encoders.a, encoders.b), found, strict=True)):
            for k, (v, x) in enumerate(zip((encoders.a, encoders.b), found, strict=True)):
                ids[k].append(x)
                ends[k].append(begin + np.cumsum(v.size[x]))
        elif j - i > 1:
            for k in range(i, j):
                take(k, k + 1)
        else:
            spelled[i] = False

    for i, j in zip(edges, edges[1:], strict=False):
        take(i, j)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(ids[0]), join(ends[0]), join(ids[1]), join(ends[1]), spelled


def _texts(n: int, group: np.ndarray, ids: np.ndarray, n_a: int, piece: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The text and the number of the groups of each of n pieces. Of each token, A's n_a first: group, id and piece."""
    if not len(ids):
        return [b""] * n, np.zeros(n, np.int64)
    kind = np.repeat([0, 1], [n_a, len(ids) - n_a])
    order = np.argsort(2 * group + kind, kind="stable")
    group, kind, ids, piece = group[order], kind[order], ids[order], piece[order]
    # a row of bytes for each token: its id in decimal, and the mark behind it
    width = len(str(int(ids.max())))
    shown = np.zeros((len(ids), width + 1), np.uint8)
    for k in range(width):
        digit = ids // 10 ** (width - 1 - k)
        shown[:, k] = np.where((digit > 0) | (k == width - 1), 48 + digit % 10, 0)
    last = np.append(group[1:] != group[:-1], True)
    end = np.append(piece[1:] != piece[:-1], True)
    shown[:, width] = np.where(end, 0, np.where(last, ord(";"), np.where(np.append(kind[1:] != kind[:-1], False), ord("|"), ord(","))))
    size = np.bincount(piece, (shown > 0).sum(1), n).astype(np.int64)
    stops = np.cumsum(size)
    data = shown[shown > 0].tobytes()
    return [data[i:j] for i, j in zip((stops - size).tolist(), stops.tolist(), strict=True)], np.bincount(piece[last], minlength=n)


def align(encoders: Encoders, pieces: pa.Array) -> Aligned:
    """Of distinct pieces, each of which begins with a space."""
    a, a_end, b, b_end, spelled = _encoded(encoders, pieces)
    a_start, b_start = a_end - encoders.a.size[a], b_end - encoders.b.size[b]
    _, at = text_bytes(pieces)
    n = len(pieces)
    group = coalesced(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]), np.repeat([0, 1], [len(a), len(b)]))
    of = lambda x: np.searchsorted(at, x, "right") - 1
    a_piece, b_piece = of(a_start), of(b_start)
    # overlaps: B tokens that end behind an A token's start and start before its end
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    other = _ranges(low, high - low)
    link_a = np.repeat(np.arange(len(a)), high - low)
    groups, n_groups = _texts(n, group, np.concatenate([a, b]), len(a), np.concatenate([a_piece, b_piece]))
    count = lambda x: np.bincount(x, minlength=n)
    return Aligned(count(a_piece), count(b_piece), n_groups, count(a_piece[link_a]), groups, spelled, a_piece[link_a], a[link_a], b[other])


#: A block: lists by document, its documents' pieces, the links of distinct pieces, and its pairs with the numbers of their links.
BLOCK = (
    "part long, place long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "n_pieces array<long>, pieces binary, piece_links binary, link_pairs binary, pairs array<long>, counts array<long>")
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _list(values: pa.Array | np.ndarray) -> pa.Array:
    values = pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(encoders: Encoders, rows: pa.Table, part: int, place: int) -> pa.RecordBatch:
    raw, at = text_bytes(rows.column("text"))
    n = rows.num_rows
    # a space before each text
    spaced = np.full(len(raw) + n, 32, np.uint8)
    moved = at + np.arange(n + 1)
    inner = np.ones(len(spaced), bool)
    inner[moved[:-1]] = False
    spaced[inner] = raw
    begins = cut_pieces(spaced, moved)
    coded = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(spaced)).astype(np.int64).tobytes()), pa.py_buffer(spaced.tobytes())]).dictionary_encode()
    piece, found = coded.indices.to_numpy().astype(np.int64), align(encoders, coded.dictionary)
    first = np.searchsorted(begins, moved[:-1])
    whole = np.logical_and.reduceat(found.spelled[piece], first) & (np.diff(at) > 0)
    number = np.diff(np.append(first, len(piece)))
    occurs = np.bincount(piece[np.repeat(whole, number)], minlength=len(found.n_a))
    used = occurs[found.link_piece] > 0
    pairs, pair_of = np.unique(found.link_a * len(encoders.b.size) + found.link_b, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, pair_of[used], occurs[found.link_piece[used]])
    own = {k: np.where(whole, np.add.reduceat(getattr(found, k)[piece], first), 0) for k in ("n_a", "n_b", "n_groups", "n_links")}
    text = found.groups.__getitem__
    sha = [hashlib.sha256(b";".join(map(text, piece[i : i + k].tolist()))).hexdigest() if ok else "" for i, k, ok in zip(first.tolist(), number.tolist(), whole.tolist(), strict=True)]
    number = np.where(whole, number, 0)
    kept = _ranges(first, number)
    pack = lambda x: pa.array([x.astype(np.uint32).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([place]), _list(rows.column("doc_id").cast(pa.int64()).combine_chunks()), *(_list(own[k]) for k in ("n_a", "n_b", "n_groups", "n_links")), _list(sha)]
        + [_list(number), pack(piece[kept]), pack(found.n_links), pack(pair_of), _list(pairs), _list(counts)], [x.split()[0] for x in BLOCK.split(", ")])


def _blocks(shared, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoders, held, size, place = None, [], 0, 0
        part = TaskContext.get().partitionId()
        for batch in slices(batches, "text", block_bytes):
            encoders = encoders or Encoders(*shared.value)
            held.append(batch)
            size += len(text_bytes(batch.column("text"))[0])
            if size >= block_bytes:
                yield _block(encoders, pa.Table.from_batches(held), part, place)
                held, size, place = [], 0, place + 1
        if held:
            yield _block(encoders, pa.Table.from_batches(held), part, place)

    return run


def _finished(block: pa.Table, totals: pa.Table) -> pa.Table:
    """One row per document of a block; totals: pair, n, best of the block's pairs."""
    pairs = totals.column("pair").to_numpy()
    order = np.argsort(pairs)
    n, best = totals.column("n").to_numpy()[order], totals.column("best").to_numpy()[order].astype(np.int64)
    row = block.to_pylist()[0]
    counted = np.array(row["pairs"], np.int64)
    assert (pairs[order] == counted).all()
    number = np.array(row["n_pieces"], np.int64)
    piece, links, pair_of = (np.frombuffer(row[k], np.uint32).astype(np.int64) for k in ("pieces", "piece_links", "link_pairs"))
    return pa.table({c: pa.array(row[c], t) for c, t in (("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()))} | {
        k: pa.array(_by_document(x, pair_of, links, piece, number)) for k, x in (("n_best", best), ("count_sum", n))} | {"groups_sha256": pa.array(row["groups_sha256"], pa.string())})


def _by_document(value: np.ndarray, pair_of: np.ndarray, links: np.ndarray, piece: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sums over the links of each document's pieces of the values of their pairs."""
    sums = np.concatenate([[0], np.cumsum(value[pair_of])])
    ends = np.cumsum(links)
    each = np.concatenate([[0], np.cumsum((sums[ends] - sums[ends - links])[piece])])
    stops = np.cumsum(number)
    return each[stops] - each[stops - number]


def aligned(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    a_path: a byte-level BPE of the tokenizers library; b_path: a sentencepiece BPE with byte fallback. The driver reads both
    files and sends them to the tasks. Both encode a space and the text. n_best: links whose pair of ids is linked in all
    documents as often as any pair of its B id; count_sum: over links, how often their pairs are. groups_sha256: of the groups, written
    `a1,a2|b1;a3|b2,b3`. A null or empty text, and one that the tokens do not spell (one with U+2581), has zeros and "". Repeated rows
    count as often as they occur; a null doc_id stays null; other columns are ignored. A text of any length is in one block.
    """
    spark = docs.sparkSession
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    width = len(Encoders(*files).b.size)
    shared = spark.sparkContext.broadcast(tuple(files))
    blocks = written(text_batches(docs).select("doc_id", "text").mapInArrow(_blocks(shared, block_bytes), BLOCK), "blocks", wide=True)
    sent = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    sums = written(sent.groupBy("pair").agg(F.sum("n").alias("n")), "pair_sums")
    most = sums.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))
    # a row for each id of B
    known = sums.withColumn("b", F.col("pair") % width).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    back = blocks.select(F.col("part").alias("of_part"), F.col("place").alias("of_place"), F.explode("pairs").alias("pair")).join(known, "pair")
    out = written(blocks.groupBy("part", "place").cogroup(back.groupBy("of_part", "of_place")).applyInArrow(_finished, OUT), "aligned")
    discard(blocks, sums)
    return out

