"""Personal data by rules and by a linear-chain conditional random field over word shapes.

The rules find mail addresses, IP addresses, card and phone numbers of fixed forms. The field labels each word with a kind or
none: it sees the shapes of the word and of its neighbours (runs of letters, digits by number, other bytes) and which labels
follow each other. It is trained by gradient ascent on a small labelled table and decoded by Viterbi in numpy batches. Where no
label but none can win, whatever the neighbours, the chain is cut, so that only short stretches are left to decode:
the labels are those of the whole text.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.collocations import word_spans
from tagflow.llm.shared import text_batches
from tagflow.llm.words import mix, slices, text_bytes

U = np.uint64
KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)  # the label of other words
LABELS = NONE + 1
CELLS = 1 << 14
SAMPLE_DOCS = 20_000
WINDOWS_EACH = 300
REACH = 200  # characters of a window before and behind a span
Span = tuple[int, int, int]  # kind, start, end in code points

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is matched from its begin or not at all
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PLAIN = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address is its @ and what stands on both sides: what cannot be one from the begin of its run cannot from within."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_BYTES:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
        # nothing of a match, and no part of a run that ends in a failed @, serves the next one
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the rules, by kind and start; and what has the form of an IP address or the digits of a card number, but fails their rules."""
    good: list[Span] = [(0, *x) for x in _emails(text)]
    bad: list[Span] = []
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        for m in pattern.finditer(text):
            digits = _PLAIN.sub("", m[0])
            if kind == 1:
                ok = all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))
            else:
                ok = 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15
            if ok:
                good.append((kind, m.start(), m.end()))
            elif kind == 1 or (kind == 2 and 13 <= len(digits) <= 19):
                bad.append((kind, m.start(), m.end()))
    return good, bad


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for k, i, j in sorted(spans))


# Shapes: a byte's class is 1 for A-Z, 2 for a-z and bytes of other letters, 3 for digits, else its own number.
_CLASS = np.arange(256)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3
_NAME = {1: "X", 2: "x"}
_MARKS = ".,;:!?"
MOST_DIGITS = 20


def shapes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: its runs of bytes of one class, those of digits with their length."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    size = ends - begins
    at = np.cumsum(size) - size
    own = _CLASS[raw[np.arange(int(size.sum())) + np.repeat(begins - at, size)]]
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    first[at] = True
    starts = np.flatnonzero(first)
    long = np.diff(np.append(starts, len(own)))
    code = own[starts] * 32 + np.where(own[starts] == 3, np.minimum(long, MOST_DIGITS), 0)
    word_at = np.searchsorted(starts, at)
    place = np.arange(len(starts)) - np.repeat(word_at, np.diff(np.append(word_at, len(starts))))
    return np.add.reduceat(mix(code.astype(np.uint64) * U(0x9E3779B97F4A7C15) + place.astype(np.uint64)), word_at)


@functools.lru_cache(1 << 14)
def features(word: bytes) -> tuple[int, ...]:
    """Cells of a word's features, which follow from its shape alone. b"" stands for a text's begin and end."""
    runs: list[list[int]] = []
    for c in _CLASS[np.frombuffer(word, np.uint8)].tolist():
        if runs and runs[-1][0] == c:
            runs[-1][1] += 1
        else:
            runs.append([c, 1])
    name = lambda c: _NAME.get(c) or chr(c)
    marks = "".join(name(c) for c, _ in runs)
    while runs and name(runs[-1][0]) in _MARKS:  # what ends a sentence is no part of a shape
        runs.pop()
    exact = [f"d{min(n, MOST_DIGITS)}" if c == 3 else name(c) for c, n in runs]
    rough = ["d" if c == 3 else name(c) for c, _ in runs]
    digits = sum(min(n, MOST_DIGITS) for c, n in runs if c == 3)
    out = ["exact " + "".join(exact[:24]), "rough " + "".join(rough[:48]), "first " + "".join(exact[:2]), "last " + "".join(exact[-2:]), f"digits {min(digits, MOST_DIGITS)}", f"runs {min(len(runs), 12)}"]
    out.append("end " + (marks[-1:] if marks[-1:] in _MARKS else ""))
    out += ["has " + c for c in sorted(set(rough) - {"X", "x"})] or ["letters"]
    return tuple(zlib.crc32(x.encode()) % CELLS for x in out)


@dataclass
class Field:
    """weights: of a word's cells, for the word itself, the one before and the one behind; moves: from label to label."""

    weights: np.ndarray  # (3, CELLS, LABELS)
    moves: np.ndarray  # (LABELS, LABELS)


@dataclass
class Words:
    """The words of all texts of a column: where they lie in raw, where each text's words begin, and each word's and its neighbours' kinds of
    shape; known: the cells of each kind of shape, padded with CELLS."""

    raw: np.ndarray
    at: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    around: np.ndarray  # (3, words)
    known: np.ndarray


def words_of(column: pa.Array) -> Words:
    raw, at = text_bytes(column)
    begins, ends = word_spans(raw, at)
    first = np.searchsorted(begins, at)
    _, one, own = np.unique(shapes(raw, begins, ends), return_index=True, return_inverse=True)
    data = raw.tobytes()
    cells = [features(data[i:j] if j - i < 4096 else _shortened(data[i:j])) for i, j in zip(begins[one].tolist(), ends[one].tolist(), strict=True)] + [features(b"")]
    width = max(map(len, cells))
    known = np.array([[*x, *[CELLS] * (width - len(x))] for x in cells])
    before, behind = np.full(len(own), len(one)), np.full(len(own), len(one))
    before[1:], behind[:-1] = own[:-1], own[1:]
    inner = first[:-1][first[:-1] < first[1:]]
    before[inner] = len(one)
    behind[first[1:][first[:-1] < first[1:]] - 1] = len(one)
    return Words(raw, at, begins, ends, first, np.stack([own, before, behind]), known)


def _shortened(word: bytes) -> bytes:
    """A word of the same shape, its runs cut to what shapes tell apart."""
    return re.sub(rb"([0-9]{20})[0-9]+", rb"\1", re.sub(rb"([A-Z])[A-Z]+", rb"\1", re.sub(rb"([a-z\x80-\xff])[a-z\x80-\xff]+", rb"\1", re.sub(rb"([^0-9A-Za-z\x80-\xff])\1+", rb"\1", word))))


def emissions(field: Field, w: Words) -> np.ndarray:
    """(words, LABELS)"""
    padded = np.concatenate([field.weights, np.zeros((3, 1, LABELS))], axis=1)
    by_shape = padded[:, w.known].sum(2)  # (3, shapes, LABELS)
    return sum(by_shape[k][w.around[k]] for k in range(3))


def _lanes(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Chains from long to short, and how many have a word at each step."""
    order = np.argsort(-length, kind="stable")
    sorted_ = length[order]
    return order, np.searchsorted(-sorted_, -np.arange(int(sorted_[0]) if len(sorted_) else 0), "left").tolist()


def viterbi(field: Field, emission: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The best label of each word; text: the number of each word's text. Ties go to the lesser label."""
    n = len(emission)
    label = np.full(n, NONE)
    moves = field.moves
    # what another label than none can gain at most by its neighbours
    gain = max(0.0, (moves - moves[:, [NONE]]).max()) + max(0.0, (moves - moves[[NONE]]).max())
    open_ = np.flatnonzero(emission[:, :NONE].max(1, initial=-np.inf) + gain >= emission[:, NONE])
    if not len(open_):
        return label
    new = np.append(True, (np.diff(open_) > 1) | (np.diff(text[open_]) > 0))
    first = open_[new]
    length = np.diff(np.append(np.flatnonzero(new), len(open_)))
    order, active = _lanes(first, length)
    first, length = first[order], length[order]
    same = lambda i, j: (i >= 0) & (j < n) & (text[np.maximum(i, 0)] == text[np.minimum(j, n - 1)])
    score = emission[first] + np.where(same(first - 1, first)[:, None], moves[NONE], 0)
    # what follows the chain's last word is none, if anything
    after = np.where(same(first + length - 1, first + length)[:, None], moves[:, NONE], 0)
    back = []
    for step, k in list(enumerate(active))[1:]:
        ways = score[:k, :, None] + moves
        back.append(ways.argmax(1))
        score[:k] = ways.max(1) + emission[first[:k] + step]
    best = (score + after).argmax(1)
    for step in reversed(range(len(active))):
        k = active[step]
        label[first[:k] + step] = best[:k]
        if step:
            best[:k] = back[step - 1][np.arange(k), best[:k]]
    return label


def _gradient(field: Field, w: Words, gold: np.ndarray, emission: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of the labels, and its slopes by emission and by move."""
    length = np.diff(w.first)
    chain = np.flatnonzero(length)
    order, active = _lanes(w.first[:-1][chain], length[chain])
    first, length = w.first[:-1][chain][order], length[chain][order]
    moves = field.moves
    norm = lambda x, axis: np.log(np.exp(x - (top := x.max(axis, keepdims=True))).sum(axis)) + top.squeeze(axis)
    ahead, behind = np.empty_like(emission), np.zeros_like(emission)
    ahead[first] = emission[first]
    for step, k in list(enumerate(active))[1:]:
        ahead[first[:k] + step] = norm(ahead[first[:k] + step - 1][:, :, None] + moves, 1) + emission[first[:k] + step]
    for step, k in reversed(list(enumerate(active))[1:]):
        behind[first[:k] + step - 1] = norm((behind[first[:k] + step] + emission[first[:k] + step])[:, None, :] + moves, 2)
    total = norm(ahead[first + length - 1], 1)
    z = np.empty(len(emission))
    z[np.repeat(first, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)] = np.repeat(total, length)
    by_word = -np.exp(ahead + behind - z[:, None])
    by_word[np.arange(len(gold)), gold] += 1
    starts = np.zeros(len(gold), bool)
    starts[first] = True
    later = np.flatnonzero(~starts)
    pairs = np.exp(ahead[later - 1][:, :, None] + moves + (emission[later] + behind[later])[:, None, :] - z[later][:, None, None])
    by_move = -pairs.sum(0)
    np.add.at(by_move, (gold[later - 1], gold[later]), 1)
    likelihood = emission[np.arange(len(gold)), gold].sum() + moves[gold[later - 1], gold[later]].sum() - total.sum()
    return float(likelihood), by_word, by_move


def train(labelled: list[tuple[str, list[Span]]], steps: int = 60, rate: float = 0.3, shrink: float = 1e-4) -> Field | None:
    """A field from texts and their spans; None if no word is of any kind. AdaGrad over all texts at once, from zero."""
    w = words_of(pa.array([t for t, _ in labelled], pa.string()))
    gold = np.full(len(w.begins), NONE)
    text = np.repeat(np.arange(len(labelled)), np.diff(w.first))
    for i, (t, spans) in enumerate(labelled):
        own = slice(w.first[i], w.first[i + 1])
        for kind, begin, end in spans:
            low, high = (w.at[i] + len(t[:x].encode()) for x in (begin, end))
            gold[own][(w.begins[own] < high) & (w.ends[own] > low)] = kind
    if (gold == NONE).all():
        return None
    field = Field(np.zeros((3, CELLS, LABELS)), np.zeros((LABELS, LABELS)))
    sums = [np.full(x.shape, 1e-8) for x in (field.weights, field.moves)]
    n_texts = int(text.max()) + 1
    for _ in range(steps):
        _, by_word, by_move = _gradient(field, w, gold, emissions(field, w))
        slope = np.zeros((3, CELLS + 1, LABELS))
        for k in range(3):
            by_shape = np.stack([np.bincount(w.around[k], by_word[:, y], len(w.known)) for y in range(LABELS)], 1)
            np.add.at(slope[k], w.known, by_shape[:, None, :])
        for value, g, squares in ((field.weights, slope[:, :CELLS] / n_texts, sums[0]), (field.moves, by_move / n_texts, sums[1])):
            g = g - shrink * value
            squares += g * g
            value += rate * g / np.sqrt(squares)
    return field


def rewritten(kind: int, span: str) -> list[str]:
    """The same in forms that the rules do not know: an address without its @, a card number in groups by slashes, a phone number without its country."""
    if kind == 0:
        return [span.replace("@", "(at)")]
    digits = _PLAIN.sub("", span)
    if kind == 2:
        return ["/".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    if kind == 3 and len(digits) >= 10:
        area, a, b = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({area}) {a}-{b}", f"{area}-{a}-{b}"]
    return []


def _window(text: str, begin: int, end: int, spans: list[Span]) -> tuple[str, list[Span]] | None:
    """The line around begin to end, at most REACH characters on either side and cut at a blank, with its spans; None if a span is cut."""
    low, high = max(0, begin - REACH), min(len(text), end + REACH)
    low = max(text.rfind(c, low, begin) + 1 for c in "\n\r") or (0 if low == 0 else max(low, text.find(" ", low, begin) + 1))
    stops = [x for c in "\n\r" if (x := text.find(c, end, high)) >= 0]
    if stops:
        high = min(stops)
    elif high < len(text):
        high = max(end, text.rfind(" ", end, high))
    own = [(k, i - low, j - low) for k, i, j in spans if i < high and j > low]
    return (text[low:high], own) if all(i >= 0 and j <= high - low for _, i, j in own) else None


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around each span, and one of each text that has none: kind, key (a hash), text, spans."""
    for batch in slices(batches, "text"):
        out: list[tuple[int, int, str, str]] = []
        for text in batch.column("text").to_pylist():
            good, _ = base_spans(text)
            place = zlib.crc32(text.encode()) % max(1, len(text))
            for kind, begin, end in good or [(NONE, place, place)]:
                made = _window(text, begin, end, good)
                if made and made[0].strip():
                    out.append((kind, zlib.crc32(f"{begin} {made[0]}".encode()), made[0], shown(made[1])))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], ["kind", "key", "text", "spans"])


def labelled_table(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, each: int = WINDOWS_EACH) -> DataFrame:
    """kind, key, text, spans: at most each windows of every kind and of none, labelled by the rules, from about sample_docs documents.

    The documents are those with the least hashes of doc_id and text, of equal ones one.
    """
    some = docs.where("length(text) > 0").select("text", F.xxhash64("doc_id", "text").alias("h"))
    share = min(1.0, sample_docs / max(1, docs.count()))
    least = some.where(F.col("h") < int(share * 2**64) - 2**63) if share < 1 else some
    once = text_batches(least.groupBy("h").agg(F.min("text").alias("text")))
    found = once.select("text").mapInArrow(_windows, "kind long, key long, text string, spans string").dropDuplicates(["kind", "text"])
    return found.withColumn("n", F.row_number().over(W.partitionBy("kind").orderBy("key", "text"))).where(F.col("n") <= each).drop("n")


def with_rewritten(rows: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """Labelled rows, and each once more for every span and form that rewritten() knows of it."""
    out = list(rows)
    for text, spans in rows:
        for kind, begin, end in spans:
            for form in rewritten(kind, text[begin:end]):
                move = len(form) - (end - begin)
                if all(j <= begin or i >= end for k, i, j in spans if (k, i, j) != (kind, begin, end)):
                    out.append((text[:begin] + form + text[end:], [(k, i + move * (i >= end), j + move * (i >= end)) if (k, i, j) != (kind, begin, end) else (k, begin, begin + len(form)) for k, i, j in spans]))
    return out


def fit(labelled: DataFrame) -> Field | None:
    """A field from labelled(text, spans), a small table that comes to the driver; spans as shown()."""
    read = lambda x: [(KINDS.index(k), int(i), int(j)) for k, i, j in (s.split(":") for s in x.split(",") if x)]
    rows = sorted((r.text, r.spans) for r in labelled.select("text", "spans").collect())
    return train(with_rewritten([(t, read(s)) for t, s in rows])) if rows else None


#: Digits of a card and a phone number: what the field takes for one with fewer or more is none.
_DIGITS = {2: (13, 19), 3: (7, 15)}
_EDGES = ".,;:!?\"'<>[]{}"


def _added(w: Words, i: int, label: np.ndarray, text: str, taken: list[Span]) -> list[Span]:
    """The spans of text i that the field finds: words of one kind in a row, without the marks around them; none that meets one of taken."""
    own = np.flatnonzero(label[w.first[i] : w.first[i + 1]] != NONE) + w.first[i]
    raw, base = w.raw[w.at[i] : w.at[i + 1]], w.at[i]
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
    out: list[Span] = []
    joined: list[list[int]] = []
    last = -2
    taken = sorted(taken, key=lambda s: s[1])
    starts = np.array([s[1] for s in taken])
    reach = np.maximum.accumulate([s[2] for s in taken]) if taken else starts
    for k in own.tolist():
        begin, end = int(chars[w.begins[k] - base]), int(chars[w.ends[k] - base])
        before = int(np.searchsorted(starts, end))
        if before and reach[before - 1] > begin:
            continue
        if joined and k == last + 1 and joined[-1][0] == label[k]:
            joined[-1][2] = end
        else:
            joined.append([int(label[k]), begin, end])
        last = k
    for kind, begin, end in joined:
        word = text[begin:end]
        begin, end = begin + len(word) - len(word.lstrip(_EDGES)), end - (len(word) - len(word.rstrip(_EDGES)))
        if begin < end and _DIGITS.get(kind, (0, 1 << 62))[0] <= len(_PLAIN.sub("", text[begin:end])) <= _DIGITS.get(kind, (0, 1 << 62))[1]:
            out.append((kind, begin, end))
    return out


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def private_spans(docs: DataFrame, field: Field | None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The numbers and base_sha256 (of the spans, written `kind:start:end`) are of the rules alone; spans has theirs and those that the field adds, n_added of
    them, which meet neither a span of the rules nor an IP address or card number that they refuse. Without a field none are added. A null text is empty: no spans, and the
    hash of nothing. Each row is judged alone; a null doc_id stays null; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches, "text"):
            column = batch.column("text")
            raw, at = text_bytes(column)
            sign = np.concatenate([[0], np.cumsum(((raw >= 48) & (raw <= 57)) | (raw == 64))])
            some = sign[at[1:]] > sign[at[:-1]]  # without a digit or an @ the rules find nothing
            hit = np.zeros(len(column), bool)
            if field is not None:
                w = words_of(column)
                text_of = np.repeat(np.arange(len(column)), np.diff(w.first))
                label = viterbi(field, emissions(field, w), text_of)
                hit[text_of[label != NONE]] = True
            counts, sha, spans, added = np.zeros((len(KINDS), len(column)), np.int64), [_EMPTY] * len(column), [""] * len(column), np.zeros(len(column), np.int64)
            for i in np.flatnonzero(some | hit).tolist():
                text = column[i].as_py()
                good, bad = base_spans(text) if some[i] else ([], [])
                more = _added(w, i, label, text, good + bad) if hit[i] else []
                for k, _, _ in good:
                    counts[k, i] += 1
                sha[i], spans[i], added[i] = hashlib.sha256(shown(good).encode()).hexdigest(), shown(good + more), len(more)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(x) for x in counts), pa.array(sha), pa.array(spans), pa.array(added)], [x.split()[0] for x in OUT.split(", ")])

    return text_batches(docs).select("doc_id", "text").mapInArrow(run, OUT)


_EMPTY = hashlib.sha256(b"").hexdigest()
