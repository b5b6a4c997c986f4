"""Weighted acyclic automata over n-grams of equal length.

A path of n arcs, one for each word, spells an n-gram; the last arc gives its count. States lie in
layers, one for each place in the n-gram. An automaton is built from sorted n-grams a layer at a
time from the last words on: a layer's states are registered by their arcs, and equal ones
(the same words to the same states with the same counts) are one state. The union walks all automata at once from
their starts, so it keeps no more than the n-grams that it returns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tagflow.llm.words import mix

U = np.uint64
_KINDS = [np.dtype(x) for x in ("u1", "<u2", "<u4", "<u8")]


@dataclass
class Automaton:
    """symbols: sorted names of words. By layer: begin, where each state's arcs begin (one more at the end); label, the arcs'
    words as places in symbols; target, the arcs' states in the next layer, in the last layer their counts."""

    symbols: np.ndarray
    begin: list[np.ndarray]
    label: list[np.ndarray]
    target: list[np.ndarray]

    def packed(self) -> bytes:
        arrays = [self.symbols, *(x for layer in zip(self.begin, self.label, self.target, strict=True) for x in layer)]
        out = [bytes([len(self.begin)])]
        for x in arrays:
            top = int(x.max()) if len(x) else 0
            kind = next(i for i, k in enumerate(_KINDS) if top <= np.iinfo(k).max)
            out += [bytes([kind]), len(x).to_bytes(8, "little"), x.astype(_KINDS[kind]).tobytes()]
        return b"".join(out)


def unpacked(raw: bytes) -> Automaton:
    arrays, pos = [], 1
    while pos < len(raw):
        kind, n = _KINDS[raw[pos]], int.from_bytes(raw[pos + 1 : pos + 9], "little")
        arrays.append(np.frombuffer(raw, kind, n, pos + 9).astype(np.uint64 if not arrays else np.int64))
        pos += 9 + n * kind.itemsize
    return Automaton(arrays[0], arrays[1::3], arrays[2::3], arrays[3::3])


def _spread(begin: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arcs of each of states, and which of states each arc is of."""
    count = begin[states + 1] - begin[states]
    of = np.repeat(np.arange(len(states)), count)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else np.zeros(0, np.int64)
    return begin[states][of] + np.arange(len(of)) - first[of], of


def _registered(begin: np.ndarray, label: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each state of a layer, the first state with the same arcs."""
    key = mix(label.astype(np.uint64) * U(0x9E3779B97F4A7C15) + mix(target.astype(np.uint64)))
    _, first, of = np.unique(np.add.reduceat(key, begin[:-1]), return_index=True, return_inverse=True)
    found = first[of]
    # equal sums of hashes are only a hint: the arcs themselves decide
    count = np.diff(begin)
    found = np.where(count == count[found], found, np.arange(len(found)))
    arcs, of = _spread(begin, np.arange(len(found)))
    other = begin[found][of] + arcs - begin[:-1][of]
    same = (label[arcs] == label[other]) & (target[arcs] == target[other])
    return np.where(np.logical_and.reduceat(same, begin[:-1]), found, np.arange(len(found)))


def build(grams: np.ndarray, counts: np.ndarray) -> Automaton:
    """Of distinct n-grams, rows of names of words in lexicographic order, and their counts; at least one."""
    n, length = grams.shape
    symbols, label = np.unique(grams, return_inverse=True)
    label = label.reshape(n, length)
    fresh = np.ones((n, length), bool)  # whether a row's prefix of each length is not the row's before
    fresh[1:] = np.logical_or.accumulate(label[1:] != label[:-1], axis=1)
    begin, labels, targets = [], [], []
    target = counts.astype(np.int64)
    for layer in reversed(range(length)):
        rows = np.flatnonzero(fresh[:, layer])
        own = label[rows, layer]
        source = np.cumsum(fresh[:, layer - 1])[rows] - 1 if layer else np.zeros(len(rows), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1], [True]]))
        first = _registered(starts, own, target)
        kept, place = np.unique(first, return_inverse=True)
        arcs, of = _spread(starts, kept)
        begin.append(np.searchsorted(of, np.arange(len(kept) + 1)))
        labels.append(own[arcs])
        targets.append(target[arcs])
        target = place  # of the arcs of the layer before, one for each state of this one
    return Automaton(symbols, begin[::-1], labels[::-1], targets[::-1])


def union(automata: list[Automaton]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams that the automata spell, in lexicographic order, and the sums of their counts."""
    symbols, of = np.unique(np.concatenate([a.symbols for a in automata]), return_inverse=True)
    at = np.cumsum([0, *(len(a.symbols) for a in automata)])
    # what is walked: pairs of a common prefix and a state that it leads to
    prefix, path = np.zeros(len(automata), np.int64), np.zeros((1, 0), np.int64)
    state, owner = np.zeros(len(automata), np.int64), np.arange(len(automata))
    length = len(automata[0].begin)
    for layer in range(length):
        states = np.cumsum([0, *(len(a.begin[layer]) - 1 for a in automata)])
        arcs_at = np.cumsum([0, *(len(a.label[layer]) for a in automata)])
        begin = np.concatenate([*(a.begin[layer][:-1] + arcs_at[i] for i, a in enumerate(automata)), arcs_at[-1:]])
        label = np.concatenate([of[at[i] + a.label[layer]] for i, a in enumerate(automata)])
        target = np.concatenate([a.target[layer] for a in automata])
        arcs, who = _spread(begin, states[owner] + state)
        names, first, prefix_of = np.unique(prefix[who] * len(symbols) + label[arcs], return_index=True, return_inverse=True)
        path = np.column_stack([path[prefix[who][first]], label[arcs][first]])
        prefix, state, owner = prefix_of, target[arcs], owner[who]
    sums = np.zeros(len(names), np.int64)
    np.add.at(sums, prefix, state)
    return symbols[path], sums
