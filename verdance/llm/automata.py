"""Weighted acyclic automata over words: a set of word sequences with a count each.

A transition has a label (place of its word in the sorted symbol table), a weight (count of the
sequence that ends with it, 0 if none does) and a target. Transitions lie by state, then label.
States with equal transitions are one state, so common continuations are stored once.

* ``build`` makes one from sorted sequences, from the deepest level up; each level's states go
  through a register of equal ones.
* ``union`` adds automata up, whatever their symbol tables; weights of equal sequences are summed.
* ``compose`` walks an automaton of requests and one of counts together and gives the counts of
  the requested sequences.
* ``cuts`` finds where sorted sequences cross the borders of prefix ranges.

Everything is exact: hashes only propose equal states, transitions are compared before merging.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KINDS = (np.uint8, np.uint16, np.uint32, np.int64)


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0] + n[0] - 1, begin[1] .., one after the other."""
    total = int(n.sum())
    return np.arange(total) + np.repeat(begin - (np.cumsum(n) - n), n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Register:
    """States so far. State 0 has no transitions."""

    def __init__(self) -> None:
        self.sizes: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.states = 1

    def add(self, starts: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Numbers of the states whose transitions begin at ``starts``, equal ones once."""
        n = np.diff(np.append(starts, len(label)))
        u = lambda a: a.astype(np.uint64)
        each = _mixed(u(label) + _mixed(u(weight) + _mixed(u(target) + np.uint64(1))))
        sign = _mixed(np.add.reduceat(each, starts) + u(n))
        _, at, back = np.unique(sign, return_index=True, return_inverse=True)
        like = at[back]
        own = like == np.arange(len(starts))
        alike = n == n[like]
        rows, model = _ranges(starts[alike], n[alike]), _ranges(starts[like[alike]], n[alike])
        same = (label[rows] == label[model]) & (weight[rows] == weight[model]) & (target[rows] == target[model])
        alike[alike] = np.logical_and.reduceat(same, np.cumsum(n[alike]) - n[alike])
        own |= ~alike
        number = np.cumsum(own) + self.states - 1
        kept = np.repeat(own, n)
        self.parts.append((label[kept], weight[kept], target[kept]))
        self.sizes.append(n[own])
        self.states += int(own.sum())
        return np.where(own, number, number[like])


@dataclass
class Automaton:
    symbols: pa.Array
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    root: int

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """Every sequence as a row of symbol places (-1 beyond its end), and its weight."""
        return _padded(_expand(self.first, self.label, self.weight, self.target, self.root))

    def pruned(self, least: int) -> Automaton:
        grams, weights = self.paths()
        kept = weights >= least
        return build(self.symbols, *_ordered(grams[kept], weights[kept], len(self.symbols))).trimmed()

    def trimmed(self) -> Automaton:
        """Without symbols that no transition has."""
        used = np.unique(self.label)
        place = np.zeros(len(self.symbols) + 1, np.int32)
        place[used] = np.arange(len(used))
        return Automaton(self.symbols.take(pa.array(used)), self.first, place[self.label], self.weight, self.target, self.root)

    def compose(self, requests: Automaton) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of ``requests`` that this automaton has, in places of the symbols of
        ``requests``, with the weights they have here."""
        if not len(self.symbols) or not len(requests.symbols):
            return np.zeros((0, 1), np.int32), np.zeros(0, np.int64)
        places = pc.index_in(requests.symbols, value_set=self.symbols)
        here = pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        size = len(self.symbols)
        keys = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * size + self.label
        asked, own = np.array([requests.root]), np.array([self.root])
        prefix, out = np.zeros((1, 0), np.int32), []
        while len(asked):
            n = requests.first[asked + 1] - requests.first[asked]
            step, source = _ranges(requests.first[asked], n), np.repeat(np.arange(len(asked)), n)
            label = here[requests.label[step]]
            want = own[source] * size + label
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            met = (label >= 0) & (keys[at] == want)
            step, source, at = step[met], source[met], at[met]
            prefix = np.hstack([prefix[source], requests.label[step][:, None]])
            final = (requests.weight[step] > 0) & (self.weight[at] > 0)
            out.append((prefix[final], self.weight[at[final]]))
            asked, own = requests.target[step], self.target[at]
            on = (asked > 0) & (own > 0)
            asked, own, prefix = asked[on], own[on], prefix[on]
        return _padded(out)

    def to_bytes(self) -> bytes:
        offsets = np.frombuffer(self.symbols.buffers()[1], np.int32)[self.symbols.offset :][: len(self.symbols) + 1]
        words = self.symbols.buffers()[2]
        letters = np.frombuffer(words, np.uint8)[offsets[0] : offsets[-1]] if len(self.symbols) and words else np.zeros(0, np.uint8)
        parts, head = [], [self.root]
        for a in (np.diff(offsets), letters, np.diff(self.first), self.label, self.weight, self.target):
            most = int(a.max()) if len(a) else 0
            kind = next(i for i, k in enumerate(_KINDS) if most <= np.iinfo(k).max)
            parts.append(a.astype(_KINDS[kind]).tobytes())
            head += [kind, len(a)]
        return np.array(head, np.int64).tobytes() + b"".join(parts)

    @staticmethod
    def from_bytes(held: bytes) -> Automaton:
        head = np.frombuffer(held, np.int64, 13)
        at, parts = 104, []
        for kind, n in zip(head[1::2].tolist(), head[2::2].tolist(), strict=True):
            parts.append(np.frombuffer(held, _KINDS[kind], n, at))
            at += parts[-1].nbytes
        sizes, letters, n, label, weight, target = parts
        symbols = binaries(letters, sizes)
        first = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return Automaton(symbols, first, label.astype(np.int32), weight.astype(np.int64), target.astype(np.int64), int(head[0]))


def binaries(letters: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Words that lie one after the other."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))])


def numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, sorted by bytes, and the place of each word among them."""
    found = words.dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return found.dictionary.take(order), rank[found.indices.to_numpy()]


def _expand(first, label, weight, target, root) -> list[tuple[np.ndarray, np.ndarray]]:
    states, prefix, out = np.array([root]), np.zeros((1, 0), np.int32), []
    while len(states):
        n = first[states + 1] - first[states]
        step, source = _ranges(first[states], n), np.repeat(np.arange(len(states)), n)
        prefix = np.hstack([prefix[source], label[step][:, None]])
        final = weight[step] > 0
        out.append((prefix[final], weight[step[final]]))
        states = target[step]
        states, prefix = states[states > 0], prefix[states > 0]
    return out


def _padded(levels: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    width = max([1, *(g.shape[1] for g, _ in levels)])
    grams = np.full((sum(len(g) for g, _ in levels), width), -1, np.int32)
    at = 0
    for g, _ in levels:
        grams[at : at + len(g), : g.shape[1]] = g
        at += len(g)
    return grams, np.concatenate([np.zeros(0, np.int64), *(w for _, w in levels)])


def _ordered(grams: np.ndarray, weights: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, equal sequences once, their weights summed."""
    if not len(grams):
        return grams, weights
    if (symbols + 1) ** grams.shape[1] < 2**63:
        key = np.zeros(len(grams), np.int64)
        for column in grams.T:
            key = key * (symbols + 1) + column + 1
        order = np.argsort(key)
        fresh = np.append(True, np.diff(key[order]) != 0)
    else:
        order = np.lexsort(grams.T[::-1])
        fresh = np.append(True, (grams[order[1:]] != grams[order[:-1]]).any(axis=1))
    return grams[order[fresh]], np.add.reduceat(weights[order], np.flatnonzero(fresh))


def build(symbols: pa.Array, grams: np.ndarray, weights: np.ndarray) -> Automaton:
    """From distinct sequences in sorted order (rows of symbol places, -1 beyond the end)."""
    if not len(grams):
        none = np.zeros(0, np.int64)
        return Automaton(symbols.slice(0, 0), np.zeros(2, np.int64), none.astype(np.int32), none, none, 0)
    length = (grams >= 0).sum(axis=1)
    differs = np.zeros(len(grams), bool)
    differs[0] = True
    begins = []
    for j in range(grams.shape[1]):
        differs[1:] |= grams[1:, j] != grams[:-1, j]
        begins.append(np.flatnonzero(differs & (grams[:, j] >= 0)))
    register = _Register()
    target = np.zeros(len(begins[-1]), np.int64)
    for j in range(grams.shape[1] - 1, -1, -1):
        rows = begins[j]
        label, weight = grams[rows, j], np.where(length[rows] == j + 1, weights[rows], 0)
        above = begins[j - 1] if j else np.zeros(1, np.int64)
        if len(rows):
            parent = np.searchsorted(above, rows, "right") - 1
            starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            state = register.add(starts, label, weight, target)
        target = np.zeros(len(above), np.int64)
        if len(rows):
            target[parent[starts]] = state
    label, weight, to = (np.concatenate(x) for x in zip(*register.parts, strict=True))
    first = np.concatenate([[0], np.cumsum(np.concatenate(register.sizes))])
    return Automaton(symbols, first, label.astype(np.int32), weight.astype(np.int64), to.astype(np.int64), int(target[0]))


def union(automata: list[Automaton]) -> Automaton:
    """All sequences of all automata, each with the sum of its weights."""
    symbols, place = numbered(pa.concat_arrays([a.symbols for a in automata]))
    levels, at = [], 0
    for a in automata:
        grams, weights = a.paths()
        own = np.append(place[at : at + len(a.symbols)], -1).astype(np.int32)
        levels.append((own[grams], weights))
        at += len(a.symbols)
    return build(symbols, *_ordered(*_padded(levels), len(symbols)))


def cuts(symbols: list[bytes], grams: np.ndarray, borders: list[tuple[bytes, ...]]) -> list[int]:
    """For each border (a sequence of words), how many of the sorted sequences come before it."""
    out = []
    for border in borders:
        low, high = 0, len(grams)
        for j, word in enumerate(border[: grams.shape[1]]):
            place = bisect_left(symbols, word)
            column = grams[low:high, j]
            start = low + int(np.searchsorted(column, place))
            if place == len(symbols) or symbols[place] != word:
                low = high = start
                break
            low, high = start, low + int(np.searchsorted(column, place, "right"))
        else:
            if len(border) > grams.shape[1]:
                low = high  # a longer border comes after all sequences that it continues
        out.append(low)
    return out
