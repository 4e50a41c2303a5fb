"""Weighted acyclic automata that map sequences of words to counts.

A path from the root spells a sequence; the weight of its last arc is the sequence's count, and 0 where
only longer sequences are counted. Automata are built from sorted sequences, from the deepest arcs up: states
with the same arcs (word, weight, target) are one state. The union of automata sums (or takes the greatest of)
the weights of equal paths, and the composition of one automaton with another looks its paths up there.

Words are symbols, numbered in byte order in each automaton, so sorting numbers sorts words. In matrices of
paths, a column is a place in the sequence, 0 stands for no word and symbol ``i`` for ``i + 1``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import zstandard

_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@dataclass
class Automaton:
    """Arcs by state: those of state ``s`` are ``first[s]`` to ``first[s + 1]``; the last state is the root."""

    symbols: list[bytes]
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All counted paths in order, and their weights."""
        levels = []  # (arcs, place of the parent) by depth
        arcs = np.arange(self.first[-2], self.first[-1])
        parent = np.zeros(len(arcs), dtype=np.int64)
        while len(arcs):
            levels.append((arcs, parent))
            state = self.target[arcs]
            counts = self.first[state + 1] - self.first[state]
            parent = np.repeat(np.arange(len(arcs)), counts)
            arcs = np.repeat(self.first[state] - np.cumsum(counts) + counts, counts) + np.arange(len(parent))
        if not levels:
            return np.zeros((0, 1), dtype=np.int32), np.zeros(0, dtype=np.int64)
        # how many paths begin with each path, from the deepest up
        sizes = [np.ones(len(arcs), dtype=np.int64) for arcs, _ in levels]
        for depth in range(len(levels) - 1, 0, -1):
            sizes[depth - 1] += np.bincount(levels[depth][1], sizes[depth], len(sizes[depth - 1])).astype(np.int64)
        total = int(sizes[0].sum())
        matrix = np.zeros((total, len(levels)), dtype=np.int32)
        weights = np.zeros(total, dtype=np.int64)
        above = np.zeros(1, dtype=np.int64) - 1
        for depth, (arcs, parent) in enumerate(levels):
            before = np.cumsum(sizes[depth]) - sizes[depth]
            heads = np.flatnonzero(np.diff(parent, prepend=-1))
            start = np.repeat(before[heads], np.diff(np.append(heads, len(parent))))
            above = above[parent] + 1 + before - start
            matrix[above, depth] = self.label[arcs] + 1
            weights[above] = self.weight[arcs]
        # words of a path stand in all rows of the paths that begin with it
        for depth in range(len(levels) - 1):
            known = matrix[:, depth] != 0
            last = np.maximum.accumulate(np.where(known, np.arange(total), 0))
            deeper = (matrix[:, depth + 1 :] != 0).any(axis=1)
            matrix[deeper, depth] = matrix[last[deeper], depth]
        counted = weights > 0
        return matrix[counted], weights[counted]

    def packed(self) -> bytes:
        """The automaton as bytes; the bytes of numbers are stored by significance, which packs better."""
        lengths = np.array([len(s) for s in self.symbols], dtype=np.int64)
        pieces = [b"".join(self.symbols)]
        sizes = [len(pieces[0])]
        for numbers in (lengths, np.diff(self.first), self.label, self.weight, self.target):
            width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
            octets = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            pieces.append(octets.T.tobytes())
            sizes += [len(numbers), width]
        head = np.array(sizes, dtype="<u8").tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(pieces))


def unpacked(octets: bytes) -> Automaton:
    raw = zstandard.ZstdDecompressor().decompress(octets)
    sizes = np.frombuffer(raw, dtype="<u8", count=11).astype(np.int64).tolist()
    at = 88 + sizes[0]
    arrays = []
    for count, width in zip(sizes[1::2], sizes[2::2], strict=True):
        full = np.zeros((count, 8), dtype=np.uint8)
        full[:, :width] = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count).T
        arrays.append(full.reshape(-1).view("<u8").astype(np.int64))
        at += count * width
    ends = np.cumsum(arrays[0]).tolist()
    text = raw[88 : 88 + sizes[0]]
    symbols = [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    return Automaton(symbols, np.concatenate([[0], np.cumsum(arrays[1])]), *arrays[2:])


def _shared(arcs: list[np.ndarray], starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each group of arcs the first group that has the same ones: found by a hash, and compared."""
    total = len(arcs[0])
    place = np.arange(total) - np.repeat(starts, counts)
    mixed = np.zeros(total, dtype=np.uint64)
    for values, factor in zip([*arcs, place], _FACTORS, strict=True):
        mixed = (mixed ^ values.astype(np.uint64)) * factor
        mixed ^= mixed >> np.uint64(29)
    _, first, group = np.unique(np.add.reduceat(mixed, starts), return_index=True, return_inverse=True)
    like = first[group]
    other = np.minimum(np.repeat(starts[like], counts) + place, total - 1)
    equal = np.logical_and.reduce([values == values[other] for values in arcs])
    proved = np.logical_and.reduceat(equal, starts) & (counts[like] == counts)
    return np.where(proved, like, np.arange(len(starts)))


def build(symbols: list[bytes], matrix: np.ndarray, weights: np.ndarray) -> Automaton:
    """The automaton of sorted, distinct paths. Symbols that no path has are left out."""
    used = np.zeros(len(symbols) + 1, dtype=bool)
    used[matrix.ravel()] = True
    used[0] = False
    number = np.cumsum(used)  # new symbol, from 1
    symbols = [symbols[i - 1] for i in np.flatnonzero(used).tolist()]
    matrix = np.where(matrix > 0, number[matrix], 0)
    rows, depth = matrix.shape
    changed = np.zeros(rows, dtype=bool)
    changed[:1] = True
    levels, arc_of = [], np.zeros(rows, dtype=np.int64)
    for d in range(depth):
        changed[1:] |= matrix[1:, d] != matrix[:-1, d]
        new = np.flatnonzero(changed & (matrix[:, d] > 0))
        if not len(new):
            break
        exact = matrix[new, d + 1] == 0 if d + 1 < depth else np.ones(len(new), dtype=bool)
        levels.append((matrix[new, d] - 1, np.where(exact, weights[new], 0), arc_of[new]))
        arc_of = np.cumsum(np.isin(np.arange(rows), new, assume_unique=True)) - 1
    first, kept, states = [np.zeros(1, dtype=np.int64)], [[], [], []], 1
    target = np.zeros(0, dtype=np.int64)
    done = 0
    for d in range(len(levels) - 1, -1, -1):
        label, weight, parent = levels[d]
        if d == len(levels) - 1:
            target = np.zeros(len(label), dtype=np.int64)
        starts = np.flatnonzero(np.diff(parent, prepend=-1))
        counts = np.diff(np.append(starts, len(parent)))
        arcs = [label, weight, target]
        like = _shared(arcs, starts, counts)
        own = np.unique(like)
        if d == 0:
            own = np.zeros(1, dtype=np.int64)
        picked = np.repeat(np.isin(np.arange(len(starts)), own), counts)
        for column, values in zip(kept, arcs, strict=True):
            column.append(values[picked])
        first.append(done + np.cumsum(counts[own]) - counts[own])
        done += int(counts[own].sum())
        if d:
            target = np.zeros(len(levels[d - 1][0]), dtype=np.int64)
            target[parent[starts]] = states + np.searchsorted(own, like)
            states += len(own)
    if not levels:
        first.append(np.zeros(1, dtype=np.int64))  # a root without arcs
        kept = [[np.zeros(0, dtype=np.int64)] for _ in range(3)]
    label, weight, target = (np.concatenate(column) for column in kept)
    return Automaton(symbols, np.append(np.concatenate(first), done), label, weight, target)


def order_keys(matrix: np.ndarray, symbols: int) -> np.ndarray:
    """Numbers that sort as the paths do, and are equal where paths are."""
    key = matrix[:, 0].astype(np.int64)
    size, largest = symbols + 1, symbols
    for d in range(1, matrix.shape[1]):
        if (largest + 1) * size >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            largest = len(distinct) - 1
        key = key * size + matrix[:, d]
        largest = largest * size + size - 1
    return key


def summed(matrix: np.ndarray, weights: np.ndarray, symbols: int, fold=np.add) -> tuple[np.ndarray, np.ndarray]:
    """Paths in order, each once, with their weights folded."""
    if not len(matrix):
        return matrix, weights
    key = order_keys(matrix, symbols)
    order = np.argsort(key)
    heads = np.flatnonzero(np.diff(key[order], prepend=-1))
    return matrix[order[heads]], fold.reduceat(weights[order], heads)


def union(automata: Iterable[Automaton], fold=np.add) -> Automaton:
    """One automaton with the paths of all; weights of equal paths are added up, or folded otherwise."""
    automata = list(automata)
    symbols = sorted(set().union(*(a.symbols for a in automata)))
    number = {s: i + 1 for i, s in enumerate(symbols)}
    matrices, weights = [], []
    for automaton in automata:
        matrix, weight = automaton.paths()
        new = np.array([0, *(number[s] for s in automaton.symbols)], dtype=np.int32)
        matrices.append(new[matrix])
        weights.append(weight)
    depth = max((m.shape[1] for m in matrices), default=1)
    matrix = np.concatenate([np.zeros((0, depth), dtype=np.int32)] + [widened(m, depth) for m in matrices])
    weight = np.concatenate([np.zeros(0, dtype=np.int64), *weights])
    return build(symbols, *summed(matrix, weight, len(symbols), fold))


def widened(matrix: np.ndarray, depth: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, depth - matrix.shape[1])))


def compose(questions: Automaton, counts: Automaton) -> np.ndarray:
    """The weight that ``counts`` gives to each path of ``questions``; 0 to unknown ones."""
    number = {s: i + 1 for i, s in enumerate(counts.symbols)}
    unknown = len(number) + 1
    new = np.array([0, *(number.get(s, unknown) for s in questions.symbols)], dtype=np.int32)
    asked, known = new[questions.paths()[0]], counts.paths()
    if not len(known[0]) or not len(asked):
        return np.zeros(len(asked), dtype=np.int64)
    depth = max(asked.shape[1], known[0].shape[1])
    both = np.concatenate([widened(asked, depth), widened(known[0], depth)])
    key = order_keys(both, unknown)
    mine, theirs = key[: len(asked)], key[len(asked) :]
    at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
    return np.where(theirs[at] == mine, known[1][at], 0)


def spelled(symbols: list[bytes], row: Iterable[int]) -> tuple[bytes, ...]:
    return tuple(symbols[i - 1] for i in row if i)


def cut(symbols: list[bytes], matrix: np.ndarray, borders: list[tuple[bytes, ...]]) -> list[int]:
    """Where sorted paths are cut, so that each part is from one border up to the next."""
    at: Callable[[int], tuple[bytes, ...]] = lambda i: spelled(symbols, matrix[i].tolist())
    return [bisect_left(range(len(matrix)), border, key=at) for border in borders]
