"""Weighted acyclic automata over words: n-gram counts as transducers.

A table of n-grams is a list of columns of labels (int32, the first word's labels first;
0 where the n-gram has ended) and a column of counts, sorted by the columns. Label ``i``
stands for ``words[i - 1]``, and words are sorted by their bytes, so tables are sorted by
the n-grams themselves, word by word.

The automaton of a table accepts its n-grams; the weight of an n-gram is that of the state
it ends in. States with the same weight and the same arcs are one state.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Rows that the builder freezes at once (up to the next first word).
BLOCK_ROWS = 1 << 16


def distinct(columns: Sequence[np.ndarray], counts: np.ndarray | None, radix: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows sorted and distinct, counts of equal ones summed (None: each row counts 1). ``radix`` is above all labels."""
    n = len(columns[0])
    if n == 0:
        return [c.astype(np.int32) for c in columns], np.zeros(0, np.int64)
    if radix ** len(columns) < 1 << 63:
        code = columns[0].astype(np.int64)
        for c in columns[1:]:
            code = code * radix + c
        if counts is None:
            code.sort()
        else:
            order = np.argsort(code)
            code, counts = code[order], counts[order]
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        code = code[starts]
        rows = []
        for _ in columns:
            rows.append((code % radix).astype(np.int32))
            code //= radix
        rows.reverse()
    else:
        order = np.lexsort(list(columns)[::-1])
        rows = [c[order] for c in columns]
        counts = None if counts is None else counts[order]
        starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in rows])])
        rows = [c[starts].astype(np.int32) for c in rows]
    if counts is None:
        return rows, np.diff(np.r_[starts, n]).astype(np.int64)
    return rows, np.add.reduceat(counts, starts).astype(np.int64)


def count_ngrams(ids: np.ndarray, size: int, radix: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Table of all n-grams up to ``size`` words of a stream of labels in which 0 ends a piece.

    One sort: of the windows that begin at each word, cut at the end of the piece. An n-gram's
    count is the sum over the windows that begin with it.
    """
    padded = np.r_[ids, np.zeros(size, ids.dtype)]
    at = np.flatnonzero(ids)
    columns, inside = [], np.ones(len(at), bool)
    for k in range(size):
        inside = inside & (padded[at + k] != 0)
        columns.append(np.where(inside, padded[at + k], 0))
    windows, n = distinct(columns, None, radix)
    # an n-gram begins where its first k labels change; by window, then by length, is sorted order
    begins, total = np.zeros((len(n), size), bool), np.zeros((len(n), size), np.int64)
    for k, (rows, below) in enumerate(_levels(windows, n, np.add.reduceat)):
        begins[rows, k], total[rows, k] = True, below
    row, length = np.nonzero(begins)
    return [np.where(length >= k, c[row], 0).astype(np.int32) for k, c in enumerate(windows)], total[begins]


def _levels(columns, counts, reduce):
    """Per length the rows where a new n-gram of it begins, and the counts below it."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(changed)
        total = reduce(counts, starts) if len(starts) else counts[:0]
        real = c[starts] != 0
        yield starts[real], total[real]


@dataclass
class Automaton:
    words: list[bytes]
    final: np.ndarray  # weight of each state; the root is the last
    first: np.ndarray  # where a state's arcs begin, and the end of all
    arcs: np.ndarray  # (label, target), by state and label

    def rows(self, size: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The table of the automaton: every accepted n-gram of at most ``size`` words, sorted."""
        state = np.array([len(self.final) - 1])
        labels, parents, states = [], [], []
        for _ in range(size):
            width = self.first[state + 1] - self.first[state]
            arc = self.arcs[np.repeat(self.first[state], width) + _ragged(width)]
            parents.append(np.repeat(np.arange(len(state)), width))
            labels.append(arc[:, 0])
            state = arc[:, 1].astype(np.int64)
            states.append(state)
        # a path's place in sorted order: after its parent and all that lies below its elder siblings
        sizes = [np.ones(len(x), np.int64) for x in labels]
        for k in reversed(range(1, size)):
            sizes[k - 1] += np.bincount(parents[k], weights=sizes[k], minlength=len(sizes[k - 1])).astype(np.int64)
        n = int(sizes[0].sum())
        columns, counts = [np.zeros(n, np.int32) for _ in range(size)], np.zeros(n, np.int64)
        place = np.full(1, -1)
        above: list[np.ndarray] = []
        for k in range(size):
            ends = np.cumsum(sizes[k])
            begin = ends - sizes[k]
            first = np.r_[True, parents[k][1:] != parents[k][:-1]][: len(begin)]
            elder = begin - np.repeat(begin[first], np.diff(np.r_[np.flatnonzero(first), len(begin)]))
            place = place[parents[k]] + 1 + elder
            above = [a[parents[k]] for a in above] + [labels[k]]
            for c, a in zip(columns, above):
                c[place] = a
            counts[place] = self.final[states[k]]
        real = counts > 0
        return ([c[real] for c in columns], counts[real]) if not real.all() else (columns, counts)

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        widths, final = np.diff(self.first), self.final
        # by columns, and weights in as few bytes as they need: what is alike stands together
        small = np.uint8 if len(final) and final.max() < 256 else np.int64
        arcs = np.ascontiguousarray(self.arcs.T)
        return b" ".join(self.words), final.astype(small).tobytes(), widths.astype(np.int32).tobytes(), arcs.tobytes()

    @staticmethod
    def unpack(words: bytes, final: bytes, widths: bytes, arcs: bytes) -> Automaton:
        first = np.r_[0, np.cumsum(np.frombuffer(widths, np.int32), dtype=np.int64)]
        weights = np.frombuffer(final, np.uint8 if len(final) == len(first) - 1 else np.int64).astype(np.int64)
        return Automaton(words.split(b" ") if words else [], weights, first, np.ascontiguousarray(np.frombuffer(arcs, np.int32).reshape(2, -1).T))


def _ragged(width: np.ndarray) -> np.ndarray:
    """0..w-1 for each width, one after the other."""
    ends = np.cumsum(width)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - width, width)


class Builder:
    """Incremental construction from sorted n-grams: what lies below a first word is finished
    when the next first word comes; its states are looked up in the register, deepest first, and
    only new ones are added."""

    def __init__(self):
        # a state is its weight (two numbers) and its arcs; the register keeps states in the order they came
        self.register: dict[bytes, int] = {}
        self.root: list[np.ndarray] = []

    def _states(self, weights: np.ndarray, widths: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        sizes = 2 + 2 * widths
        ends = np.cumsum(sizes)
        starts = ends - sizes
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        flat[starts], flat[starts + 1] = weights & 0x7FFFFFFF, weights >> 31
        at = np.repeat(starts + 2, widths) + 2 * _ragged(widths)
        flat[at], flat[at + 1] = arcs[:, 0], arcs[:, 1]
        register, content = self.register, flat.tobytes()
        find = register.setdefault
        known = [find(content[a:b], len(register)) for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
        return np.array(known, np.int32)

    def add(self, columns: Sequence[np.ndarray], counts: np.ndarray) -> None:
        """Rows after all rows added before, of other first words."""
        nodes, own = [], []
        length = sum((c != 0).astype(np.int8) for c in columns)
        for k, (rows, _) in enumerate(_levels(columns, counts, np.add.reduceat)):
            nodes.append(rows)
            # a prefix that is no n-gram of the table itself has weight 0
            own.append(np.where(length[rows] == k + 1, counts[rows], 0))
        labels = np.zeros((0, 2), np.int32)
        parents = np.zeros(0, np.int64)
        for k in reversed(range(len(columns))):
            widths = np.bincount(parents, minlength=len(nodes[k]))
            if k == len(columns) - 1:  # no arcs: as many states as weights
                weight, which = np.unique(own[k], return_inverse=True)
                states = self._states(weight, np.zeros(len(weight), np.int64), labels)[which] if len(weight) else np.zeros(0, np.int32)
            else:
                states = self._states(own[k], widths, labels)
            labels = np.stack([columns[k][nodes[k]], states], axis=1).astype(np.int32)
            if k:
                parents = np.searchsorted(nodes[k - 1], nodes[k], side="right") - 1
        self.root.append(labels)

    def finish(self, words: list[bytes]) -> Automaton:
        root = np.concatenate(self.root) if self.root else np.zeros((0, 2), np.int32)
        flat = np.frombuffer(b"".join(self.register), np.int32)
        sizes = np.array([len(b) // 4 for b in self.register], np.int64)
        starts = np.cumsum(sizes) - sizes
        final = flat[starts].astype(np.int64) | flat[starts + 1].astype(np.int64) << 31
        arc = np.ones(len(flat), bool)
        arc[starts] = arc[starts + 1] = False
        widths = np.r_[sizes // 2 - 1, len(root)]
        return Automaton(words, np.r_[final, 0], np.r_[0, np.cumsum(widths)], np.concatenate([flat[arc].reshape(-1, 2), root]))


def build(words: list[bytes], columns: Sequence[np.ndarray], counts: np.ndarray) -> Automaton:
    """The automaton of a sorted table, block by block."""
    builder, n, start = Builder(), len(counts), 0
    while start < n:
        end = min(start + BLOCK_ROWS, n)
        if end < n:  # up to the end of the last first word
            end = int(np.searchsorted(columns[0], columns[0][end - 1], side="right"))
        builder.add([c[start:end] for c in columns], counts[start:end])
        start = end
    return builder.finish(words)


def cut(words: list[bytes], columns: Sequence[np.ndarray], bound: Sequence[bytes]) -> int:
    """How many rows of a sorted table come before the n-gram ``bound``."""
    lo, hi = 0, len(columns[0])
    for c, word in zip(columns, bound):
        label = bisect_left(words, word) + 1
        below = lo + int(np.searchsorted(c[lo:hi], label, side="left"))
        if label > len(words) or words[label - 1] != word:
            return below
        lo, hi = below, lo + int(np.searchsorted(c[lo:hi], label, side="right"))
    return lo


def only_used(words: list[bytes], columns: Sequence[np.ndarray]) -> tuple[list[bytes], list[np.ndarray]]:
    """The table with the words that it holds, in the same order."""
    used = np.unique(np.concatenate(columns))
    used = used[used > 0]
    table = np.zeros(len(words) + 1, np.int32)
    table[used] = np.arange(1, len(used) + 1)
    return [words[i - 1] for i in used.tolist()], [table[c] for c in columns]


class Union:
    """Running union: weights of equal n-grams are summed. Memory grows with the distinct
    n-grams, not with the automata that come in."""

    def __init__(self, size: int, spare: int = 1 << 18):
        self.ids: dict[bytes, int] = {}
        self.spare, self.size = spare, size
        self.parts: list[tuple[list[np.ndarray], np.ndarray]] = []
        self.rows = self.base = 0

    def add(self, automaton: Automaton) -> None:
        ids = self.ids
        table = np.zeros(len(automaton.words) + 1, np.int32)
        table[1:] = [ids.setdefault(w, len(ids) + 1) for w in automaton.words]
        columns, counts = automaton.rows(self.size)
        self.parts.append(([table[c] for c in columns], counts))
        self.rows += len(counts)
        if self.rows > 2 * self.base + self.spare:
            self._compact()

    def _compact(self) -> None:
        if len(self.parts) > 1:
            columns = [np.concatenate([p[0][j] for p in self.parts]) for j in range(self.size)]
            self.parts = [distinct(columns, np.concatenate([p[1] for p in self.parts]), len(self.ids) + 1)]
        self.rows = self.base = sum(len(p[1]) for p in self.parts)

    def result(self) -> Automaton:
        words = sorted(self.ids)
        if not self.parts:
            return build([], [np.zeros(0, np.int32)] * self.size, np.zeros(0, np.int64))
        table = np.zeros(len(words) + 1, np.int32)
        table[[self.ids[w] for w in words]] = np.arange(1, len(words) + 1)
        columns = [np.concatenate([table[p[0][j]] for p in self.parts]) for j in range(self.size)]
        counts = np.concatenate([p[1] for p in self.parts])
        self.parts = []
        return build(words, *distinct(columns, counts, len(words) + 1))


def acceptor(phrases: Sequence[Sequence[bytes]], size: int) -> Automaton:
    """Automaton of the given phrases, each of weight 1."""
    words = sorted({w for p in phrases for w in p})
    label = {w: i for i, w in enumerate(words, start=1)}
    matrix = np.zeros((len(phrases), size), np.int32)
    for i, p in enumerate(phrases):
        matrix[i, : len(p)] = [label[w] for w in p]
    columns, _ = distinct(list(matrix.T), None, len(words) + 1)
    return build(words, columns, np.ones(len(columns[0]), np.int64))


def compose(left: Automaton, right: Automaton, size: int) -> dict[tuple[bytes, ...], int]:
    """Phrases that both automata accept, with the product of their weights: both are walked
    together, arc by arc, a pair of states at a time."""
    label = {w: i for i, w in enumerate(right.words, start=1)}
    table = np.array([0] + [label.get(w, 0) for w in left.words], np.int64)
    radix = len(right.words) + 1
    source = np.repeat(np.arange(len(right.final)), np.diff(right.first))
    keys = source * radix + right.arcs[:, 0]  # sorted, as arcs are
    a, b = np.array([len(left.final) - 1]), np.array([len(right.final) - 1])
    paths: list[np.ndarray] = []
    out: dict[tuple[bytes, ...], int] = {}
    for _ in range(size):
        width = left.first[a + 1] - left.first[a]
        parent = np.repeat(np.arange(len(a)), width)
        arc = left.arcs[np.repeat(left.first[a], width) + _ragged(width)]
        wanted = b[parent] * radix + table[arc[:, 0]]
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        both = (table[arc[:, 0]] > 0) & (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)
        paths = [p[parent][both] for p in paths] + [arc[both, 0]]
        a, b = arc[both, 1].astype(np.int64), right.arcs[at[both], 1].astype(np.int64)
        weight = left.final[a] * right.final[b]
        real = np.flatnonzero(weight)
        for i, w in zip(real.tolist(), weight[real].tolist()):
            out[tuple(left.words[p[i] - 1] for p in paths)] = w
    return out
