"""Best-fit packing of token pieces by bin completion branch-and-bound.

Only how many pieces have each length matters for the search, and lengths are
at most the capacity: the histogram has a fixed bound whatever the corpus. The
search works on it and gives fillings with a multiplicity; pieces then find
their place by their rank among the pieces of equal length, each on its own.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.llm.common import written
from sentinela.llm.tokens import tokenizer

Filling = tuple[tuple[int, int], ...]  # (length, copies), lengths falling


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: pieces over half the capacity need a sequence each;
    for every threshold, what the small pieces need beyond the room left."""
    lengths = sorted(counts, reverse=True)
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    for k in sorted({n for n in lengths if n <= capacity // 2} | {0}):
        big = sum(counts[n] for n in lengths if n > capacity - k)
        mid = [n for n in lengths if capacity // 2 < n <= capacity - k]
        room = sum((capacity - n) * counts[n] for n in mid)
        small = sum(n * counts[n] for n in lengths if k <= n <= capacity // 2)
        best = max(best, big + sum(counts[n] for n in mid) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, all equal pieces and all equal sequences at a time."""
    rooms: list[int] = []  # rooms that some open sequence has, ascending
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}

    def add(room: int, filling: dict[int, int], n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((filling, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, filling, n = capacity, {}, left
            else:
                room = rooms[at]
                filling, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            copies = min(room // length, left)
            used = min(n, left // copies)
            add(room - copies * length, {**filling, length: copies}, used)
            left -= copies * used
            if filling and n > used:
                add(room, filling, n - used)
    return [(tuple(sorted(f.items(), reverse=True)), n) for group in open_.values() for f, n in group]


class _Search:
    """Depth-first bin completion: each step completes the sequence of the largest
    piece left, as often as the counts allow or fewer times."""

    def __init__(self, counts: dict[int, int], capacity: int, width: int, steps: int):
        self.capacity, self.width, self.steps = capacity, width, steps
        self.counts = dict(counts)
        self.lengths = sorted(counts)
        self.bits = self.mirror = 0
        for n in counts:
            self._mark(n)
        self.total = sum(n * c for n, c in counts.items())
        self.bound = lower_bound(counts, capacity)
        self.best = best_fit(counts, capacity)
        self.best_n = sum(n for _, n in self.best)
        self.step = 0
        self.cut = False  # some completion was left out for the width
        self.left = 0  # pieces that the current step may still try

    def _mark(self, n: int) -> None:
        self.bits ^= 1 << n
        self.mirror ^= 1 << (self.capacity - n)

    def _take(self, filling: Filling, times: int) -> None:
        for n, copies in filling:
            old = self.counts[n]
            self.counts[n] = old - copies * times
            if old and not self.counts[n]:
                self._mark(n)
                del self.lengths[bisect_left(self.lengths, n)]
            elif self.counts[n] and not old:
                self._mark(n)
                insort(self.lengths, n)

    def _exact(self, room: int, size: int, most: int, used: Counter, prefix: tuple, out: list) -> None:
        """Fillings of exactly ``room`` with ``size`` more pieces of at most ``most``, larger ones
        first; ``used`` pieces are not there any more. At most ``4 * width`` are kept."""
        if size == 1:
            if room <= most and self.counts.get(room, 0) > used[room]:
                out.append((*prefix, room))
            return
        top = min(most, room - (size - 1) * self.lengths[0])
        if top <= 0:
            return
        if size == 2:  # bit n: pieces of n and of room - n are both there
            both = self.bits & (self.mirror >> (self.capacity - room)) & ((2 << top) - 1)
            while both:
                n = both.bit_length() - 1
                if 2 * n < room:
                    return
                both ^= 1 << n
                same = n == room - n
                if self.counts[n] > used[n] + same and self.counts[room - n] > used[room - n]:
                    if len(out) >= 4 * self.width:
                        self.cut = True
                        return
                    out.append((*prefix, n, room - n))
            return
        for i in range(bisect_right(self.lengths, top) - 1, -1, -1):
            n = self.lengths[i]
            if n * size < room:
                return
            if self.counts[n] <= used[n]:
                continue
            self.left -= 1
            if self.left < 0 or len(out) >= 4 * self.width:
                self.cut = True
                return
            used[n] += 1
            self._exact(room - n, size - 1, n, used, (*prefix, n), out)
            used[n] -= 1

    def _dominated(self, pieces: tuple, filling: Counter, slack: int) -> bool:
        """A piece, or two, could give way to one larger piece that fits and is left."""
        for i, a in enumerate(pieces):
            for total, low in [(a, a + 1), *((a + b, a + b) for b in pieces[i + 1 :])]:
                at = bisect_left(self.lengths, low)
                while at < len(self.lengths) and self.lengths[at] <= total + slack:
                    if self.counts[self.lengths[at]] > filling[self.lengths[at]]:
                        return True
                    at += 1
        return False

    def fillings(self, allowed: int) -> list[tuple[Filling, int]]:
        """Undominated completions of the largest piece's sequence that waste at
        most ``allowed``, least waste and fewest pieces first, as (filling, waste)."""
        largest = self.lengths[-1]
        room, out, seen = self.capacity - largest, [], set()
        greedy, left, have = [], room, Counter(self.counts)
        have[largest] -= 1
        at = bisect_right(self.lengths, left) - 1
        while at >= 0 and left:
            n = self.lengths[at]
            copies = min(left // n, have[n])
            greedy += [n] * copies
            left -= n * copies
            at = min(at, bisect_right(self.lengths, left)) - 1
        pieces_left = sum(self.counts.values()) - 1
        self.left = 64 * self.width
        for waste in range(0, min(allowed, room) + 1):
            found: list[tuple] = []
            if waste == left:
                found.append(tuple(greedy))
            if room == waste:
                found.append(())
            for size in range(1, min((room - waste) // self.lengths[0], pieces_left) + 1):
                self.left -= 1
                if self.left < 0 or len(found) >= 4 * self.width:
                    self.cut = True
                    break
                self._exact(room - waste, size, largest, Counter((largest,)), (), found)
            for pieces in found:
                filling = Counter((largest, *pieces))
                key = tuple(sorted(filling.items(), reverse=True))
                if key in seen:
                    continue
                seen.add(key)
                self.left -= 1
                if len(pieces) <= 12 and self._dominated(pieces, filling, waste):
                    continue
                out.append((key, waste))
            if self.left < 0 or len(out) >= self.width:
                # completions of more waste, and of this one if too many, are not tried
                self.cut = self.cut or len(out) > self.width or waste < min(allowed, room)
                break
        if not out and left <= allowed:
            out.append((tuple(sorted(Counter((largest, *greedy)).items(), reverse=True)), left))
        return out[: self.width]

    def _choices(self, waste: int) -> list[tuple[Filling, int, int]]:
        """(filling, waste, times), the last one first to be tried: each filling as often as
        counts and waste bound let it, then half as often, and so on to once."""
        allowed = (self.best_n - 1) * self.capacity - self.total - waste
        if allowed < 0 or not self.lengths:
            return []
        most, fewer = [], []
        for filling, lost in self.fillings(allowed):
            times = min(self.counts[n] // c for n, c in filling)
            if lost:
                times = min(times, allowed // lost)
            if times:
                most.append((filling, lost, times))
            while times > 1:
                times //= 2
                fewer.append((filling, lost, times))
        return (most + fewer)[::-1]

    def _tree(self) -> bool:
        """Search the tree once; False if the steps ran out before its end."""
        path: list[tuple[Filling, int, int]] = []
        todo, waste, used = [self._choices(0)], 0, 0

        def back() -> None:
            nonlocal waste, used
            filling, lost, times = path.pop()
            self._take(filling, -times)
            waste, used = waste - lost * times, used - times

        while todo and self.best_n > self.bound and self.step < self.steps:
            if not todo[-1]:
                todo.pop()
                if path:
                    back()
                continue
            filling, lost, times = todo[-1].pop()
            if waste + lost * times > (self.best_n - 1) * self.capacity - self.total:
                continue  # the bound has fallen since
            self.step += 1
            self._take(filling, times)
            path.append((filling, lost, times))
            waste, used = waste + lost * times, used + times
            if not self.lengths:
                if used < self.best_n:
                    self.best, self.best_n = [(f, n) for f, _, n in path], used
            elif self.step % 64 == 0:  # complete what is left by best fit: a new incumbent
                rest = best_fit({n: self.counts[n] for n in self.lengths}, self.capacity)
                n_rest = sum(n for _, n in rest)
                if used + n_rest < self.best_n:
                    self.best, self.best_n = [(f, n) for f, _, n in path] + rest, used + n_rest
            todo.append(self._choices(waste))
        ended = not todo or self.best_n <= self.bound
        while path:
            back()
        return ended

    def run(self) -> tuple[list[tuple[Filling, int]], bool]:
        """The best packing, and whether no better one exists: the bound is met, or a tree in which
        no completion was left out is searched. Else the width doubles while steps remain."""
        while self.best_n > self.bound:
            self.cut = False
            if not self._tree():
                return self.best, False
            if self.best_n > self.bound and not self.cut:
                break
            self.width *= 2
        return self.best, True


def search_lengths(counts: dict[int, int], capacity: int, width: int = 6, steps: int = 4_000) -> tuple[list[tuple[Filling, int]], bool]:
    """Fillings and how often each is used, for pieces counted by length, and whether that is
    known to be the fewest sequences.

    Starts from best-fit decreasing; the search prunes with the waste that a better packing could
    still afford. It tries ``width`` completions a step, twice as many in the next search while the
    lower bound is not met, and ends after ``steps`` steps in all: only then may a packing with
    fewer sequences exist.
    """
    counts = {int(n): int(c) for n, c in counts.items() if c}
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    return _Search(counts, capacity, width, steps).run() if counts else ([], True)


def pack_lengths(counts: dict[int, int], capacity: int, width: int = 6, steps: int = 4_000) -> list[tuple[Filling, int]]:
    """The fillings of :func:`search_lengths`."""
    return search_lengths(counts, capacity, width, steps)[0]


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of (``doc_id``, ``text``): doc_id, piece, start, length,
    ids_crc32 (and ``ids``, array<int>), with the task and the piece's number
    among the task's pieces of equal length. Only documents over ``capacity``
    are cut. Null text: empty, that is one piece of the end id."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    if with_ids:
        schema += ", ids array<int>"
    end, step = int(end_id).to_bytes(4, "little"), 4 * capacity

    def run(batches):
        encode, part, seen = tokenizer(path).ids, TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in batches:
            ids, cols = b.column(0), [[] for _ in range(7)]
            for row, text in enumerate(b.column(1).to_pylist()):
                data = encode(text) + end
                for piece, at in enumerate(range(0, len(data), step)):
                    one = data[at : at + step]
                    n = len(one) // 4
                    for c, v in zip(cols, (row, piece, at // 4, n, crc32(one), seen[n], one)):
                        c.append(v)
                    seen[n] += 1
            out = [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32())]
            out += [pa.array(c, pa.int64()) for c in cols[2:5]]
            out += [pa.array([part] * len(cols[0]), pa.int32()), pa.array(cols[5], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                out.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cols[6]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def place(spark: SparkSession, pieces: DataFrame, capacity: int, **search) -> DataFrame:
    """``pieces`` (``length``, ``part``, ``nth``) with ``sequence_id`` and ``offset``.

    Numbers inside (part, length) plus the counts of the parts before give each
    piece its rank among equal lengths, without a window over pieces. The histogram
    (at most ``capacity`` rows) goes to the driver, the fillings' segments (no
    more than a few per length and filling) back to the tasks.
    """
    tally = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    start: dict[int, int] = Counter()
    segments, base = [], 0  # length, first rank, first sequence, copies, offset
    for filling, times in pack_lengths(counts, capacity, **search):
        at = 0
        for n, copies in filling:
            segments.append((n, start[n], base, copies, at))
            start[n] += copies * times
            at += n * copies
        base += times
    table = np.array(sorted(segments), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    kept = [c for c in pieces.columns if c not in ("part", "nth")]

    def run(batches):
        seg = shared.value
        firsts = seg[:, 0] << 44 | seg[:, 1]
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            n, rank = (cols[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(firsts, n << 44 | rank, side="right") - 1
            nth = rank - seg[at, 1]
            sequence, offset = seg[at, 2] + nth // seg[at, 3], seg[at, 4] + nth % seg[at, 3] * n
            yield pa.RecordBatch.from_arrays(
                [cols[c] for c in kept] + [pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select(*kept, "rank").mapInArrow(run, fields + ", sequence_id long, offset long")


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    with_ids: bool = False,
    **search,
) -> DataFrame:
    """All documents as pieces of at most ``capacity`` tokens placed in sequences.

    Pieces are written to the shared folder first: their numbers then hold even
    if a task runs twice. Null and empty texts are pieces of one end id;
    repeated rows and null ids are placed like any other row; an empty table
    gives no rows; further columns are ignored.
    """
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pieces = written(spark, token_pieces(base, path, capacity, end_id, with_ids), "pieces")
    return place(spark, pieces, capacity, **search)


def sequences(placed: DataFrame) -> DataFrame:
    """The training sequences of pieces packed ``with_ids``: sequence_id, ids,
    doc_ids. A sequence has at most ``capacity`` ids, so a group stays small."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts")
    return placed.groupBy("sequence_id").agg(parts).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
