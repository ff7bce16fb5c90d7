"""Packing documents into few sequences by bin completion.

Documents are encoded and closed with the end id. One longer than
``CAPACITY`` is cut into full pieces behind a first piece that may be
shorter; no other document is cut. What is packed are lengths: the driver sees
one count for each of at most CAPACITY lengths, whatever the corpus.

Bin completion fills one sequence at a time around the largest piece left. Its
fillings are enumerated by rising waste, dominated ones skipped: a filling is
dominated if some of its pieces could give way to one piece left outside that
is as large or larger and still fits, since what it frees is easier to place.
Equal pieces repeat, so a filling is used as often as its lengths last. A
branch is cut when its waste, or the lower bound of what it leaves (by volume,
and by pieces too large to share), cannot beat the incumbent. The first
incumbent is best-fit decreasing, and better solutions replace it. The search
ends at the lower bound, when all branches are done, or after ``NODES`` nodes;
every piece is packed in any case.

A kind's pieces are ranked in chunks, so a length that a third of all pieces
share is no single task; place and offset follow from kind and rank alone.

Contract: null text counts as empty (the end id alone); repeated rows are
packed row by row; an empty table returns none; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import Table, number, plain, shared_path, stage
from itemwise.llm.tokens import ENCODED_ROWS, encoder, in_slices

CAPACITY = 2048
#: Effort of the search: nodes in all, and fillings tried at one node.
NODES, FILLINGS = 2000, 24

#: A filling and how often it is used: ((length, how many), ...), longest first.
Filling = tuple[tuple[int, int], ...]
Plan = list[tuple[Filling, int]]

_PIECES = ("row long, doc_id long, piece int, start long, length long, ids_crc32 long, "
           "width int, ids binary")


def lower_bound(count: np.ndarray) -> int:
    """Sequences needed at least: for each size t, pieces over capacity - t
    stand without any of t or more, pieces over half stand alone, and the
    volume of the rest down to t has only the room that these leave."""
    size = len(count) - 1
    lengths = np.arange(size + 1)
    n, volume = np.cumsum(count), np.cumsum(count * lengths)
    half = size // 2
    t = np.arange(half + 1)
    large = n[-1] - n[size - t]
    middle = n[size - t] - n[half]
    below = np.where(t > 0, volume[np.maximum(t - 1, 0)], 0)
    small = volume[half] - below
    room = middle * size - (volume[size - t] - volume[half])
    more = np.maximum(0, -((room - small) // size))
    return int((large + middle + more).max())


def best_fit(count: np.ndarray) -> Plan:
    """Best-fit decreasing over counts: equal sequences are one group."""
    size = len(count) - 1
    open_at: list[list[list]] = [[] for _ in range(size + 1)]  # by room left
    for u in range(size, 0, -1):
        left = int(count[u])
        room = u
        while left and room <= size:
            if not open_at[room]:
                room += 1
                continue
            pieces, times = open_at[room].pop()
            used = min(times, left)
            if used < times:
                open_at[room].append([pieces, times - used])
            open_at[room - u].append([pieces + [u], used])
            left -= used
            room = max(u, room - u) if room - u >= u else room
        if left:
            fit = size // u
            if left // fit:
                open_at[size - fit * u].append([[u] * fit, left // fit])
            if left % fit:
                open_at[size - (left % fit) * u].append([[u] * (left % fit), 1])
    plan: dict[Filling, int] = defaultdict(int)
    for groups in open_at:
        for pieces, times in groups:
            plan[tuple((u, pieces.count(u)) for u in dict.fromkeys(pieces))] += times
    return list(plan.items())


def _dominated(chosen: list[int], left: np.ndarray, waste: int) -> bool:
    """Whether a piece left outside could replace some chosen ones."""
    single = several = 0
    for u in chosen:
        several |= (several | single) << u
        single |= 1 << u
    outside = sum(1 << int(u) for u in np.flatnonzero(left))
    if several & outside:
        return True
    grown = single | several
    return any((grown << w) & outside for w in range(1, waste + 1))


def fillings(largest: int, count: np.ndarray, waste: int) -> Iterator[tuple[int, list[int]]]:
    """Undominated fillings around a piece of length ``largest`` (not in
    ``count``), by rising waste up to ``waste``, larger pieces first."""
    room = len(count) - 1 - largest
    kinds = [int(u) for u in np.flatnonzero(count[: room + 1])[::-1]]
    # sums that the kinds from i on can reach, as bits
    mask, reach = (1 << (room + 1)) - 1, [1] * (len(kinds) + 1)
    for i in range(len(kinds) - 1, -1, -1):
        sums, n, step = reach[i + 1], min(int(count[kinds[i]]), room // kinds[i]), 1
        while n:
            take = min(step, n)
            sums |= (sums << (take * kinds[i])) & mask
            n, step = n - take, step * 2
        reach[i] = sums

    def exact(i: int, rest: int, chosen: list[int]) -> Iterator[list[int]]:
        if rest == 0:
            yield chosen
            return
        while i < len(kinds) and kinds[i] > rest:
            i += 1
        for j in range(i, len(kinds)):
            u = kinds[j]
            if not reach[j] >> rest & 1:
                return
            most = min(int(count[u]), rest // u)
            for n in range(most, 0, -1):
                if reach[j + 1] >> (rest - n * u) & 1:
                    yield from exact(j + 1, rest - n * u, chosen + [u] * n)

    for spare in range(min(waste, room) + 1):
        if reach[0] >> (room - spare) & 1:
            for chosen in exact(0, room - spare, []):
                outside = count.copy()
                np.subtract.at(outside, chosen, 1)
                outside[room + 1:] = 0
                if not _dominated(chosen, outside, spare):
                    yield spare, chosen


def complete(count: np.ndarray, nodes: int = NODES) -> Plan:
    """Fillings that hold ``count[u]`` pieces of each length u, each piece
    once, in as few sequences as the search finds. ``count[0]`` is not used."""
    size = len(count) - 1
    count = count.astype(np.int64).copy()
    full = int(count[size])
    count[size] = 0
    whole: Plan = [(((size, 1),), full)] if full else []
    best = best_fit(count)
    fewest, bound = sum(n for _, n in best), lower_bound(count)

    def branches(left: np.ndarray, used: int):
        """Fillings around the largest piece whose branch may beat the incumbent."""
        largest = int(np.flatnonzero(left)[-1])
        volume = int((left * np.arange(size + 1)).sum())
        spare = (fewest - 1 - used) * size - volume
        rest = left.copy()
        rest[largest] -= 1
        for tried, (_, chosen) in enumerate(fillings(largest, rest, spare) if spare >= 0 else ()):
            pieces = [largest, *chosen]
            filling = tuple((u, pieces.count(u)) for u in dict.fromkeys(pieces))
            yield filling, min(int(left[u]) // n for u, n in filling)
            if tried + 1 >= FILLINGS:
                return

    if not count.any():
        return whole
    path: Plan = []
    stack = [(count, 0, branches(count, 0))]
    while stack and fewest > bound and nodes > 0:
        left, used, choices = stack[-1]
        choice = next(choices, None)
        if choice is None:
            stack.pop()
            if path:
                path.pop()
            continue
        nodes -= 1
        filling, times = choice
        now = left.copy()
        for u, n in filling:
            now[u] -= n * times
        if used + times + lower_bound(now) >= fewest:
            continue
        path.append(choice)
        if now.any():
            stack.append((now, used + times, branches(now, used + times)))
        else:
            best, fewest = path.copy(), used + times
            path.pop()
    return whole + best


def cut(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> Table:
    """Encoded pieces of at most ``capacity`` ids, written once; the first
    piece of a longer document is the short one."""

    def run(batches):
        enc = encoder(vocabulary)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        row = TaskContext.get().partitionId() << 33
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                 pa.int32(), pa.binary()]
        for batch in batches:
            for part in in_slices(batch, ENCODED_ROWS):
                rows = []
                ids = enc.encode(part.column("text").to_pylist())
                for doc_id, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    x += end
                    n = len(x) // enc.width
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        got = x[a * enc.width: b * enc.width]
                        crc = zlib.crc32(np.frombuffer(got, dtype=enc.dtype).astype("<u4"))
                        rows.append((row, doc_id, i, a, b - a, crc, enc.width, got))
                        row += 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds,
                                                        strict=True)],
                        names=["row", "doc_id", "piece", "start", "length", "ids_crc32", "width",
                               "ids"])

    found = plain(docs).mapInArrow(run, _PIECES)
    path = shared_path(docs.sparkSession, "completion-pieces")
    found.write.option("compression", "zstd").parquet(path)
    return Table(docs.sparkSession.read.schema(found.schema).parquet(path), path)


def _places(ranked: DataFrame, plan: Plan) -> DataFrame:
    """row, sequence_id and offset of every ranked piece."""
    # bounded by the plan's fillings, and these by the capacity
    table: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for filling, times in plan:
        offset = 0
        for u, n in filling:
            table[u].append((given[u], n, sequence, offset))
            given[u] += n * times
            offset += u * n
        sequence += times
    looked = {u: tuple(np.array(c) for c in zip(*rows, strict=True)) for u, rows in table.items()}

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for u in np.unique(length):
                at = length == u
                first, each, base, begin = looked[int(u)]
                p = np.searchsorted(first, rank[at], side="right") - 1
                inside = rank[at] - first[p]
                seq[at] = base[p] + inside // each[p]
                offset[at] = begin[p] + inside % each[p] * u
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(seq), pa.array(offset)],
                names=["row", "sequence_id", "offset"])

    return ranked.select("row", "length", "rank").mapInArrow(
        run, "row long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
         nodes: int = NODES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (of its ids
    as little-endian unsigned 32-bit integers), width and ids (little-endian
    unsigned integers of ``width`` bytes), sequence_id and offset."""
    pieces = cut(docs, vocabulary, end_id, capacity).df
    narrow = stage(pieces.select("row", "length"), "completion-lengths").df
    count = np.zeros(capacity + 1, dtype=np.int64)
    for r in narrow.groupBy("length").agg(F.count("*").alias("n")).collect():
        count[r.length] = r.n
    ranked = number(narrow, ["length"], ["row"], "rank")
    placed = stage(_places(ranked, complete(count, nodes)), "completion-places").df
    return pieces.join(placed, "row").drop("row")
