"""Packing documents into sequences by cutting-stock column generation.

Documents are encoded, closed with the end id and cut into pieces of at most
``CAPACITY`` ids: full pieces and one remainder. Pieces are counted by length
in steps of ``STEP`` ids, so the problem has CAPACITY / STEP item kinds
whatever the corpus. A linear program over patterns (how many pieces of each
kind fill one sequence) is solved by column generation: the simplex basis
prices the kinds, an unbounded knapsack over the capacity finds the pattern
of best reduced cost, until Farley's bound shows the rest to be worth less
than ``GAP``. Patterns are rounded down, what is left is placed first-fit
decreasing, and every pattern slot then takes the next piece in the ranking
of its kind.

Steps would waste much of a short piece. So pieces of at most ``SHORT`` ids
are first packed, by exact lengths and in the same way, into boxes of ``BOX``
ids; a box then is one piece of as many steps as it holds.

The driver sees one count per kind. Ranking deals a kind into chunks, so a
length that a third of all pieces share is no single task; offsets are sums
within one sequence.

Contract: null text counts as empty (the end id alone); repeated rows are
packed row by row; an empty table returns none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import Table, number, plain, shared_path, stage
from itemwise.llm.tokens import ENCODED_ROWS, SLICE_BYTES, encoder, forget, in_slices

CAPACITY, STEP, GAP = 4096, 16, 5e-4
SHORT, BOX = 128, 512
#: Pieces that a worker remembers, fewer than elsewhere; bytes of text encoded at a
#: time after steps that leave executors little room (smaller slices cost more CPU).
CUT_REMEMBERED, CLOSE_BYTES = 100_000, 4 << 20

_PIECES = ("piece long, doc_id long, start long, length long, doc_tokens long, width int, "
           "ids binary")


def price(values: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of units 1..len(values) within ``size``
    of the highest total value, and that value."""
    kinds = len(values)
    best = np.zeros(size + 1)
    last = np.zeros(size + 1, dtype=np.int64)
    for c in range(1, size + 1):
        m = min(c, kinds)
        options = best[c - m: c][::-1] + values[:m]
        i = int(np.argmax(options))
        if options[i] > best[c - 1]:
            best[c], last[c] = options[i], i + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(kinds, dtype=np.int64), size
    while c > 0:
        if last[c]:
            pattern[last[c] - 1] += 1
            c -= last[c]
        else:
            c -= 1
    return float(best[size]), pattern


def _invert(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots; a few hundred rows at most."""
    n = len(a)
    both = np.hstack([a, np.eye(n)])
    for i in range(n):
        p = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, p]] = both[[p, i]]
        both[i] /= both[i, i]
        rest = both[:, i].copy()
        rest[i] = 0
        both -= rest[:, None] * both[i]
    return both[:, n:]


def patterns(demand: np.ndarray, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use them, covering ``demand[u-1]`` pieces of
    u units each, with capacity len(demand) units; exactly, no piece twice."""
    size = len(demand)
    kinds = np.flatnonzero(demand > 0)
    if not len(kinds):
        return []
    columns = np.zeros((size, len(kinds)), dtype=np.int64)
    columns[kinds, np.arange(len(kinds))] = size // (kinds + 1)
    inverse = np.diag(1.0 / columns[kinds, np.arange(len(kinds))])
    need = demand[kinds].astype(float)
    used = inverse @ need
    for step in range(20 * size):
        dual = np.zeros(size)
        dual[kinds] = np.maximum(inverse.sum(axis=0), 0)
        best, pattern = price(dual, size)
        if best <= 1 + gap:
            break
        pattern[demand <= 0] = 0
        direction = inverse @ pattern[kinds]
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(len(kinds), np.inf)
        ratio[up] = used[up] / direction[up]
        out = int(np.argmin(ratio))
        columns[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if step % 100 == 99:  # keep rounding errors small
            inverse = _invert(columns[kinds].astype(float))
        used = np.maximum(inverse @ need, 0)
    found: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    for p, times in enumerate(np.floor(used + 1e-9).astype(np.int64)):
        held = columns[:, p] > 0
        times = min(int(times), int((left[held] // columns[held, p]).min()))
        if times > 0:
            found.append((columns[:, p].copy(), times))
            left -= columns[:, p] * times
    return found + _first_fit(left)


def _first_fit(left: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """First-fit decreasing by whole sequences; equal fillings are repeated."""
    size, found = len(left), []
    while left.any():
        pattern, room = np.zeros(size, dtype=np.int64), size
        for u in range(size, 0, -1):
            n = min(int(left[u - 1]), room // u)
            pattern[u - 1], room = n, room - n * u
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        found.append((pattern, times))
        left = left - pattern * times
    return found


def cut(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY,
        text_bytes: int = SLICE_BYTES) -> Table:
    """Encoded pieces of at most ``capacity`` ids, written once."""

    def run(batches):
        enc = encoder(vocabulary, CUT_REMEMBERED)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        piece, wide = TaskContext.get().partitionId() << 33, capacity * enc.width
        for batch in batches:
            for part in in_slices(batch, ENCODED_ROWS, text_bytes):
                rows = []
                ids = enc.encode(part.column("text").to_pylist())
                for doc_id, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    x += end
                    for i in range(0, len(x), wide):
                        got = x[i: i + wide]
                        rows.append((piece, doc_id, i // enc.width, len(got) // enc.width,
                                     len(x) // enc.width, enc.width, got))
                        piece += 1
                if rows:
                    kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds,
                                                        strict=True)],
                        names=["piece", "doc_id", "start", "length", "doc_tokens", "width", "ids"])

    found = plain(docs).mapInArrow(run, _PIECES)
    path = shared_path(docs.sparkSession, "pieces")
    found.write.option("compression", "zstd").parquet(path)
    return Table(docs.sparkSession.read.schema(found.schema).parquet(path), path)


def _slots(plan: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Of every kind, by rank: the first rank that a pattern takes, how many
    each of its sequences takes, its first sequence."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for u in np.flatnonzero(pattern) + 1:
            n = int(pattern[u - 1])
            table.setdefault(int(u), []).append((given.get(int(u), 0), n, sequence))
            given[int(u)] = given.get(int(u), 0) + n * times
        sequence += times
    return {u: tuple(np.array(c) for c in zip(*rows, strict=True)) for u, rows in table.items()}


def _slot_of(slots: dict, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and slot of ranked pieces."""
    seq, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    for u in np.unique(kind):
        at = kind == u
        first, each, base = slots[int(u)]
        p = np.searchsorted(first, rank[at], side="right") - 1
        inside = rank[at] - first[p]
        seq[at], slot[at] = base[p] + inside // each[p], inside % each[p]
    return seq, slot


class Plan:
    """Where ranked pieces go. ``counts`` has the pieces by kind: steps of a
    long piece, the length of a short one below zero."""

    def __init__(self, counts: dict[int, int], size: int, step: int):
        long, short = np.zeros(size, dtype=np.int64), np.zeros(BOX, dtype=np.int64)
        for kind, n in counts.items():
            (short if kind < 0 else long)[abs(kind) - 1] = n
        boxes = patterns(short)
        # bounded by kinds x patterns, both bounded by the sizes
        self.in_box = _slots(boxes)
        held = [-(-int(p @ np.arange(1, BOX + 1)) // step) for p, _ in boxes]
        #: first box of a pattern, its steps, the rank of its first box among pieces as long
        self.box = np.cumsum([0, *[n for _, n in boxes]])[:-1]
        self.steps, self.rank = np.array(held, np.int64), np.zeros(len(boxes), np.int64)
        for i, (u, (_, n)) in enumerate(zip(held, boxes, strict=True)):
            self.rank[i] = long[u - 1]
            long[u - 1] += n
        self.in_sequence = _slots(patterns(long))

    def places(self, kind: np.ndarray, rank: np.ndarray):
        """sequence, and what orders a sequence's pieces: steps, slot, inner."""
        steps, rank, inner = kind.copy(), rank.copy(), np.zeros(len(rank), np.int64)
        short = kind < 0
        if short.any():
            box, slot = _slot_of(self.in_box, -kind[short], rank[short])
            p = np.searchsorted(self.box, box, side="right") - 1
            inner[short] = slot + (-kind[short] << 32)
            steps[short], rank[short] = self.steps[p], self.rank[p] + box - self.box[p]
        seq, slot = _slot_of(self.in_sequence, steps, rank)
        return seq, steps, slot, inner


def _places(ranked: DataFrame, plan: Plan) -> DataFrame:
    """piece, length, sequence_id, units, slot, inner for every ranked piece."""

    def run(batches):
        forget()
        for batch in batches:
            found = plan.places(batch.column("kind").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), batch.column("length"), *[pa.array(x) for x in found]],
                names=["piece", "length", "sequence_id", "units", "slot", "inner"])

    return ranked.select("piece", "length", "kind", "rank").mapInArrow(
        run, "piece long, length long, sequence_id long, units long, slot long, inner long")


def _widen(pieces: DataFrame) -> DataFrame:
    """ids as little-endian unsigned 32-bit integers."""
    names = [c for c in pieces.columns if c not in ("width", "ids")]

    def run(batches):
        forget()
        for batch in batches:
            for part in in_slices(batch):
                ids = [np.frombuffer(x, dtype=f"<u{w}").astype("<u4").tobytes() for x, w in
                       zip(part.column("ids").to_pylist(), part.column("width").to_pylist(),
                           strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(ids, pa.binary())],
                    names=[*names, "ids"])

    kinds = ", ".join(f"{c} long" for c in names)
    return pieces.mapInArrow(run, f"{kinds}, ids binary")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY,
         step: int = STEP, text_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset and ids (little-endian unsigned 32-bit). ``capacity`` is a multiple
    of ``step``, and so is ``BOX``; ``text_bytes`` of text are encoded at a time."""
    pieces = cut(docs, vocabulary, end_id, capacity, text_bytes).df
    # boxes are as long as several short pieces; smaller capacities need none
    short = SHORT if capacity >= BOX else 0
    narrow = stage(pieces.select("piece", "length", F.expr(
        f"if(length <= {short}, -length, (length + {step - 1}) div {step})").alias("kind")),
        "piece-lengths").df
    # bounded by the kinds
    counts = {r.kind: r.n for r in narrow.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    ranked = stage(number(narrow, ["kind"], ["piece"], "rank"), "ranked-pieces").df
    before = (Window.partitionBy("sequence_id").orderBy(F.desc("units"), "slot", "inner")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = stage(_places(ranked, Plan(counts, capacity // step, step)).select(
        "piece", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")), "placed-pieces").df
    return _widen(pieces.join(placed, "piece").drop("piece"))
