"""Co-occurring pairs counted by buckets of items.

Every item belongs to one bucket, by a hash. A bucket gets, from each user with
one of its items, those items and the user's whole history; so it alone counts
every pair of its items, in both orders, and can cut each item's list to the
best. What is shuffled are histories, as compressed blocks of integers: a pair
is never a row before it is counted.

Buckets are as many as their pairs ask for, and a task works through its items a
few million pairs at a time, so its memory does not grow with the input. An item
with more pairs than one such step holds is hot: it is a neighbour here, and its
own list is counted by the salted join of ``cooccurrence``. Histories longer than
``block_size`` arrive as pairs of blocks.
"""

from __future__ import annotations

import math
import struct
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs of one bucket, and pairs held at once. An item with more
# pairs than are held at once is hot.
BUCKET_PAIRS = 16_000_000
STEP_PAIRS = 4_000_000
# Items of one user and bucket up to which the user's history is sent without
# items that none of them counts.
MANY_HELD = 4


def item_weights(base: DataFrame) -> DataFrame:
    """``(item, n, pairs)``: popularity (A2) and the rows that the histories of
    the item's users have together. ``base`` has ``user_id, item, k``."""
    return base.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("pairs"))


def _encode(arrays: list[np.ndarray]) -> bytes:
    """Non-negative integers byte by byte (all first bytes, all second, ...),
    compressed."""
    out = []
    for a in arrays:
        wide = "<u4" if not len(a) or (a.min() >= 0 and a.max() < 1 << 32) else "<i8"
        raw = a.astype(wide).view(np.uint8).reshape(-1, int(wide[2])).T.tobytes()
        packed = pa.compress(raw, codec="zstd", asbytes=True)
        out += [struct.pack("<BII", int(wide[2]), len(a), len(packed)), packed]
    return b"".join(out)


def _decode(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        width, n, size = struct.unpack_from("<BII", blob, at)
        at += struct.calcsize("<BII")
        raw = pa.decompress(blob[at:at + size], decompressed_size=n * width, codec="zstd",
                            asbytes=True)
        at += size
        planes = np.frombuffer(raw, np.uint8).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view("<u4" if width == 4 else "<i8"))
    return out


def _zigzag(a: np.ndarray) -> np.ndarray:
    """Differences of neighbours as integers that are small and not negative
    where the differences are small."""
    d = np.diff(a.astype(np.int64), prepend=0)
    return (d << 1) ^ (d >> 63)


def _unzigzag(z: np.ndarray) -> np.ndarray:
    z = z.astype(np.int64)
    return np.cumsum(((z >> 1) & 0x7FFFFFFFFFFFFFFF) ^ -(z & 1))


def _narrow(a: np.ndarray) -> np.ndarray:
    """Integers of 4 bytes where they fit."""
    fits = not len(a) or (a.min() >= 0 and a.max() < 1 << 32)
    return a.astype(np.uint32) if fits else a


def _takes(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the pair is counted at ``i``; it is so at one of the two."""
    return (((i ^ j) & 1) == 0) == (i < j)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start .. start + length - 1`` of every span, in a row."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _column(lists: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, lists.flatten()


def _field(values: pa.StructArray, name: str) -> np.ndarray:
    return pc.struct_field(values, name).to_numpy(zero_copy_only=False)


def _pack_rows(own: pa.Array, history: pa.Array, once: bool):
    """``(bucket, blob)`` of some users: a blob holds, per user with items of
    the bucket, those items and the history with its popularities. With ``once`` a
    history is sent without items whose pairs are counted at their own bucket."""
    sizes, values = _column(history)
    starts = np.cumsum(sizes) - sizes
    items, ns = _field(values, "item").astype(np.int64), _field(values, "n")
    hot = _field(values, "bucket") < 0
    own_sizes, own_values = _column(own)
    rows = np.repeat(np.arange(len(own_sizes)), own_sizes)
    buckets, mine = _field(own_values, "bucket"), _field(own_values, "item").astype(np.int64)
    cold = np.flatnonzero(buckets >= 0)
    order = cold[np.argsort(buckets[cold], kind="stable")]
    buckets, mine, rows = buckets[order], mine[order], rows[order]
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for part in np.split(np.arange(len(buckets)), cuts):
        if not len(part):
            continue
        users, firsts, held = np.unique(rows[part], return_index=True, return_counts=True)
        places, sent = _spans(starts[users], sizes[users]), sizes[users]
        if once:
            needed = hot[places] | np.repeat(held > MANY_HELD, sent)
            for t in range(min(MANY_HELD, held.max())):
                i = np.repeat(mine[part][np.minimum(firsts + t, firsts + held - 1)], sent)
                needed |= _takes(i, items[places]) | (i == items[places])
            sent = np.add.reduceat(needed, np.cumsum(sent) - sent, dtype=np.int64)
            places = places[needed]
        yield int(buckets[part[0]]), _encode([held, _zigzag(mine[part]), sent,
                                              _zigzag(items[places]),
                                              ns[places] * 2 + hot[places]])


def _pack(once: bool):
    def run(batches):
        for batch in batches:
            own, history = batch.column(0), batch.column(1)
            pairs = np.cumsum(_column(own)[0] * _column(history)[0])
            step = pairs // (2 * STEP_PAIRS) if len(pairs) else pairs
            edges = [0, *(np.flatnonzero(np.diff(step)) + 1), len(pairs)]
            for a, b in zip(edges, edges[1:]):
                packed = list(_pack_rows(own.slice(a, b - a), history.slice(a, b - a), once))
                if packed:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[0] for p in packed], pa.int32()),
                         pa.array([p[1] for p in packed], pa.binary())], ["bucket", "blob"])
    return run


def _unpacked(blob: bytes) -> tuple:
    held, mine, sizes, items, ns = _decode(blob)
    return held, _narrow(_unzigzag(mine)), sizes, _narrow(_unzigzag(items)), ns


def _best_rows(which: np.ndarray, sim: np.ndarray, n: int) -> np.ndarray:
    """Rows that can be among the ``n`` most similar of their item; ``which``
    ascends. Similarities are compared as 32-bit floats, whose order agrees
    but for ties, and ties stay."""
    low = (~sim.astype(np.float32).view(np.uint32)).astype(np.int64)
    key = (which << 32) | low
    ordered = np.sort(key)
    starts = np.flatnonzero(np.diff(which, prepend=-1))
    ends = np.append(starts[1:], len(which))
    last = ordered[np.minimum(starts + n, ends) - 1]
    return np.flatnonzero(key <= np.repeat(last, ends - starts))


def _count(value: str, best: int | None, item_type: pa.DataType, once: bool):
    """Blobs of whole buckets to ``(i, j, c)`` or ``(i, j, sim)``; with ``once`` a
    pair of two items that are not hot is in one bucket and returned both ways."""
    def run(batches):
        parts = [_unpacked(blob.as_py()) for b in batches for blob in b.column(1)]
        if not parts:
            return
        held, mine, sizes, items, ns = (np.concatenate(x) for x in zip(*parts))
        del parts
        sizes = sizes.astype(np.int64)
        low, high = int(items.min()), int(items.max())
        if high - low < max(4 * len(items), 1 << 20):
            ids = None
            codes = (items - items.dtype.type(low)).astype(np.uint32)
            width = high - low + 1
        else:
            ids, codes = np.unique(items, return_inverse=True)
            codes, width = codes.astype(np.uint32), len(ids)
        del items
        popularity = np.zeros(width, dtype=np.int64)
        popularity[codes] = ns >> 1
        hot = np.zeros(width, dtype=bool)
        hot[codes] = ns & 1
        del ns
        user = np.repeat(np.arange(len(held)), held)
        starts = np.cumsum(sizes) - sizes
        mine = mine.astype(np.int64)
        mine = mine - low if ids is None else np.searchsorted(ids, mine)
        order = np.argsort(mine, kind="stable")
        mine, user = mine[order], user[order]
        # whole items, a few million pairs at a time
        ends = np.append(np.flatnonzero(np.diff(mine)) + 1, len(mine))
        load = np.cumsum(sizes[user])[ends - 1]
        at = 0
        while at < len(ends):
            done = load[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(load, done + STEP_PAIRS, "right")))
            a, b = (ends[at - 1] if at else 0), ends[to - 1]
            at = to
            users = user[a:b]
            key = np.repeat(mine[a:b], sizes[users]) << 32
            key |= codes[_spans(starts[users], sizes[users])]
            key.sort()
            firsts = np.flatnonzero(np.diff(key, prepend=-1))
            c = np.diff(np.append(firsts, len(key)))
            key = key[firsts]
            i, j = key >> 32, key & 0xFFFFFFFF
            other = i != j
            if once:
                other &= hot[j] | _takes(*((i, j) if ids is None else (ids[i], ids[j])))
            i, j, c = i[other], j[other], c[other]
            if not len(i):
                continue
            out = c
            if value == "sim":
                out = c / np.sqrt(popularity[i].astype(np.float64) * popularity[j])
                if best:
                    rows = _best_rows(i, out, best)
                    i, j, out = i[rows], j[rows], out[rows]
                    order = np.lexsort((j, -out, i))
                    firsts = np.flatnonzero(np.diff(i, prepend=-1))
                    place = np.arange(len(i)) - np.repeat(firsts, np.diff(np.append(firsts, len(i))))
                    rows = order[place < best]
                    i, j, out = i[rows], j[rows], out[rows]
            if once:
                back = ~hot[j]
                i, j = np.concatenate([i, j[back]]), np.concatenate([j, i[back]])
                out = np.concatenate([out, out[back]])
            i, j = (i + low, j + low) if ids is None else (ids[i], ids[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i).cast(item_type), pa.array(j).cast(item_type), pa.array(out)],
                ["i", "j", value])
    return run


def bucket_pairs(base: DataFrame, weights: DataFrame, block_size: int, value: str,
                 best: int | None = None) -> DataFrame:
    """``(i, j, c)`` or, for ``value`` ``"sim"``, ``(i, j, sim)`` of every item ``i``
    that is not hot and every other item ``j`` of its users; with ``best`` only
    the most similar of each ``i``, ties by ``j``; without it each pair is counted
    at one of its items. ``base`` has ``user_id, item, k``;
    give ``weights`` (``item_weights``) as a written table."""
    cold = F.col("pairs") <= STEP_PAIRS
    total = weights.where(cold).agg(F.sum("pairs").alias("p")).first().p or 0
    buckets = max(weights.sparkSession.sparkContext.defaultParallelism,
                  math.ceil(total / BUCKET_PAIRS))
    bucket = F.when(cold, F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int")).otherwise(-1)
    nb = F.greatest(F.lit(1), F.ceil(F.col("k") / F.lit(block_size))).cast("int")
    rows = (base.select("user_id", "item", nb.alias("nb"))
            .join(weights.select("item", F.col("n").cast("long").alias("n"),
                                 bucket.alias("bucket")), "item"))

    def histories(where):
        return (rows.where(where).withColumn("b", F.pmod(F.xxhash64("item"), F.col("nb")).cast("int"))
                .groupBy("user_id", "nb", "b")
                .agg(F.sort_array(F.collect_list(F.struct("item", "n", "bucket")))
                     .alias("history")))

    whole = histories(F.col("nb") == 1).select(F.col("history").alias("own"), "history")
    cut = histories(F.col("nb") > 1)
    mine = cut.select("user_id", F.col("history").alias("own"),
                      F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"))
    crossed = mine.join(cut.select("user_id", "b", "history"), ["user_id", "b"]).select("own",
                                                                                       "history")
    # uncut, a pair is counted at one of its items and returned both ways
    once = best is None
    packed = whole.unionByName(crossed).mapInArrow(_pack(once), "bucket int, blob binary")
    kind = base.schema["item"].dataType
    schema = T.StructType([T.StructField("i", kind), T.StructField("j", kind), T.StructField(
        value, T.DoubleType() if value == "sim" else T.LongType())])
    arrow = pa.int32() if isinstance(kind, T.IntegerType) else pa.int64()
    return packed.repartitionById(buckets, "bucket").mapInArrow(
        _count(value, best, arrow, once), schema)
