"""Rows of lists sent to their users as compressed blocks.

A shuffle of rows that hold an item's list repeats, for every user of the item,
ids and similarities that no general compression of a shuffle makes small. Here
a task gathers the rows that go to one bundle of users and packs them by column:
users, preferences, sizes of lists, differences of neighbouring ids, kinds, and
similarities as places in a list of the distinct ones, all bit by bit as they were.
The task of a bundle takes its blocks apart, makes the users' items distinct and
sums their terms, some users at a time.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pair_counts import _decode, _encode, _spans, _unzigzag, _zigzag

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entries of lists that a task holds before it packs them, and that
# it sums at a time.
HELD_ENTRIES = 6_000_000
STEP_ENTRIES = 2_000_000

# What an entry of an item's list says of its user: a term of the entry's score,
# a candidate, the item itself.
TERM, CANDIDATE, SEEN = 0, 1, 2
COLUMNS = ("user_id", "pref", "items", "sims", "kinds")
# Forms of a column of ids: integers by their differences, text, any other type.
_INTEGERS, _TEXT, _ANY = 0, 1, 2


def _numbers(values: np.ndarray) -> list[np.ndarray]:
    """Doubles as places among the distinct ones, or as they are."""
    bits = values.view(np.int64)
    if len(bits):
        distinct, place = np.unique(bits, return_inverse=True)
        if 4 * len(distinct) <= 3 * len(bits):
            return [distinct, place.astype(np.int64)]
    return [bits, np.zeros(0, np.int64)]


def _of_numbers(distinct: np.ndarray, place: np.ndarray) -> np.ndarray:
    distinct = distinct.astype(np.int64).view(np.float64)
    return distinct[place] if len(place) else distinct


def _valid(a: pa.Array) -> np.ndarray:
    return a.is_valid().to_numpy(zero_copy_only=False)


def _plain(a: pa.Array) -> np.ndarray:
    """Values of fixed width, whatever stands where there are none."""
    return (a.fill_null(0) if a.null_count else a).to_numpy(zero_copy_only=False)


def _ids(a: pa.Array) -> bytes:
    if pa.types.is_integer(a.type) and not a.null_count:
        return struct.pack("<B", _INTEGERS) + _encode([_zigzag(_plain(a))])
    if pa.types.is_string(a.type):
        offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1]
        raw = a.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]) if a.buffers()[2] else b""
        packed = pa.compress(raw, codec="zstd", asbytes=True)
        lengths = np.where(_valid(a), np.diff(offsets) + 1, 0)
        return (struct.pack("<BII", _TEXT, len(raw), len(packed)) + packed + _encode([lengths]))
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([a], ["v"])
    with pa.ipc.new_stream(sink, batch.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return struct.pack("<B", _ANY) + sink.getvalue().to_pybytes()


def _of_ids(blob: bytes, kind: pa.DataType) -> pa.Array:
    form = blob[0]
    if form == _INTEGERS:
        return pa.array(_unzigzag(_decode(blob[1:])[0])).cast(kind)
    if form == _TEXT:
        size, packed = struct.unpack_from("<II", blob, 1)
        raw = pa.decompress(blob[9:9 + packed], decompressed_size=size, codec="zstd", asbytes=True)
        lengths = _decode(blob[9 + packed:])[0].astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.maximum(lengths - 1, 0))]).astype(np.int32)
        mask = pa.array(lengths > 0).buffers()[1] if (lengths == 0).any() else None
        return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(raw),
                                           mask)
    return pa.ipc.open_stream(blob[1:]).read_all().column(0).combine_chunks()


def _block(users: pa.Array, prefs: pa.Array, sizes: np.ndarray, items: pa.Array, sims: pa.Array,
           kinds: pa.Array) -> bytes:
    known = _valid(sims)
    parts = [_ids(users), _ids(items), _encode([
        *_numbers(_plain(prefs)), _valid(prefs) if prefs.null_count else np.zeros(0, np.int64),
        sizes, _plain(kinds).astype(np.int64) * 2 + known, *_numbers(_plain(sims)[known])])]
    return b"".join(struct.pack("<I", len(p)) + p for p in parts)


def _of_block(blob: bytes, user_type: pa.DataType, item_type: pa.DataType) -> tuple:
    """Users and items as Arrow arrays, then preferences (NaN for none), sizes,
    similarities (NaN for none), whether there is one, and kinds."""
    parts, at = [], 0
    while at < len(blob):
        n, = struct.unpack_from("<I", blob, at)
        parts.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    users, items = _of_ids(parts[0], user_type), _of_ids(parts[1], item_type)
    pref, pref_at, has_pref, sizes, marks, sim, sim_at = _decode(parts[2])
    prefs = _of_numbers(pref, pref_at)
    has_pref = has_pref.astype(bool) if len(has_pref) else np.ones(len(prefs), bool)
    known = (marks & 1).astype(bool)
    sims = np.zeros(len(marks))
    sims[known] = _of_numbers(sim, sim_at)
    return (users, items, prefs, has_pref, sizes.astype(np.int64), sims, known,
            (marks >> 1).astype(np.uint8))


def _pack_rows(rows: pa.Table):
    """``(bundle, block)`` of the rows of each bundle."""
    bundle = rows["bundle"].combine_chunks().to_numpy()
    order = np.argsort(bundle, kind="stable")
    bundle = bundle[order]
    items, sims, kinds = (rows[c].combine_chunks() for c in ("items", "sims", "kinds"))
    sizes = items.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    users, prefs = (rows[c].combine_chunks().take(order) for c in ("user_id", "pref"))
    flat = [c.flatten() for c in (items, sims, kinds)]
    edges = np.flatnonzero(np.diff(bundle, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        places = pa.array(_spans(starts[a:b], sizes[a:b]))
        yield int(bundle[a]), _block(users.slice(a, b - a), prefs.slice(a, b - a), sizes[a:b],
                                     *(c.take(places) for c in flat))


def _pack(held: int):
    def run(batches):
        rows, entries = [], 0
        for batch in batches:
            rows.append(batch)
            entries += len(batch.column(batch.schema.get_field_index("items")).flatten())
            if entries >= held:
                yield from _blocks(rows)
                rows, entries = [], 0
        if rows:
            yield from _blocks(rows)
    return run


def _blocks(batches: list[pa.RecordBatch]):
    rows = pa.Table.from_batches(batches)
    batches.clear()
    some, size = [], 0
    for packed in _pack_rows(rows):
        some.append(packed)
        size += len(packed[1])
        if size > 1 << 24:
            yield _batch(some)
            some, size = [], 0
    if some:
        yield _batch(some)


def _batch(packed: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in packed], pa.int32()),
                                       pa.array([p[1] for p in packed], pa.binary())],
                                      ["bundle", "block"])


def _codes(a: pa.Array) -> tuple[np.ndarray, object]:
    """Numbers below 2**31 in place of values, and how to get values back."""
    if pa.types.is_integer(a.type) and not a.null_count:
        values = _plain(a)
        low = int(values.min()) if len(values) else 0
        if not len(values) or int(values.max()) - low < 1 << 31:
            return (values.astype(np.int64) - low), lambda c: pa.array(c + low).cast(a.type)
    coded = a.dictionary_encode(null_encoding="encode")
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            lambda c: coded.dictionary.take(pa.array(c)))


def _may_be_best(user: np.ndarray, score: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Rows that can be among the ``k`` highest scores of their user once scores
    are rounded by less than ``slack``; ``user`` ascends."""
    order = np.lexsort((-score, user))
    firsts = np.flatnonzero(np.diff(user, prepend=-1))
    sizes = np.diff(np.append(firsts, len(user)))
    last = score[order[firsts + np.minimum(sizes, k) - 1]]
    last[sizes < k] = -np.inf
    return score >= np.repeat(last, sizes) - 2 * slack


def _sum(user_type: pa.DataType, item_type: pa.DataType, out: pa.Schema,
         best: tuple[int, int, bool] | None):
    def run(batches):
        parts = [_of_block(block.as_py(), user_type, item_type)
                 for b in batches for block in b.column(1)]
        if not parts:
            return
        users, items, *numbers = zip(*parts)
        del parts
        users, items = pa.concat_arrays(users), pa.concat_arrays(items)
        no_user = users.null_count > 0
        user, user_of = _codes(users)
        nobody = ~_valid(users) if no_user else None
        item, item_of = _codes(items)
        del users, items
        prefs, has_pref, sizes, sims, known, kinds = (np.concatenate(x) for x in numbers)
        del numbers
        item = item.astype(np.uint32)
        order = np.argsort(user, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        user, sizes, prefs, has_pref = user[order], sizes[order], prefs[order], has_pref[order]
        nobody = nobody[order] if no_user else None
        # whole users, a few million entries at a time
        ends = np.append(np.flatnonzero(np.diff(user)) + 1, len(user))
        load = np.cumsum(sizes)[ends - 1]
        at = 0
        while at < len(ends):
            done = load[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(load, done + STEP_ENTRIES, "right")))
            a, b = (ends[at - 1] if at else 0), ends[to - 1]
            at = to
            places, each = _spans(starts[a:b], sizes[a:b]), sizes[a:b]
            if not len(places):
                continue
            key = np.repeat(user[a:b], each) << 32
            key |= item[places]
            turn = np.argsort(key, kind="stable")
            key, places = key[turn], places[turn]
            row = np.repeat(np.arange(a, b), each)[turn]
            firsts = np.flatnonzero(np.diff(key, prepend=-1))
            there = known[places] & has_pref[row]
            total = np.add.reduceat(np.where(there, prefs[row] * sims[places], 0.0), firsts)
            some = np.logical_or.reduceat(there, firsts)
            marks = np.bitwise_or.reduceat(np.uint8(1) << kinds[places], firsts)
            wanted = (marks & (1 << CANDIDATE)) != 0
            seen = (marks & (1 << SEEN)) != 0
            wanted &= ~(seen & ~nobody[row[firsts]]) if no_user else ~seen
            del places, row, there, turn
            key, total, some = key[firsts][wanted], total[wanted], some[wanted]
            if best and len(key) and not np.isnan(total).any():
                rows = _may_be_best(key >> 32, np.where(some, total, -np.inf if best[2] else 0.0),
                                    best[0], 10.0 ** -best[1])
                key, total, some = key[rows], total[rows], some[rows]
            for x in range(0, len(key), 1 << 17):
                some_keys = key[x:x + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [user_of(some_keys >> 32).cast(out.field(0).type),
                     item_of(some_keys & 0xFFFFFFFF).cast(out.field(1).type),
                     pa.array(total[x:x + (1 << 17)], mask=~some[x:x + (1 << 17)])],
                    schema=out)
    return run


def summed_by_users(rows: DataFrame, tasks: int, keys: list[str],
                    best: tuple[int, int, bool] | None = None) -> DataFrame:
    """``(user_id, item, total)`` of the candidates that a user does not have:
    ``total`` is the sum of ``pref * sims`` of the user's entries of the item, null
    if there are none. ``rows`` are ``(user_id, pref, items, sims, kinds)`` and the
    columns ``keys``, by which they go to ``tasks`` bundles of users. With ``best``
    ``(k, decimals, nulls_last)`` candidates that cannot be among a user's ``k`` highest
    by rounded total may be left out; a null counts as 0 or comes last."""
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    kinds = {f.name: f.dataType for f in rows.schema}
    item = kinds["items"].elementType
    schema = T.StructType([T.StructField("user_id", kinds["user_id"]), T.StructField("item", item),
                           T.StructField("total", T.DoubleType())])
    packed = (rows.select(F.pmod(F.xxhash64(*keys), F.lit(tasks)).cast("int").alias("bundle"),
                          *COLUMNS)
              .mapInArrow(_pack(HELD_ENTRIES), "bundle int, block binary"))
    return packed.repartitionById(tasks, "bundle").mapInArrow(
        _sum(to_arrow_type(kinds["user_id"]), to_arrow_type(item), to_arrow_schema(schema), best),
        schema)
