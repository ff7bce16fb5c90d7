"""What a bucket of items gets of a user's history."""

import numpy as np
import pyarrow as pa
import pytest

from itemwise import RecConfig
from itemwise.operators import pair_counts
from itemwise.plans.similarity import cosine_similarity


def _histories(users=60, size=40):
    rng = np.random.default_rng(2)
    rows = [[{"item": int(i), "n": int(rng.integers(1, 40)), "bucket": -1 if i % 97 == 0 else i % 500}
             for i in np.sort(rng.choice(100_000, size, False))] for _ in range(users)]
    return rows, pa.array(rows, pa.list_(pa.struct([("item", pa.int32()), ("n", pa.int64()),
                                                    ("bucket", pa.int32())])))


def test_a_pair_is_sent_once():
    """Uncut, of two items that are not hot one bucket gets the pair; the blocks of
    either kind hold well under 4 bytes an entry."""
    rows, column = _histories()
    sent, got = {}, {}
    for once in (False, True):
        sent[once] = [(b, blob) for b, blob in pair_counts._pack_rows(column, column, once)]
        pairs = []
        for _, blob in sent[once]:
            held, mine, sizes, items, _ = pair_counts._unpacked(blob)
            ends = np.cumsum(sizes.astype(int))
            for u, (i, many) in enumerate(zip(np.split(mine, np.cumsum(held)[:-1]), held)):
                assert len(i) == many
                part = items[ends[u] - sizes[u]:ends[u]]
                assert set(i.tolist()) <= set(part.tolist())
                pairs += [(int(a), int(b)) for a in i for b in part if a != b]
        got[once] = pairs
    cold = {r["item"] for h in rows for r in h if r["bucket"] >= 0}
    all_pairs = [(r["item"], s["item"]) for h in rows for r in h for s in h
                 if r["bucket"] >= 0 and r is not s]
    assert sorted(got[False]) == sorted(all_pairs)
    taken = [(a, b) for a, b in got[True]
             if b not in cold or pair_counts._takes(np.int64(a), np.int64(b))]
    both = taken + [(b, a) for a, b in taken if b in cold]
    assert sorted(both) == sorted(all_pairs)
    assert len(got[True]) < 0.6 * len(got[False])
    size = {k: sum(len(pair_counts._decode(blob)[3]) for _, blob in v) for k, v in sent.items()}
    assert size[True] < 0.6 * size[False]


@pytest.mark.parametrize("step", [4_000_000, 300])
def test_blocks_are_small(step, monkeypatch):
    """Sorted histories are sent as differences: under 3 bytes an entry, ids of 17
    bits and popularities together."""
    monkeypatch.setattr(pair_counts, "STEP_PAIRS", step)
    _, column = _histories(2000)
    one = pa.array([[dict(r, bucket=0) for r in h] for h in column.to_pylist()], column.type)
    blobs = [blob for _, blob in pair_counts._pack_rows(one, one, False)]
    assert sum(map(len, blobs)) < 3 * 2000 * 40 + 2 * 2000 * 40    # histories, and own items


def test_uncut_cosine_with_hot_items(spark, monkeypatch):
    """Both directions of every pair, once each, whatever is hot or cut."""
    rng = np.random.default_rng(3)
    rows = sorted({(f"u{rng.integers(30)}", int(rng.integers(50)) - 20) for _ in range(400)}
                  | {(f"u{u}", 1) for u in range(30)})
    df = spark.createDataFrame([(u, i, 1) for u, i in rows], "user_id string, item bigint, pref int")
    held = {}
    for u, i in rows:
        held.setdefault(u, set()).add(i)
    held = {u: h for u, h in held.items() if len(h) > 1}
    users = {}
    for u, h in held.items():
        for i in h:
            users.setdefault(i, set()).add(u)
    expected = {(i, j): len(users[i] & users[j]) / np.sqrt(len(users[i]) * len(users[j]))
                for i in users for j in users if i != j and users[i] & users[j]}
    for limit, block in ((4_000_000, 4096), (300, 6), (60, 4096)):
        monkeypatch.setattr(pair_counts, "STEP_PAIRS", limit)
        got = cosine_similarity(df, RecConfig(block_size=block)).collect()
        assert len(got) == len(expected)
        assert {(r.i, r.j): r.sim for r in got} == pytest.approx(expected)
