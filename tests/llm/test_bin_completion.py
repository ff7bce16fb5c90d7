"""Bin completion against exhaustive packing, and whole packings of documents."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from itemwise.llm import bin_completion

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def fewest(items, size):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {size - b for b in bins if size - b >= items[i]}:
            at = bins.index(size - room)
            go(i + 1, bins[:at] + [bins[at] + items[i]] + bins[at + 1:])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def sequences(plan, count):
    """How many; every piece is placed once and nothing overflows."""
    placed = np.zeros_like(count)
    for filling, times in plan:
        assert times > 0 and sum(u * n for u, n in filling) < len(count)
        for u, n in filling:
            placed[u] += n * times
    assert (placed[1:] == count[1:]).all()
    return sum(times for _, times in plan)


def test_search_finds_the_least_number():
    rng = np.random.default_rng(7)
    for _ in range(250):
        size = int(rng.integers(4, 40))
        items = rng.integers(1, size + 1, rng.integers(0, 11))
        count = np.bincount(items, minlength=size + 1)
        least = fewest(items.tolist(), size)
        assert bin_completion.lower_bound(count) <= least
        assert sequences(bin_completion.complete(count), count) == least
        assert sequences(bin_completion.best_fit(count), count) >= least


def test_search_beats_best_fit_and_stays_near_the_bound():
    rng = np.random.default_rng(2)
    for items, slack in ((rng.integers(500, 800, 2000), 0.06),
                         (np.minimum(2048, rng.lognormal(5.5, 1.2, 50_000).astype(int) + 1), 1e-3),
                         (rng.integers(1, 12, 20_000), 0), (np.full(999, 512), 0)):
        count = np.bincount(items, minlength=2049)
        got = sequences(bin_completion.complete(count), count)
        assert got <= sequences(bin_completion.best_fit(count), count)
        assert got <= np.ceil(bin_completion.lower_bound(count) * (1 + slack))
    count = np.bincount(rng.integers(500, 800, 2000), minlength=2049)
    assert (sequences(bin_completion.complete(count), count)
            < sequences(bin_completion.best_fit(count), count))


def test_a_filling_that_one_outside_piece_betters_is_dominated():
    count = np.zeros(21, dtype=np.int64)
    count[[3, 4, 7]] = 1
    # 3 + 4 gives way to 7; 7 + 3 leaves nothing of ten
    assert list(bin_completion.fillings(10, count, 10))[0] == (0, [7, 3])
    assert (3, [4, 3]) not in list(bin_completion.fillings(10, count, 10))


TEXTS = ["", None, "a b c", "word " * 3000, "x", "same text", "same text", "İ, y\n z",
         "long " * 2047, "edge " * 2048, *[f"text {i} " * (17 * i) for i in range(60)]]


@pytest.mark.parametrize("capacity", [2048, 50])
def test_documents_come_back_whole(spark, capacity):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(6, "same text", 6), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long")
    got = bin_completion.pack(docs, BYTE, 0, capacity).collect()
    tok, seats, ids = Tokenizer.from_file(BYTE), defaultdict(list), defaultdict(list)
    for r in got:
        seats[r.sequence_id].append((r.offset, r.length))
        ids[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32))
    for places in seats.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    copies = Counter(i for i, _, _ in rows)
    for i, t, _ in rows:
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(want) % capacity or capacity
        starts = [0, *range(first, len(want), capacity)]
        expected = [(p, a, b - a, np.array(want[a:b], "<u2").tobytes(),
                     zlib.crc32(np.array(want[a:b], "<u4").tobytes()))
                    for p, (a, b) in enumerate(zip(starts, [*starts[1:], len(want)], strict=True))]
        assert sorted(ids[i]) == sorted(expected * copies[i])
    total = sum(r.length for r in got)
    assert len(seats) <= 1.03 * total / capacity + 1


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bin_completion.pack(docs, BYTE).count() == 0
