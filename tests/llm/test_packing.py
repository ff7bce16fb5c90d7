"""Places of short and long pieces, without Spark and with it."""

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from itemwise.llm import packing, tokens

RNG = np.random.default_rng(11)
SIZE = packing.CAPACITY // packing.STEP


def placed(lengths):
    """sequence of every piece, and the order of the pieces in it."""
    kind = np.where(lengths <= packing.SHORT, -lengths, -(-lengths // packing.STEP))
    rank = np.zeros(len(kind), dtype=np.int64)
    for k in np.unique(kind):
        rank[kind == k] = np.arange((kind == k).sum())
    counts = dict(zip(*[x.tolist() for x in np.unique(kind, return_counts=True)], strict=True))
    return packing.Plan(counts, SIZE, packing.STEP).places(kind, rank)


@pytest.mark.parametrize("name, lengths", [
    ("short", RNG.integers(1, 14, 20_000)), ("one", np.array([1])),
    ("ties", np.full(5000, 128)), ("edge", RNG.integers(100, 160, 5000)),
    ("ones", np.full(10_000, 1)), ("full", np.full(9, 4096)),
    ("mixed", np.concatenate([RNG.integers(1, 30, 8000), RNG.integers(1, 4097, 3000)]))])
def test_places(name, lengths):
    seq, units, slot, inner = placed(lengths)
    assert np.bincount(seq, weights=lengths).max() <= packing.CAPACITY
    # no two pieces share a place, so their order in a sequence is one
    assert len(set(zip(seq.tolist(), units.tolist(), slot.tolist(), inner.tolist(),
                       strict=True))) == len(lengths)
    used, least = len(np.unique(seq)), -(-int(lengths.sum()) // packing.CAPACITY)
    assert used == seq.max() + 1
    if name in ("short", "ties", "ones", "mixed"):
        assert used <= least * 1.02 + 1


def test_short_documents(spark):
    """Little padding where every document is shorter than a step."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    words = ["one", "two", "three", "words", "here"]
    texts = [" ".join(RNG.choice(words, int(n))) for n in RNG.integers(0, 12, 6000)]
    rows = packing.pack(spark.createDataFrame(
        list(enumerate([*texts, None])), "doc_id long, text string"), path).collect()
    want = {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate([*texts, ""])}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= packing.CAPACITY
    total = sum(map(len, want.values()))
    assert len(by_sequence) <= -(-total // packing.CAPACITY) + 1


def test_workers_hold_little(spark, monkeypatch):
    """Small slices and caches while pieces are cut, no encoder afterwards."""
    steps, sizes = [], []
    kind = type(spark.range(0))
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, g=kind.mapInArrow, **b:
                        steps.append(f) or g(self, f, *a, **b))
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert corpus_pipeline.pack(spark, docs, "").count() == 2
    cut, *others = steps
    assert len(others) == 2  # places, ids as they are returned
    for step in others:
        tokens.encoder(path)
        list(step(iter([])))
        assert not tokens._encoders
    encode = tokens.PieceEncoder.encode
    monkeypatch.setattr(tokens.PieceEncoder, "encode", lambda self, texts:
                        sizes.append(sum(map(len, texts))) or encode(self, texts))
    monkeypatch.setattr(packing, "TaskContext", Task)
    many = ["some words of a text. " * 500] * 1000
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": many})
    rows = [n for b in cut(iter([batch])) for n in b.column("doc_tokens").to_pylist()]
    one = len(Tokenizer.from_file(path).encode(many[0], add_special_tokens=False).ids) + 1
    assert rows and set(rows) == {one} and len(rows) == 1000 * -(-one // packing.CAPACITY)
    assert sum(sizes) == 1000 * len(many[0]) and max(sizes) <= packing.CLOSE_BYTES
    assert tokens._encoders[path].remembered < tokens.REMEMBERED
    tokens.forget()


def test_cache_is_bounded():
    enc = tokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    enc.remembered = 100
    enc.encode([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k)}"
                         for i in range(90)) for k in range(3)])
    for k in range(9):
        enc.encode([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + k)}"
                             for i in range(90))])
        assert len(enc.letters.young) + len(enc.letters.old) <= 2 * (100 + 300)


class Task:
    """Stands for Spark's task context."""

    @staticmethod
    def get():
        return Task

    @staticmethod
    def partitionId():
        return 0
