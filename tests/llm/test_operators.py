"""The training-data operators against brute force, on odd and plain rows."""

import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from itemwise.llm import (exact_dedup, huffman, knn, mixing, ngram_join, packing, paragraphs,
                          quality, sharding, token_counts, tokens)
from itemwise.llm import shingles as near_sets
from itemwise.llm.common import shared_path
from itemwise.llm.tokens import encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RNG = np.random.default_rng(3)
VOCAB = ["".join(RNG.choice(list("abcdefgé"), RNG.integers(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCAB, n))


LONG = prose(300)
PARAGRAPH = prose(60)
TEXTS = [
    "", None, "One two", "one TWO", "a  b \n\n c\td ", " lead and trail ", "x<|endoftext|> y's",
    "İstanbul ÀÉ straße，全角　空白", LONG, LONG, LONG.upper(), LONG + " more", LONG + " words here",
    prose(40) + "\n" + PARAGRAPH, prose(30) + "\n" + PARAGRAPH + "\n" + prose(25),
    PARAGRAPH + " end", prose(3000), *[prose(int(n)) for n in RNG.integers(1, 200, 30)]]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, repeated rows, a null id, and columns whose names clash."""
    rows = [(i, t, "en", None if i % 5 == 4 else f"s{i % 3}", i, f"k{i}")
            for i, t in enumerate(TEXTS)]
    rows += [rows[8], (None, "no id", "en", "s0", 1, "z")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n long, node string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < -1")


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_encode_like_whole_texts(path):
    enc, tok = encoder(path), Tokenizer.from_file(path)
    for got, t in zip(enc.encode(TEXTS), TEXTS, strict=True):
        assert np.frombuffer(got, enc.dtype).tolist() == ids_of(tok, t)


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free, held = huffman.code_lengths(counts, 18), huffman.code_lengths(counts, 5)
    assert sum(2.0 ** -free) == 1
    assert held.max() <= 5 and sum(2.0 ** -held) <= 1
    assert (counts * held).sum() >= (counts * free).sum()
    book = huffman.Codebook(range(10), held)
    ids = RNG.integers(0, 10, 1000)
    assert book.decode(*book.encode(ids), 1000).tolist() == ids.tolist()


def test_token_file_round_trip(spark, docs, none):
    tok = Tokenizer.from_file(BYTE)
    got = sorted(huffman.write_and_read(docs, BYTE).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted([*range(len(TEXTS)), 8])]
    start = 0
    for r in got:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == [*ids_of(tok, text), 2]
        assert r.start == start
        start += r.n_tokens
    assert huffman.write_and_read(none, BYTE).count() == 0


def test_steps_that_encode_nothing_free_the_encoders(spark, monkeypatch):
    steps = []
    kind = type(spark.range(0))
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, g=kind.mapInArrow, **b:
                        steps.append(f) or g(self, f, *a, **b))
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert huffman.write_and_read(docs, BYTE).count() == 2
    encode, *others = steps
    assert len(others) == 3  # counts, blocks, reading
    for step in others:
        encoder(BYTE)
        list(step(iter([])))
        assert not tokens._encoders


def test_encodings_are_few_at_a_time(monkeypatch):
    whole, sizes = Tokenizer.from_file(BYTE), []
    enc = tokens.PieceEncoder(BYTE)

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return self.inner.encode_batch_fast(texts, **options)

    enc.tokenizer = Counting(enc.tokenizer)
    texts = [f"a{i} b-{i}\nc{i}, word" for i in range(3000)]
    got = enc.encode(texts)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(sizes) <= tokens.AT_ONCE


def test_byte_shards(docs, none):
    rows = sharding.byte_shards(docs, 4).collect()
    assert len(rows) == docs.count()
    slots, crcs = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        crcs.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in crcs.values())
    assert sharding.byte_shards(none, 4).count() == 0


def test_differencing_beats_the_largest_item():
    sizes = RNG.integers(1, 10_000, 500)
    sums = np.bincount(sharding.difference(sizes, 8), sizes, 8)
    assert sums.max() - sums.min() <= 20


def test_bundles_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LAST", 100)
    monkeypatch.setattr(sharding, "BUNDLE", 50)
    monkeypatch.setattr(sharding, "PARTS", 8)
    items = spark.range(1000).select(F.col("id").cast("string").alias("item"),
                                     (F.col("id") % 97 + 1).alias("size"))
    rows = sharding.assign(items, 4).join(items, "item").collect()
    by_item = {r.item: r.shard for r in rows}
    assert len(by_item) == len(rows) == 1000
    sums = np.bincount([r.shard for r in rows], [r["size"] for r in rows], 4)
    assert sums.max() - sums.min() <= 10


def test_mix(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    size = {}
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id]
        assert r.size == len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        assert r.taken in (0, r.size, 2 * r.size)
        size[r.source] = size.get(r.source, 0) + r.size
    names = [*sorted(s for s in size if s), None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        target |= {s: 2 * size[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ = open_ - full if full else set()
    for s in names:
        mine = [r for r in rows if r.source == s]
        assert all(abs(r.target - target[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(none).count() == 0
    assert set(mixing.mixed_documents(docs).columns) == set(docs.columns)


def test_quality_tables_learn_a_pair():
    x = RNG.random((3000, 3))
    y = ((x[:, 0] > .5) ^ (x[:, 1] > .5)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > .5) == y[2000:]).mean() > .9


def test_quality_scores(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 40)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= .7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.quality_scores(docs, labels.limit(0)).count() == docs.count()


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", lowered(text))
    return {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80)])
def test_near_classes(docs, none, words, num):
    rows = ngram_join.near_classes(docs, words, num, 100).collect()
    texts = {i: t for i, t in enumerate(TEXTS)}
    sets = {i: shingles(t, words) for i, t in texts.items()}
    root = {i: i for i in texts}
    for a in texts:
        for b in texts:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= num * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
    assert ngram_join.near_classes(none, words, num, 100).count() == 0


def test_clusters_without_a_hub(spark):
    """A chain: each text links with its neighbours, the ends do not."""
    words = [f"w{i}" for i in range(260)]
    rows = [(i, " ".join(words[4 * i: 4 * i + 100])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in ngram_join.near_classes(df, 3, 90, 100).collect()} == {0}


@pytest.mark.parametrize("rounds", [1, 3])
def test_near_classes_of_texts_that_share_phrases(spark, monkeypatch, rounds):
    """Few words, so that keys have many members that do not link."""
    rng, called = np.random.default_rng(5), []
    texts = []
    for _ in range(150):
        base = rng.choice(9, rng.integers(5, 14)).tolist()
        texts.append(base)
        for _ in range(int(rng.integers(0, 3))):
            near = list(base)
            near[int(rng.integers(len(near)))] = int(rng.integers(9))
            texts.append(near)
    texts = [" ".join(f"w{x}" for x in t) for t in texts]
    blocks = near_sets._blocks
    monkeypatch.setattr(near_sets, "ROUNDS", rounds)
    monkeypatch.setattr(near_sets, "_blocks", lambda *a: called.append(1) or blocks(*a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.near_classes(df, 2, 60, 100).collect()}
    sets = [shingles(t, 2) for t in texts]
    root = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = [low if v == high else v for v in root]
    assert 50 < len(set(root)) < len(texts)
    assert got == dict(enumerate(root)) and called


@pytest.mark.parametrize("num", [60, 80, 90])
def test_sketches_rule_out_no_link(spark, num):
    """Every pair that links stays, at the very bound too; most others go."""
    rng, sets = np.random.default_rng(num), []
    for n in (1, 2, 9, 19, 40, 300, 2000, 9000):
        whole = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        sets.append(np.unique(whole))
        for gone in {0, 1, n * (100 - num) // 100, n * (100 - num) // 100 + 1, n // 2}:
            sets.append(np.unique(whole[gone:]) if gone < n else whole[:1])
            sets.append(np.unique(np.append(whole, rng.integers(0, 1 << 63, gone,
                                                                dtype=np.uint64))))
    sizes = spark.createDataFrame(
        [(i, len(s), near_sets.cells(s), *near_sets.sketch(s).tolist())
         for i, s in enumerate(sets)],
        "node long, n long, cells binary, " + ", ".join(f"{c} long" for c in near_sets.SKETCH))
    pairs = list(itertools.combinations(range(len(sets)), 2))
    left = {tuple(r) for r in near_sets.could_link(
        spark.createDataFrame(pairs, "lead long, node long"), sizes, num, 100).collect()}
    counted = {tuple(r) for r in near_sets.cells_allow(
        spark.createDataFrame(pairs, "lead long, node long"), sizes, num, 100).collect()}
    rows = sizes.toPandas().assign(root=range(len(sets)), side=0)
    live = near_sets.live_rows(rows, num, 100)
    by_side = near_sets.live_rows(rows.assign(side=rows["node"] % 2), num, 100)
    for a, b in pairs:
        n = len(np.intersect1d(sets[a], sets[b]))
        if 100 * n >= num * (len(sets[a]) + len(sets[b]) - n):
            assert (a, b) in left and (a, b) in counted and live[a] and live[b]
            assert (a + b) % 2 == 0 or (by_side[a] and by_side[b])
    assert len(left) < len(pairs) / 4 and len(counted) < len(pairs) / 2
    assert near_sets.live_rows(rows.assign(root=0), num, 100).sum() == 0


def test_repeated_paragraphs(docs, none):
    rows = paragraphs.repeated_paragraphs(docs, 20).collect()
    found = {(r.doc_id, r.paragraph) for r in rows}
    assert {(14, 1), (15, 0), (9, 0), (11, 0)} <= found and (13, 1) not in found
    for r in rows:
        if r.doc_id == 14:
            assert TEXTS[14][r.start: r.start + r.length] == PARAGRAPH
    assert not {d for d, _ in found if d is not None and d > 16}
    assert paragraphs.repeated_paragraphs(none).count() == 0


@pytest.mark.parametrize("step", [16, 64])
def test_patterns_cover_the_demand(step):
    units = np.minimum(RNG.lognormal(4, 1, 5000).astype(int) + 1, 4096 // step)
    demand = np.bincount(units, minlength=4096 // step + 1)[1:]
    plan = packing.patterns(demand)
    size = np.arange(1, len(demand) + 1)
    assert (sum(p * n for p, n in plan) == demand).all()
    assert all((p * size).sum() <= len(demand) for p, _ in plan)
    assert sum(n for _, n in plan) <= (demand * size).sum() / len(demand) * 1.02 + 5


def test_pack(docs, none):
    tok = Tokenizer.from_file(WORD)
    rows = packing.pack(docs, WORD).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, got in by_doc.items():
        text = "no id" if d is None else TEXTS[d]
        want = [*ids_of(tok, text), 2]
        got = {(r.start, bytes(r.ids)) for r in got}
        assert [i for _, x in sorted(got) for i in np.frombuffer(x, "<u4")] == want
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(none, WORD).count() == 0


def test_knn(spark):
    vec = [[float(x) for x in RNG.normal(size=4)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vec)] + [(300 + i, vec[0]) for i in range(40)]
    rows += [(900, None), (901, [1.0, None]), (950, [float("nan")] * 4), (None, vec[1]),
             (1000, [.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in knn.voronoi_knn(df, F.col("vec_id") % 50 == 0, 5, pivots=7, block=32).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ints = {i: np.pad(np.floor(256 * np.float32(v).astype(float)), (0, 4 - len(v)))
            for i, v in rows if i is not None and i not in (900, 901, 950)}
    assert set(got) == {i for i in ints if i % 50 == 0}
    for q, ranks in got.items():
        best = sorted((-int(ints[q] @ w), i) for i, w in ints.items() if i != q)[:5]
        assert [ranks[k] for k in range(1, 6)] == [(i, -s) for s, i in best]
    assert knn.voronoi_knn(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup(docs, none, keep):
    rows = exact_dedup.exact_dedup(docs, keep, fan_in=2).collect()
    groups = {}
    for d, t in [*enumerate(TEXTS), (8, TEXTS[8]), (None, "no id")]:
        groups.setdefault(lowered(t), []).append(d)
    best = {k: (max if keep == "max" else min)(v) for k, v in groups.items()}
    assert len(rows) == docs.count()
    assert sum(r.kept for r in rows) == len(groups)
    for r in rows:
        key = lowered("no id" if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.keep_id, r.group_size) == (best[key], len(groups[key]))
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_copies(docs, keep).count() == len(groups)


def test_token_counts_grow_the_cache(spark, docs, none):
    tok, cache = Tokenizer.from_file(BYTE), shared_path(spark, "cache")
    token_counts.token_counts(docs.where("doc_id < 12"), BYTE, cache).count()
    first = spark.read.parquet(cache).count()
    for _ in range(2):
        rows = token_counts.token_counts(docs, BYTE, cache).collect()
        assert len(rows) == docs.count()
        for r in rows:
            text = ("no id" if r.doc_id is None else TEXTS[r.doc_id]) or ""
            assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(ids_of(tok, text)))
    texts = {t or "" for t in TEXTS} | {"no id"}
    assert first < spark.read.parquet(cache).count() == len(texts)
    assert token_counts.token_counts(none, BYTE, cache).count() == 0


def test_drop_copies_keeps_columns_of_clashing_names(spark):
    rows = [(1, "a b", "x", 5), (2, "A b", "y", 6), (2, "A b", "z", 7), (None, None, "w", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _digest long")
    got = [tuple(r) for r in exact_dedup.drop_copies(docs).collect()]
    assert len(got) == 2 and set(got) <= set(rows)


def covered(rows, doc, text):
    """Characters of a text that the result's rows cover, none of them twice."""
    marks = np.zeros(len(text), dtype=int)
    for r in rows:
        if r.doc_id == doc:
            marks[r.start: r.start + r.length] += 1
            got = text[r.start: r.start + r.length]
            assert len(got.split()) == r.n_words and got[0] not in " \n"
            assert text[: r.start].count("\n") == r.paragraph
    assert marks.max() < 2
    return marks.astype(bool)


def test_repeated_passage_inside_long_lines(spark):
    """60 words inside lines that are otherwise different."""
    texts, cases = [], []
    for i in range(0, 20, 2):
        passage, heads = prose(60), [prose(int(n)) + f" é{n} " for n in RNG.choice(200, 4, False) + 300]
        louder = re.sub("[a-z]", lambda m: m[0].upper(), passage)
        texts += [heads[0] + passage + " " + heads[1], "x\n" + heads[2] + louder + " " + heads[3]]
        cases.append((i, 2 + len(heads[2]), len(passage)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(df).collect()
    assert {(r.doc_id, r.paragraph, r.keep_doc_id, r.keep_paragraph) for r in rows} == {
        (i + 1, 1, i, 0) for i, _, _ in cases}
    for i, at, length in cases:
        marks = covered(rows, i + 1, texts[i + 1])
        assert not marks[:at].any() and not marks[at + length:].any()
        assert sum(r.n_words for r in rows if r.doc_id == i + 1) >= 60 - 2 * 9


def test_repeated_passage_in_short_lines(spark):
    """60 words in lines of 10, and the same words in one line or in lines of 7."""
    texts, cases = [], []
    for i in range(0, 30, 3):
        words = prose(60).split()
        laid = [[" ".join(words[j: j + n]) for j in range(0, 60, n)] for n in (10, 60, 7)]
        for lines in laid:
            n = len(texts)
            # no word is next to the passage in two texts
            around = [[f"a{n}b{j}c{k}" for j in range(10)] for k in range(40)]
            around = [" ".join(x) for x in around]
            texts.append("\n".join([*around[:20], *lines, "", *around[20:]]))
            cases.append((n, i, len("\n".join(around[:20])) + 1, len("\n".join(lines))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(df).collect()
    assert {r.doc_id for r in rows} == {n for n, i, _, _ in cases if n != i}
    assert all(r.doc_id - r.doc_id % 3 <= r.keep_doc_id < r.doc_id for r in rows)
    for n, i, at, length in cases:
        if n != i:
            marks = covered(rows, n, texts[n])
            assert not marks[:at].any() and not marks[at + length:].any()
            assert sum(r.n_words for r in rows if r.doc_id == n) >= 60 - 2 * 9


def test_repeated_paragraphs_of_repeated_rows_and_ids(spark):
    """A row given twice counts once; texts of one id or none are documents."""
    head, tails = prose(40), [prose(30) for _ in range(3)]
    texts = [f"{head}\n{t}" for t in tails]
    schema = "doc_id long, text string"
    for ids in ([1, 2, 3], [None] * 3, [7] * 3):
        df = spark.createDataFrame(list(zip(ids, texts, strict=True)) + [(ids[2], texts[2])] * 3,
                                   schema)
        rows = paragraphs.repeated_paragraphs(df).collect()
        assert sorted((r.doc_id or 0, r.paragraph, r.start, r.length, r.n_words, r.keep_doc_id)
                      for r in rows) == sorted((d or 0, 0, 0, len(head), 40, ids[0])
                                               for d in ids[1:])


def test_lines_equal_those_of_single_texts():
    """Paragraphs of many texts at once, against one line at a time."""
    texts = [*TEXTS, "a b c\n\n" + "d e f g h " * 6 + "\né ü  ß\tx\r\ny", "\n", "w", "😀 a b\nc"]
    for least in (1, 3, 20):
        x = paragraphs.Lines(texts, least)
        want = []
        for i, text in enumerate(texts):
            at = start = 0
            for j, line in enumerate((text or "").split("\n")):
                words = line.encode().split()
                if len(words) >= least:
                    got = near_sets.shingle_set(line.encode(), paragraphs.WORDS)
                    want.append((i, j, at, start, len(line), len(words), len(got), tuple(got)))
                at, start = at + len(words), start + len(line) + 1
        sets = [tuple(np.sort(s)) for s in np.split(x.shingles, np.cumsum(x.n)[:-1])]
        assert list(zip(x.row, x.line, x.at, x.start, x.length, x.n_words, x.n, sets,
                        strict=True)) == want
        assert len(set(zip(x.node, sets, strict=True))) == len(set(x.node)) == len(set(sets))
    assert len(paragraphs.Lines([], 20).node) == len(paragraphs.Lines(["", None], 1).node) == 0


def test_bands_of_similar_sets_meet():
    """Values of a signature agree as often as the sets' Jaccard says."""
    values = near_sets.mix(np.arange(40_000, dtype=np.uint64)).reshape(400, 100)
    one, two = values[:, :90], values[:, 10:]  # Jaccard 0.8
    keys = [paragraphs.bands(x.ravel(), np.full(400, 90)) for x in (one, two)]
    same = (keys[0] == keys[1]).mean()
    assert abs(same - 0.8 ** paragraphs.ROWS) < 0.03
    assert (keys[0] == keys[1]).any(axis=1).mean() > 0.995
    assert not (keys[0][1:] == keys[1][:-1]).any()


def test_repeated_stretch_is_one_row(spark):
    passage = prose(200)
    texts = [f"{prose(50)} {passage} {prose(50)}" for _ in range(2)]
    rows = paragraphs.repeated_paragraphs(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.doc_id for r in rows] == [1] and rows[0].n_words >= 200 - 2 * 9
    assert texts[1][rows[0].start:][: rows[0].length].strip() in passage


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_marks_after_letters_that_are_normalised(path):
    enc, tok = encoder(path), Tokenizer.from_file(path)
    words = ["İ", "Hİ", "a\u0958", "a\u09dc", "\u0a59", "\ufb2a", "é", "straße", "plain"]
    texts = [f"x {w}{m} y" for w in words for m in ",."]
    for got, t in zip(enc.encode(texts), texts, strict=True):
        assert np.frombuffer(got, enc.dtype).tolist() == ids_of(tok, t)
