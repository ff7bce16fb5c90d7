"""Substring deduplication by paragraph MinHash banding and exact passages.

A paragraph is a line of a text with at least ``MIN_WORDS`` words. Its
distinct five-word shingles give a MinHash signature of ``BANDS`` bands of
``ROWS`` values: a pair of Jaccard 0.8 shares a band with a probability of
1 - (1 - 0.8^4)^20 = 0.99997, and more similar pairs surer still. Paragraphs
that share a band are verified by exact Jaccard (``shingles.linked``) and
clustered by components; of each cluster the first paragraph stays, by doc_id
and place, and the others are removed.

Passages find what whole lines do not: runs of words inside longer lines, or
over several lines, short ones too. A passage is ``MIN_WORDS`` words of a text,
whatever blanks and line ends stand between them, that begin at a chosen word,
the one of smallest hash (of ``CONTEXT`` words) in any ``WINDOW`` in a row. The
choice depends on the words of the window alone, so both copies of a run of
MIN_WORDS + WINDOW - 1 words (29) or more choose alike and hold at least one
whole common passage (of equal ones that overlap in a text, as those of a word
said over and over do, the first stands for all). Equal passages are one cluster; the first occurrence
stays, and of the others what no removed line and no later removed passage
covers is removed, so rows of a text do not overlap. Neighbouring stretches
that stay in the same document are one row, with the cluster and place of the
first.

Contract: words as in the n-gram join (A-Z lower-cased, ASCII blanks). Equal
shingle sets are one node, so thousands of copies of a passage are compared
once. Null and empty texts have no paragraphs; rows repeated with the same
doc_id and text are one document, rows of one id or none with other texts are
documents of their own (a null id comes first); an empty table returns none;
other columns are not read. Result: one row per paragraph or passage to remove: doc_id, paragraph
(line number from 0, of a passage the line it begins in), start and length
(characters), n_words, cluster_id, keep_doc_id and keep_paragraph.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import id_key, plain, stage
from itemwise.llm.shingles import (
    HELD_KEYS,
    KEYS,
    LOWER,
    deal_keys,
    in_windows,
    linked,
    mix,
    packed,
    shared_keys,
)
from itemwise.llm.tokens import in_slices

WORDS, NUM, DEN, BANDS, ROWS, MIN_WORDS = 5, 80, 100, 20, 4, 20
#: Chosen words: the smallest hash of ``CONTEXT`` words in ``WINDOW`` places.
CONTEXT, WINDOW = 3, 10
_P = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32)
_FACTORS = mix(np.arange(2001, BANDS * ROWS + 2001, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_BAND = mix(np.arange(1001, BANDS + 1001, dtype=np.uint64))


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row."""
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * _P + h[i: len(out) + i]
    return mix(out)


def _sliding(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``n`` values in a row."""
    best, width = np.minimum if least else np.maximum, 1
    while width < n:
        step = min(width, n - width)
        x = best(x[:-step], x[step:])
        width += step
    return x


def _no_overlap(row: np.ndarray, name_: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Which passages stay so that no equal ones of a text overlap, as those of
    a word said over and over do; of every name some stay."""
    order = np.lexsort((at, name_, row))
    close = np.zeros(len(at), dtype=bool)
    a, b = order[:-1], order[1:]
    close[1:] = (row[a] == row[b]) & (name_[a] == name_[b]) & (at[b] - at[a] < size)
    stay = np.ones(len(at), dtype=bool)
    last = 0
    for i in np.flatnonzero(close):
        if not close[i - 1]:
            last = at[order[i - 1]]
        if at[order[i]] - last < size:
            stay[order[i]] = False
        else:
            last = at[order[i]]
    return stay


def passages(texts: list[str | None], size: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """All passages of some texts: row (place in the list), name, at (first
    word), line, start and length (characters)."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(raws)
    found = joined.translate(LOWER).split()
    names = ["row", "name", "at", "line", "start", "length"]
    need = max(size, CONTEXT + WINDOW - 1)
    if len(found) < need:
        return {k: np.zeros(0, dtype=np.int64) for k in names}
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    raw = np.frombuffer(joined, dtype=np.uint8)
    word = ~_BLANK[raw]
    begin = np.flatnonzero(word & np.concatenate([[True], ~word[:-1]]))
    end = np.flatnonzero(word & np.concatenate([~word[1:], [True]])) + 1
    texts_at = np.cumsum([0, *[len(r) + 1 for r in raws]])[:-1]
    breaks = np.flatnonzero(raw == 10)
    owner = np.searchsorted(texts_at, begin, side="right")
    rare = _runs(h, CONTEXT)
    low = _sliding(rare, WINDOW, least=True)
    # a window over two texts chooses nothing
    low[owner[: len(low)] != owner[CONTEXT + WINDOW - 2:]] = 0
    edge = np.zeros(WINDOW - 1, dtype=np.uint64)
    chosen = np.flatnonzero(rare == _sliding(np.concatenate([edge, low, edge]), WINDOW, least=False))
    chosen = chosen[chosen + size <= len(h)]
    chosen = chosen[owner[chosen] == owner[chosen + size - 1]]
    name_ = np.full(len(chosen), size, dtype=np.uint64)
    for i in range(size):
        name_ = name_ * _P + h[chosen + i]
    row = np.searchsorted(texts_at, begin[chosen], side="right") - 1
    apart = _no_overlap(row, name_, chosen, size)
    row, name_, chosen = row[apart], name_[apart], chosen[apart]
    base = texts_at[row]
    inner = np.flatnonzero((raw & 0xC0) == 0x80)  # bytes that begin no character
    place = [x - np.searchsorted(inner, x) for x in (base, begin[chosen], end[chosen + size - 1])]
    return dict(zip(names, [
        row, mix(name_).view(np.int64), chosen - np.searchsorted(begin, base),
        np.searchsorted(breaks, begin[chosen]) - np.searchsorted(breaks, base),
        place[1] - place[0], place[2] - place[1]], strict=True))


def _distinct(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of the values without those that an owner has already; owners
    ascend. Only values that occur again are sorted by owner."""
    sorted_ = np.sort(values)
    again = np.unique(sorted_[1:][sorted_[1:] == sorted_[:-1]])
    stay = np.ones(len(values), dtype=bool)
    if len(again):
        at = np.flatnonzero(np.isin(values, again))
        at = at[np.lexsort((values[at], owner[at]))]
        a, b = at[:-1], at[1:]
        stay[b[(values[a] == values[b]) & (owner[a] == owner[b])]] = False
    return np.flatnonzero(stay)


class Lines:
    """Paragraphs of some texts, all at once. Arrays with a value per
    paragraph: row (place in the list), line, at (first word), start and
    length (characters), n_words, n (distinct shingles), node (the set's
    name); ``shingles`` holds those of one paragraph after another."""

    def __init__(self, texts: list[str | None], least: int):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.joined = b"\n".join(raws)
        found = self.joined.translate(LOWER).split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
        raw = np.frombuffer(self.joined, dtype=np.uint8)
        word = ~_BLANK[raw]
        begin = np.flatnonzero(word & ~np.concatenate([[False], word])[: len(word)])
        breaks = np.flatnonzero(raw == 10)
        texts_at = np.cumsum([0, *[len(r) + 1 for r in raws]])[:-1]
        low, high = np.append(0, breaks + 1), np.append(breaks, len(raw))
        first = np.searchsorted(begin, low)
        n_words = np.searchsorted(begin, high) - first
        kept = np.flatnonzero(n_words >= max(least, 1))
        self.low, self.high, first, self.n_words = (x[kept] for x in (low, high, first, n_words))
        self.row = np.searchsorted(texts_at, self.low, side="right") - 1
        base = texts_at[self.row]
        inner = np.flatnonzero((raw & 0xC0) == 0x80)  # bytes that begin no character
        chars = [x - np.searchsorted(inner, x) for x in (base, self.low, self.high)]
        self.start, self.length = chars[1] - chars[0], chars[2] - chars[1]
        self.line = kept - np.searchsorted(low, base)
        self.at = first - np.searchsorted(begin, base)
        # a paragraph of fewer words is one shingle
        many = np.maximum(self.n_words - WORDS + 1, 1)
        owner = np.repeat(np.arange(len(kept)), many)
        at = np.arange(len(owner)) + np.repeat(first - (np.cumsum(many) - many), many)
        runs = _runs(h, WORDS) if len(h) >= WORDS else np.zeros(1, dtype=np.uint64)
        shingles = runs[np.minimum(at, len(runs) - 1)]
        for i in np.flatnonzero(self.n_words < WORDS):
            n = self.n_words[i]
            shingles[owner == i] = _runs(h[first[i]: first[i] + n], n)
        stay = _distinct(shingles, owner)
        self.shingles = shingles[stay]
        self.n = np.bincount(owner[stay], minlength=len(kept))
        total = np.add.reduceat(mix(self.shingles ^ _P), self._first()) if len(kept) else \
            np.zeros(0, dtype=np.uint64)
        self.node = mix(total + self.n.astype(np.uint64) * _P).view(np.int64)

    def _first(self) -> np.ndarray:
        return np.cumsum(self.n) - self.n

    def body(self, i: int) -> bytes:
        return self.joined[self.low[i]: self.high[i]]

    def banded(self):
        """Keys of the bands and the name of each distinct set."""
        pick = np.sort(np.unique(self.node, return_index=True)[1])
        if len(pick):
            said = np.zeros(len(self.node), dtype=bool)
            said[pick] = True
            yield from zip(bands(self.shingles[np.repeat(said, self.n)], self.n[pick]),
                           self.node[pick].tolist(), strict=True)


def bands(shingles: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows of one key per band of the MinHash signature, for sets of ``n``
    shingles that stand one after another."""
    first = np.cumsum(n) - n
    short = shingles.astype(np.uint32)
    low = np.stack([np.minimum.reduceat((short ^ s) * m, first)
                    for s, m in zip(_SEEDS, _FACTORS, strict=True)], axis=1).astype(np.uint64)
    rows = low.reshape(len(n), BANDS, ROWS)
    key = np.broadcast_to(_BAND, rows.shape[:2])
    for j in range(ROWS):
        key = mix(key ^ rows[:, :, j])
    return key


def _dealt(batches, size: int):
    """Passages of one task as rows of ``_PASSAGES``, dealt like ``deal_keys``
    does: of those that are equal here one goes to the other tasks (salt 0),
    the rest stay on a salt of this task."""
    salt = TaskContext.get().partitionId() + 1
    held, count, flushed = [], 0, 0

    def deal():
        table = pa.Table.from_batches(held).combine_chunks()
        order = np.argsort(table["name"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        names = table["name"].to_numpy()
        head = np.ones(len(names), dtype=bool)
        head[1:] = names[1:] != names[:-1]
        many = ~head
        many[:-1] |= ~head[1:]
        table = table.append_column("salt", pa.array(
            np.where(head, 0, salt + (flushed << 32)).astype(np.int64)))
        yield from table.append_column("many", pa.array(many)).to_batches(max_chunksize=1 << 16)

    for batch in batches:
        for part in in_slices(batch, 256):
            got = passages(part.column("text").to_pylist(), size)
            row = pa.array(got.pop("row"))
            if not len(row):
                continue
            held.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(row), part.column("h").take(row),
                 *[pa.array(x, pa.int64()) for x in got.values()]],
                names=["doc_id", "h", "name", "at", "paragraph", "start", "length"]))
            count += len(row)
            if count >= HELD_KEYS:
                yield from deal()
                held, count, flushed = [], 0, flushed + 1
    if held:
        yield from deal()


_PASSAGES = ("doc_id long, h long, name long, at long, paragraph long, start long, length long, "
             "salt long, many boolean")


def repeated_passages(named: DataFrame, size: int) -> DataFrame:
    """Passages that an earlier place has too, but for those that overlap it;
    they overlap each other."""
    group = Window.partitionBy("name", "salt")
    shared = stage(
        named.mapInArrow(lambda batches: _dealt(batches, size), _PASSAGES)
        .withColumn("other", (F.count("*").over(group) > 1) | F.max("many").over(group))
        .where("other").drop("other", "salt", "many"), "shared-passages").df
    first = stage(shared.groupBy("name").agg(
        F.min(F.struct("doc_id", "paragraph", "start", "h", "at")).alias("keep")),
        "first-passages").df
    return (shared.join(first, "name")
            .where(f"not (doc_id <=> keep.doc_id and h = keep.h and at < keep.at + {size})")
            .select("doc_id", "h", "at", F.lit(size).cast("long").alias("n_words"), "paragraph",
                    "start", "length", F.col("name").alias("cluster_id"),
                    F.col("keep.doc_id").alias("keep_doc_id"),
                    F.col("keep.paragraph").alias("keep_paragraph")))


def _apart(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Removed lines, and of the removed passages the words that no removed
    line and no later removed passage of the text has; neighbours joined."""
    both = (lines.select(*parts.columns, F.lit(0).alias("kind"))
            .unionByName(parts.withColumn("kind", F.lit(1)))
            .dropDuplicates(["doc_id", "h", "at", "kind"])
            .withColumn("till", F.col("at") + F.col("n_words"))
            .withColumn("stop", F.col("start") + F.col("length")))
    order = Window.partitionBy("doc_id", "h").orderBy("at", "kind")
    line = F.when(F.col("kind") == 0, F.struct("till", "stop", "paragraph"))
    seen = (both.withColumn("line", F.last(line, ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("next", F.lead(F.struct("at", "start")).over(order)))
    part = F.col("kind") == 1
    cut = part & F.coalesce(F.col("line.till") > F.col("at"), F.lit(False))
    met = part & F.coalesce(F.col("next.at") < F.col("till"), F.lit(False))
    start = F.when(cut, F.col("line.stop") + 1).otherwise(F.col("start"))
    at = F.when(cut, F.col("line.till")).otherwise(F.col("at"))
    n_words = F.when(met, F.col("next.at")).otherwise(F.col("till")) - at
    length = F.when(met, F.col("next.start")).otherwise(F.col("stop")) - start
    left = seen.select(
        "doc_id", "h", "kind", at.alias("at"),
        F.when(cut, F.col("line.paragraph") + 1).otherwise(F.col("paragraph")).alias("paragraph"),
        start.alias("start"), length.alias("length"), n_words.alias("n_words"),
        "cluster_id", "keep_doc_id", "keep_paragraph").where("n_words > 0")
    here = Window.partitionBy("doc_id", "h").orderBy("at")
    before = F.lag(F.struct("kind", "keep_doc_id", (F.col("at") + F.col("n_words")).alias("till")))
    joined = ((F.col("kind") == 1) & (F.col("before.kind") == 1)
              & (F.col("before.till") == F.col("at"))
              & F.col("before.keep_doc_id").eqNullSafe(F.col("keep_doc_id")))
    first = [F.min_by(c, "at").alias(c) for c in (
        "paragraph", "cluster_id", "keep_doc_id", "keep_paragraph")]
    return (left.withColumn("before", before.over(here))
            .withColumn("stretch", F.sum(F.when(joined, 0).otherwise(1)).over(here))
            .groupBy("doc_id", "h", "stretch").agg(
                F.min("start").alias("start"),
                (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
                F.sum("n_words").alias("n_words"), *first)
            .select("doc_id", "paragraph", "start", "length", "n_words", "cluster_id",
                    "keep_doc_id", "keep_paragraph"))


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Paragraphs to remove; see the module's contract."""
    named = plain(docs).withColumn("h", F.xxhash64("text"))

    def spans(batches):
        for batch in batches:
            for part in in_slices(batch, 256):
                x = Lines(part.column("text").to_pylist(), min_words)
                row = pa.array(x.row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(row), part.column("h").take(row),
                     *[pa.array(c, pa.int64()) for c in (x.line, x.at, x.start, x.length,
                                                         x.n_words, x.n, x.node)]],
                    names=["doc_id", "h", "paragraph", "at", "start", "length", "n_words", "n",
                           "node"])

    def banded(batches):
        yield from deal_keys(pair for batch in batches for part in in_slices(batch, 256)
                             for pair in Lines(part.column("text").to_pylist(),
                                               min_words).banded())

    def contents(batches):
        for batch in batches:
            for part in in_slices(batch, 256):
                x = Lines(part.column("text").to_pylist(), min_words)
                want = pc.list_flatten(part.column("nodes")).to_numpy(zero_copy_only=False)
                node, first = np.unique(x.node, return_index=True)
                said = np.isin(node, want)
                if said.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[said]), pa.array(x.n[first[said]], pa.int64()),
                         packed([x.body(i) for i in first[said]])], names=["node", "n", "body"])

    lines = stage(named.mapInArrow(
        spans, "doc_id long, h long, paragraph long, at long, start long, length long, "
        "n_words long, n long, node long"), "paragraphs").df
    shared = shared_keys(named.select("text").mapInArrow(banded, KEYS))
    sizes = stage(lines.groupBy("node").agg(
        F.min(F.struct("doc_id", "h")).alias("of"), F.max("n").alias("n")), "sizes")
    members = in_windows(shared.df, sizes.df.select("node", "n"), NUM, DEN)
    speaker = stage(
        sizes.df.join(members.df.select("node").distinct(), "node", "left_semi")
        # bounded by the paragraphs of one document
        .groupBy("of").agg(F.collect_list("node").alias("nodes"))
        .select(id_key(F.col("of.doc_id")).alias("id"), "of.h", "nodes"), "speakers")
    # rows that repeat a document are one: the join's partitioning serves this too
    texts = (named.withColumn("id", id_key(F.col("doc_id")))
             .join(speaker.df.hint("merge"), ["id", "h"]).dropDuplicates(["id", "h"])
             .select("text", "nodes"))
    sets = stage(texts.mapInArrow(contents, "node long, n long, body binary")
                 .dropDuplicates(["node"]), "paragraph-texts")
    roots = linked(members.df, sets.df, WORDS, NUM, DEN)
    for done in (shared, sizes, members, speaker, sets):
        done.drop()
    rooted = stage(lines.join(roots, "node", "left")
                   .withColumn("cluster_id", F.coalesce("root", "node")).drop("root", "node", "n"),
                   "rooted-paragraphs").df
    keep = stage(rooted.groupBy("cluster_id").agg(
        F.min(F.struct("doc_id", "paragraph", "h")).alias("keep"), F.count("*").alias("n"))
        .where("n > 1").select("cluster_id", F.col("keep.doc_id").alias("keep_doc_id"),
                               F.col("keep.paragraph").alias("keep_paragraph"),
                               F.col("keep.h").alias("keep_h")), "kept").df
    removed = rooted.join(keep, "cluster_id").where(
        "not (doc_id <=> keep_doc_id and h = keep_h and paragraph = keep_paragraph)")
    return _apart(removed, repeated_passages(named, min_words))
