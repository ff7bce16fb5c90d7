"""Word shingles as sorted sets of 64-bit hashes, and links between such sets."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import Table, stage
from itemwise.llm.graph import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Keys that a task holds before it deals them out, and shingles of one block.
HELD_KEYS, BLOCK_SHINGLES = 1 << 20, 1 << 17
#: Rounds of leads before what is still open is multiplied in blocks; any
#: number gives the same links.
ROUNDS = 3
#: Bits of a sketch and its columns; they only spare work, see ``sketch``.
SKETCH_BITS = 512
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: Cells of the counts that rule out pairs of long sets, whose sketches are
#: full; pairs of a block that are held against them one by one.
CELLS, HELD_PAIRS = 256, 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit out."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Distinct shingles of ``words`` lower-cased (A-Z) words, sorted; the
    whole sequence is one shingle when it is shorter, no word gives none."""
    found = text.translate(LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    n, digest = len(found), xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, found), dtype=np.uint64, count=n)
    k = min(words, n)
    out = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = out * _P + h[i: n - k + 1 + i]
    return np.unique(mix(out))


def name(shingles: np.ndarray) -> int:
    """64-bit name of a set, as a signed long."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def packed(texts: list[bytes]) -> pa.Array:
    """Texts as they travel: a set of 64-bit hashes does not compress and is
    larger than its text, so tasks rebuild sets from compressed texts."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return pa.array([squeeze(t) for t in texts], pa.binary())


def unpacked(body: bytes, words: int) -> np.ndarray:
    """The shingle set of a packed text."""
    return shingle_set(zstandard.ZstdDecompressor().decompress(body), words)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the set's members in SKETCH_BITS cells, as longs. Members
    that two sets share cancel out, so sketches differ in at most as many bits
    as the sets do in members."""
    odd = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).astype(np.int64),
                      minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def cells(shingles: np.ndarray) -> bytes:
    """Members of the set in each of CELLS cells, modulo 256."""
    at = (shingles >> np.uint64(16)) & np.uint64(CELLS - 1)
    return np.bincount(at.astype(np.int64), minlength=CELLS).astype(np.uint8).tobytes()


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least number of members in one set alone, from rows of ``cells``; each
    difference is taken the short way round 256."""
    d = x - y
    return np.minimum(d, np.uint8(0) - d).sum(axis=1, dtype=np.int64)


def near_enough(alone, a, b, num: int, den: int):
    """Whether sets of a and b members, ``alone`` of them or more in one set
    only, can link."""
    return alone * (den + num) <= (a + b) * (den - num)


def similar(shared, a, b, num: int, den: int):
    """Jaccard of at least num / den, in integers."""
    return den * shared >= num * (a + b - shared)


def deal_keys(pairs):
    """Rows (key, salt, node, many) from an iterator of (keys, node) of one task.

    What a task holds of one key is reduced before the shuffle: a key that
    several nodes share here sends one of them to the other tasks (salt 0,
    many), and the rest stay on a salt of this task. So a key has at most one
    row per task and flush at salt 0, however many nodes share it.
    """
    salt = TaskContext.get().partitionId() + 1
    held, size, flushed = [], 0, 0

    def deal():
        keys = np.concatenate([k for k, _ in held])
        nodes = np.repeat(np.array([x for _, x in held], dtype=np.int64),
                          [len(k) for k, _ in held])
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[fresh], nodes[fresh]
        head = np.ones(len(keys), dtype=bool)
        head[1:] = keys[1:] != keys[:-1]
        many = np.zeros(len(keys), dtype=bool)
        many[:-1] |= ~head[1:]
        many |= ~head
        salts = np.where(head, 0, salt + (flushed << 32)).astype(np.int64)
        for i in range(0, len(keys), 1 << 16):
            cut = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[cut].view(np.int64)), pa.array(salts[cut]), pa.array(nodes[cut]),
                 pa.array(many[cut])], names=["key", "salt", "node", "many"])

    for keys, node in pairs:
        if not len(keys):
            continue
        held.append((keys, node))
        size += len(keys)
        if size >= HELD_KEYS:
            yield from deal()
            held, size, flushed = [], 0, flushed + 1
    if held:
        yield from deal()


KEYS = "key long, salt long, node long, many boolean"


def shared_keys(dealt: DataFrame) -> Table:
    """key, node of every key that at least two nodes share, written once."""
    group = Window.partitionBy("key", "salt")
    kept = (dealt.withColumn("other", (F.min("node").over(group) != F.max("node").over(group))
                             | F.max("many").over(group))
            .where("other").select("key", "node").distinct())
    return stage(kept, "shared-keys")


def in_windows(shared: DataFrame, sizes: DataFrame, num: int, den: int) -> Table:
    """key, w, node: the keys cut by set size, those of one node left out.

    Sizes (node, n) are put on levels so wide that two sets which can link are
    at most one level apart. Window w of a key holds its nodes of levels w and
    w + 1; a pair that links meets in the window of its smaller set.
    """
    # a little wider than den / num, so that rounding cannot part a pair
    width = math.log(den / num * (1 + 1e-6))
    level = stage(shared.join(sizes, "node").select(
        "key", "node", F.floor(F.log("n") / width).alias("level")), "levels")
    both = level.df.withColumn("w", F.explode(F.array("level", F.col("level") - 1)))
    met = stage(both.groupBy("key", "w").agg(F.count("*").alias("many"),
                                             F.min("level").alias("low"))
                .where("many > 1 and low = w").select("key", "w"), "windows")
    found = stage(both.join(met.df, ["key", "w"]).select(
        F.xxhash64("key", "w").alias("key"), "w", "node"), "window-members")
    for done in (level, met):
        done.drop()
    return found


def could_link(pairs: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes, and sketches if ``sizes`` has them, allow the link.

    The overlap cannot pass the smaller set; and sets of a and b members link
    only where at most (a + b)(den - num) / (den + num) members are in one of
    them alone, which is no less than the bits that differ. No text is read.
    """
    drawn = [c for c in SKETCH if c in sizes.columns]
    one = sizes.select("node", F.col("n").alias("a"), *[F.col(c).alias(f"a_{c}") for c in drawn])
    two = sizes.select(F.col("node").alias("lead"), F.col("n").alias("b"),
                       *[F.col(c).alias(f"b_{c}") for c in drawn])
    near = F.lit(den) * F.least("a", "b") >= F.lit(num) * F.greatest("a", "b")
    if drawn:
        alone = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in drawn),
                    F.lit(0))
        near &= near_enough(alone, F.col("a"), F.col("b"), num, den)
    return pairs.join(one, "node").join(two, "lead").where(near).select("lead", "node")


def cells_allow(pairs: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that the counts of ``cells`` allow to link."""
    one = sizes.select("node", F.col("n").alias("a"), F.col("cells").alias("x"))
    two = sizes.select(F.col("node").alias("lead"), F.col("n").alias("b"),
                       F.col("cells").alias("y"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint8)
                        .reshape(-1, CELLS) for c in "xy")
                a, b = (part.column(c).to_numpy() for c in "ab")
                mask = pa.array(near_enough(apart(x, y), a, b, num, den))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(mask) for c in ("lead", "node")],
                    names=["lead", "node"])

    return pairs.join(one, "node").join(two, "lead").mapInArrow(run, "lead long, node long")


def live_rows(rows: pd.DataFrame, num: int, den: int) -> np.ndarray:
    """Mask of the rows of one block pair that may link with a row of another
    root there, by sizes, sketches and cells; never less than those that do."""
    n, side = rows["n"].to_numpy(), rows["side"].to_numpy()
    _, root = np.unique(rows["root"].to_numpy(), return_inverse=True)
    bits = np.unpackbits(np.ascontiguousarray(rows[SKETCH].to_numpy(dtype=np.int64))
                         .view(np.uint8), axis=1).astype(np.float32)
    held = bits.sum(axis=1)
    count = np.frombuffer(b"".join(rows["cells"]), dtype=np.uint8).reshape(-1, CELLS)
    live = np.zeros(len(rows), dtype=bool)
    two = side.max() > 0
    left = np.flatnonzero(side == 1) if two else np.arange(len(rows))
    right = np.flatnonzero(side == 0) if two else left
    for at in range(0, len(left), 256):
        x = left[at: at + 256]
        alone = held[x][:, None] + held[right] - 2 * (bits[x] @ bits[right].T)
        a, b = n[x][:, None], n[right]
        met = ((root[x][:, None] != root[right])
               & (den * np.minimum(a, b) >= num * np.maximum(a, b))
               & near_enough(alone, a, b, num, den))
        i, j = np.nonzero(met)
        i, j = x[i], right[j]
        if len(i) <= HELD_PAIRS:
            keep = np.ones(len(i), dtype=bool)
            for k in range(0, len(i), 4096):
                u, v = i[k: k + 4096], j[k: k + 4096]
                keep[k: k + 4096] = near_enough(apart(count[u], count[v]), n[u], n[v], num, den)
            i, j = i[keep], j[keep]
        live[i] = live[j] = True
    return live


def _verify(pairs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (lead, node) that link."""

    def run(batches):
        last, x = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keep = []
                for lead, a, b in zip(*[part.column(c).to_pylist()
                                        for c in ("lead", "left", "right")], strict=True):
                    if lead != last:  # the join leaves a lead's pairs together
                        last, x = lead, unpacked(a, words)
                    y = unpacked(b, words)
                    keep.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)),
                                             len(x), len(y), num, den)))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("lead").filter(mask), part.column("node").filter(mask)],
                    names=["lead", "node"])

    # texts grow with the corpus: the same shuffle at every size
    member = (sets.join(pairs.select("node").distinct(), "node", "left_semi")
              .select("node", F.col("body").alias("right")).hint("merge"))
    lead = (sets.select(F.col("node").alias("lead"), F.col("body").alias("left"))
            .join(pairs.select("lead").distinct(), "lead", "left_semi").hint("merge"))
    return pairs.join(member, "node").join(lead, "lead").mapInArrow(run, "lead long, node long")


def block_links(rows: pd.DataFrame, words: int, num: int, den: int) -> list[tuple[int, int]]:
    """Links between the components of one block pair, enough to join them.

    ``rows`` has side, node, root, body. The rows' incidence with shingles is
    multiplied row by row through the inverted index; a row is passed over
    once its component is the same as all it could meet.
    """
    nodes, side = rows["node"].to_numpy(), rows["side"].to_numpy()
    _, root = np.unique(rows["root"].to_numpy(), return_inverse=True)
    if len(rows) < 2 or root.max() == 0:
        return []
    sets = [unpacked(x, words) for x in rows["body"]]
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    owners = owner[order]
    counts = np.bincount(column)
    first = np.cumsum(counts) - counts
    two = side.max() > 0
    found = []
    # side 1 is the side of the rows outside the largest component
    for x in np.flatnonzero(side == 1) if two else range(len(sets)):
        other = root != root[x]
        if two:
            other &= side == 0
        if not other.any():
            continue
        mine = column[ends[x] - sizes[x]: ends[x]]
        n = counts[mine]
        at = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        overlap = np.bincount(owners[at], minlength=len(sets))
        links = np.flatnonzero(other & similar(overlap, sizes, sizes[x], num, den))
        for r in np.unique(root[links]):
            y = links[root[links] == r][0]
            found.append((int(nodes[x]), int(nodes[y])))
        if len(links):
            root[np.isin(root, np.unique(root[links]))] = root[x]
    return found


def _leaders(shared: DataFrame) -> tuple[Table, Table]:
    """(lead, node), every member of a key with the member of most keys, and
    the lead of every key."""
    degree = stage(shared.groupBy("node").agg(F.count("*").alias("degree")), "degrees")
    weighed = stage(shared.join(degree.df, "node"), "weighed-keys")
    lead = stage(weighed.df.groupBy("key").agg(
        F.max(F.struct("degree", "node")).alias("top")).select(
        "key", F.col("top.node").alias("lead")), "leads")
    pairs = stage(shared.join(lead.df, "key").where("node <> lead").select("lead", "node")
                  .distinct(), "candidate-pairs")
    for done in (degree, weighed):
        done.drop()
    return pairs, lead


def _blocks(open_: DataFrame, sets: DataFrame, carried: list[str]) -> DataFrame:
    """Rows of block pairs of every bundle in ``open_`` (node, root, bundle), with
    the columns ``carried`` of ``sets``."""
    sized = stage(open_.join(sets.select("node", "n"), "node"), "bundles").df
    largest = (sized.groupBy("bundle", "root").agg(F.count("*").alias("n")).groupBy("bundle")
               .agg(F.max(F.struct("n", "root")).alias("top"))
               .select("bundle", F.col("top.root").alias("main")))
    kinds = stage(sized.join(stage(largest, "largest").df, "bundle")
                  .withColumn("rest", F.col("root") != F.col("main")), "kinds").df

    def blocks(of):
        held = F.sum(F.when(of, F.col("n")).otherwise(0))
        return F.greatest(F.lit(1), F.ceil(held / BLOCK_SHINGLES))

    count = stage(kinds.groupBy("bundle").agg(blocks(~F.col("rest")).alias("mains"),
                                              blocks(F.col("rest")).alias("rests")),
                  "block-counts").df
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("rests"))
                 .otherwise(F.col("mains")))
    placed = kinds.join(count, "bundle").withColumn("own", own)
    base = ["bundle", "node", "root"]

    def series(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    main = (placed.where(~F.col("rest")).withColumn("j", series("rests"))
            .select(*base, F.lit("main").alias("kind"), F.col("own").alias("i"), "j",
                    F.lit(0).alias("side")))
    met = (placed.where("rest").withColumn("i", series("mains"))
           .select(*base, F.lit("main").alias("kind"), "i", F.col("own").alias("j"),
                   F.lit(1).alias("side")))
    rest = (placed.where("rest").withColumn("t", series("rests"))
            .select(*base, F.lit("rest").alias("kind"), F.least("own", "t").alias("i"),
                    F.greatest("own", "t").alias("j"),
                    (F.col("own") > F.col("t")).cast("int").alias("side")))
    of = sets.join(open_.select("node").distinct(), "node", "left_semi")
    return main.unionByName(met).unionByName(rest).join(
        of.select("node", *carried).hint("merge"), "node")


def _may_meet(open_: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``open_`` that may link inside their bundle; blocks of
    sketches are multiplied, so no text is read for the others."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.loc[live_rows(pdf, num, den), ["bundle", "node"]]

    placed = stage(open_, "placed").df
    live = stage(_blocks(placed, sizes, ["n", "cells", *SKETCH]).groupBy(
        "bundle", "kind", "i", "j").applyInPandas(run, "bundle long, node long").distinct(),
        "live").df
    return stage(placed.join(live, ["bundle", "node"], "left_semi"), "live-nodes").df


def _new_pairs(pairs: DataFrame, roots: DataFrame, checked: DataFrame) -> DataFrame:
    """Pairs of unlike roots that no round before has verified."""
    a = roots.select("node", F.col("root").alias("a"))
    b = roots.select(F.col("node").alias("lead"), F.col("root").alias("b"))
    return (pairs.join(a, "node", "left").join(b, "lead", "left")
            .where(F.coalesce("a", "node") != F.coalesce("b", "lead")).select("lead", "node")
            .join(checked, ["lead", "node"], "left_anti"))


def _still_open(members: DataFrame, leads: DataFrame, roots: DataFrame) -> Table:
    """key, w, node, root of the keys whose members but the lead, which has
    met them all, are not connected yet."""
    rooted = stage(members.select("key", "w", "node").join(leads, "key").where("node <> lead")
                   .join(roots, "node", "left")
                   .select("key", "w", "node", F.coalesce("root", "node").alias("root")),
                   "rooted-members")
    apart = stage(rooted.df.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
                  .where("a <> b").select("key"), "open-keys")
    found = stage(rooted.df.join(apart.df, "key"), "open-members")
    for done in (rooted, apart):
        done.drop()
    return found


def linked(members: DataFrame, sets: DataFrame, words: int, num: int, den: int,
           sizes: DataFrame | None = None) -> DataFrame:
    """node and root of every node that has a link of Jaccard num / den or more.

    ``members`` (key, w, node; from ``in_windows``) must hold a common key for
    every pair that links; ``sets`` holds the packed text (``body``) and set
    size (``n``) of its nodes. ``sizes`` (node, n, cells and the columns
    ``SKETCH``), if given, rules pairs out before a text is read. No row per pair of a key is made: in rounds,
    the members of a key are verified against its lead, which then leaves the
    key, and keys with all members connected close. Keys still open after
    ``ROUNDS`` are bundled by their windows, and inside a bundle all rows
    outside the largest component are multiplied with all others, block by
    block. Two nodes that link and are not connected by a round share an open
    key, so nothing is lost.
    """
    roots = checked = None
    for _ in range(ROUNDS):
        pairs, leads = _leaders(members)
        close = could_link(pairs.df, sets if sizes is None else sizes, num, den)
        if roots is not None:
            close = _new_pairs(close, roots, checked)
        if sizes is not None:
            drawn = stage(close, "drawn-pairs")
            close = cells_allow(drawn.df, sizes, num, den)
        close = stage(close, "close-pairs")
        if sizes is not None:
            drawn.drop()
        links = stage(_verify(close.df, sets, words, num, den), "links")
        edges = links.df.select("node", F.col("lead").alias("root"))
        if roots is not None:
            edges = edges.unionByName(roots.select("node", "root"))
        roots = stage(components(edges), "components").df
        checked = close.df if checked is None else checked.unionByName(close.df)
        members = _still_open(members, leads.df, roots).df
        for done in (pairs, leads, links):
            done.drop()
        if not members.head(1):
            return roots
    first = roots
    placed = members.withColumn("u", F.xxhash64("node", "w"))
    low = stage(placed.groupBy("key").agg(F.min("u").alias("low")), "lowest").df
    bundles = stage(components(placed.join(low, "key").select("u", "low")), "bundle-roots").df
    open_ = (stage(placed.select("node", "root", "u").distinct(), "open-nodes").df
             .join(bundles.select(F.col("node").alias("u"), F.col("root").alias("bundle")), "u")
             .select("node", "root", "bundle"))
    if sizes is not None:
        open_ = _may_meet(open_, sizes, num, den)
    rows = _blocks(open_, sets, ["body"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(pdf, words, num, den), columns=["a", "b"]).astype("int64")

    more = stage(rows.groupBy("bundle", "kind", "i", "j").applyInPandas(run, "a long, b long"),
                 "block-links").df
    if not more.head(1):
        return first
    edges = first.select("node", "root").unionByName(more.select(
        F.col("a").alias("node"), F.col("b").alias("root")))
    return stage(components(edges), "components").df


__all__ = ["KEYS", "SKETCH", "block_links", "cells", "cells_allow", "could_link", "deal_keys", "in_windows", "linked", "live_rows",
           "mix",           "name", "packed", "shared_keys", "shingle_set", "similar", "sketch", "unpacked"]
