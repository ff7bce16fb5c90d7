"""A Merkle manifest of documents, with proofs by pointer jumping.

Every row is a leaf. Per language the leaves ascend by ``doc_id``, and runs
of ``FAN`` neighbours become one node until one remains, the subroot; the
subroots in the order of their languages give the root in the same way.

A node's place in its tree is arithmetic, so a level is one aggregation by
place. Proofs come from pointer jumping: each inner node holds the segment of
siblings on the way to an ancestor (at first its parent) and that ancestor's
place. A round joins the nodes with themselves at the ancestor, concatenates
the segments and takes over the ancestor's ancestor, so distances double and
all nodes reach the root in about log2(depth) rounds. Leaves are eight times
as many as inner nodes and jump last, once: their own siblings, then all that
their parent has gathered.

Where many nodes share an ancestor, ancestors are few: after a distance d only
nodes above level d can be asked, fewer than n / FAN^d of them, and Spark
broadcasts that side by its measured size or splits the join. Leaves are
ranked in ranges of all languages together, so one language may hold any
share of the rows.

Contract: ``documents`` rows with doc_id, source, lang, n_chars and text; any
of them may be null. A null language is a language of its own and the first;
a null ``doc_id`` sorts first and is never tampered with. Repeated ids are
ordered by their leaf, and rows equal in all five columns are equal leaves,
whatever their order. An empty table returns no rows. Other columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import A_Z, LOWER_A_Z, ranked, same, stage

FAN, DIGEST = 8, 32
#: The tree of subroots; trees of languages are numbered from 0.
TOP = -1
_PATH = "array<struct<l:binary,r:binary>>"


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    """Digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(_field(F.col("doc_id")), _field(F.col("source")),
                                   _field(F.col("lang")), _field(F.col("n_chars")),
                                   _field(text)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(digests: Column) -> Column:
    """Digest of concatenated digests, which count as hex text."""
    return F.unhex(F.sha2(hex_text(digests), 256))


def _run(nodes: DataFrame) -> DataFrame:
    """One level up: tree, idx, n (nodes of the tree on that level), run (the
    children's digests) and h, for trees that still have several nodes."""
    children = F.array_sort(F.collect_list(F.struct("idx", "h")))
    run = F.aggregate(children, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["h"]))
    return (nodes.where("n > 1")
            .groupBy("tree", F.expr(f"idx div {FAN}").alias("parent"), "n")
            .agg(run.alias("run"))
            .select("tree", F.col("parent").alias("idx"),
                    F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "run",
                    _node(F.col("run")).alias("h")))


def _levels(leaves: DataFrame, widest: int) -> list[DataFrame]:
    """Inner levels above ``leaves`` (tree, idx, n, h), each written once."""
    out, below, level = [], leaves, 0
    while widest > 1:
        level, widest = level + 1, math.ceil(widest / FAN)
        below = stage(_run(below).withColumn("level", F.lit(level)), "merkle-level").df
        out.append(below)
    return out


def _up(tree: Column, level: Column, idx: Column, n: Column, trees: int) -> list[Column]:
    """Tree, level and idx of a node's parent (a subroot's parent stands in the
    tree of subroots; null at the root), and the node's slot in its run."""
    top = F.lit(trees > 1) & (tree != TOP) & (n == 1)
    inner = n > 1
    place = F.when(top, tree).when(inner, idx)
    return [F.when(top, TOP).when(inner, tree).cast("long").alias("a_tree"),
            F.when(top, 1).when(inner, level + 1).cast("int").alias("a_level"),
            F.floor(place / FAN).cast("long").alias("a_idx"), (place % FAN).alias("slot")]


def _siblings(run: Column, slot: Column) -> Column:
    """The one-level segment of the node at ``slot`` of its parent's run."""
    at = (slot * DIGEST).cast("int")
    return F.array(F.struct(F.substring(run, F.lit(1), at).alias("l"),
                            F.substring(run, at + DIGEST + 1, F.length(run)).alias("r")))


def _at(left: str, right: str) -> Column:
    return ((F.col(f"{left}.a_tree") == F.col(f"{right}.tree"))
            & (F.col(f"{left}.a_level") == F.col(f"{right}.level"))
            & (F.col(f"{left}.a_idx") == F.col(f"{right}.idx")))


def _jumped(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """Every inner node with ``path`` (all segments to the root) and ``sub``
    (its tree's root): pointer jumping."""
    up = nodes.select("tree", "level", "idx", "run", "h",
                      *_up(F.col("tree"), F.col("level"), F.col("idx"), F.col("n"), trees))
    own = F.col("l.a_tree") == F.col("l.tree")
    now = stage(up.alias("l").join(nodes.alias("r"), _at("l", "r"), "left").select(
        "l.tree", "l.level", "l.idx", "l.run", "l.a_tree", "l.a_level", "l.a_idx",
        F.when(own, F.col("r.h")).otherwise(F.col("l.h")).alias("sub"),
        F.when(F.col("r.run").isNull(), F.array().cast(_PATH))
        .otherwise(_siblings(F.col("r.run"), F.col("l.slot"))).alias("path")), "merkle-jump").df
    distance = 1
    while distance < depth:
        asked = now.where((F.col("level") > distance) | (F.col("tree") == TOP)).select(
            "tree", "level", "idx", "a_tree", "a_level", "a_idx", "sub", "path")
        now = stage(now.alias("l").join(asked.alias("r"), _at("l", "r"), "left").select(
            "l.tree", "l.level", "l.idx", "l.run", "r.a_tree", "r.a_level", "r.a_idx",
            F.when(own, F.col("r.sub")).otherwise(F.col("l.sub")).alias("sub"),
            F.concat("l.path", F.coalesce("r.path", F.array().cast(_PATH))).alias("path")),
            "merkle-jump").df
        distance *= 2
    return now


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root and ``path`` (its proof: per level the
    digests left and right of it, as bytes), and ``claimed``, the leaf of the
    row with its text A-Z lower-cased where ``tampered`` (of doc_id) holds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[F.col(c).cast(t).alias(c) for c, t in
                         (("source", "string"), ("lang", "string"), ("n_chars", "long"),
                          ("text", "string"))])
    lowered = F.translate("text", A_Z, LOWER_A_Z)
    written = stage(rows.select(
        "doc_id", "lang", _leaf(F.col("text")).alias("h"),
        F.when(tampered, _leaf(lowered)).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed = ranked(written.df, ["lang"], ["doc_id", "h", "row"], "idx").df
    langs = stage(placed.groupBy("lang").agg(F.count("*").alias("n")), "merkle-langs")
    trees = ranked(langs.df, [], ["lang"], "tree").df
    found = trees.agg(F.count("*").alias("trees"), F.max("n").alias("widest")).first()
    count, widest = found.trees, found.widest or 0
    leaves = stage(placed.alias("l").join(trees.alias("r"), same(placed, trees, ["lang"])).select(
        "l.doc_id", "l.h", "l.changed", "r.tree", "l.idx", "r.n"), "merkle-placed").df
    written.drop()
    inner = _levels(leaves.select("tree", "idx", "n", "h"), widest)
    subroots = leaves.where("n = 1").select("tree", "h")
    for level in inner:
        subroots = subroots.unionByName(level.where("n = 1").select("tree", "h"))
    top_leaves = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                 F.lit(count).cast("long").alias("n"), "h")
    top = _levels(top_leaves, count)
    ends = top[-1] if top else top_leaves
    root = (ends.first() or {"h": None})["h"]
    nodes = leaves.sparkSession.createDataFrame(
        [], "tree long, idx long, n long, run binary, h binary, level int")
    for level in [*inner, *top]:
        nodes = nodes.unionByName(level)
    jumped = _jumped(nodes, count, len(inner) + len(top))
    low = leaves.select("doc_id", "h", "changed", "tree",
                        *_up(F.col("tree"), F.lit(0), F.col("idx"), F.col("n"), count))
    joined = low.alias("l").join(jumped.alias("r"), _at("l", "r"), "left")
    return joined.select(
        "l.doc_id", F.col("l.h").alias("leaf"),
        F.coalesce(F.when(F.col("l.a_tree") == F.col("l.tree"), F.col("r.sub")),
                   F.col("l.h")).alias("subroot"),
        F.lit(root).cast("binary").alias("root"),
        F.when(F.col("r.run").isNull(), F.array().cast(_PATH)).otherwise(
            F.concat(_siblings(F.col("r.run"), F.col("l.slot")), F.col("r.path"))).alias("path"),
        F.coalesce("l.changed", "l.h").alias("claimed"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(path, leaf, lambda h, s: _node(F.concat(s["l"], h, s["r"])))


def proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the
    tampered leaf, if any) and verified, digests as hex text."""
    rows = manifest(docs, tampered)
    siblings = F.array_join(F.transform("path", lambda s: hex_text(F.concat(s["l"], s["r"]))), "")
    folded = rows.select("*", fold(F.col("claimed"), F.col("path")).alias("folded"))
    return folded.select(
        "doc_id", *[hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(siblings, 256).alias("proof_sha256"), hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))
