"""The Merkle manifest against a plain recursion over the same rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from itemwise.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, idx long, path string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return digest(*[field(v) for v in (row["doc_id"], row["source"], row["lang"],
                                       row["n_chars"], text)])


def tree(nodes):
    """Root of hex digests, and per leaf its (left, right) siblings by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i: i + 8]
            for k in range(len(run)):
                for o in owners[i + k]:
                    paths[o].append((run[:k], run[k + 1:]))
            up.append(digest(*run))
            held.append(sum(owners[i: i + 8], []))
        nodes, owners = up, held
    return (nodes[0] if nodes else None), paths


def expected(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    out, subroots, held = [], [], []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang),
                     key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        root, paths = tree([leaf(r, r["text"]) for r in own])
        subroots.append(root)
        held.append((own, paths))
    root, tops = tree(subroots)
    for subroot, (own, paths), top in zip(subroots, held, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            path = path + top
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(r, text)
            for left, right in path:
                now = digest(*left, now, *right)
            proof = digest(*[d for left, right in path for d in left + right])
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, proof, now, now == root))
    return out


def check(spark, rows):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = merkle.proofs(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    assert got.columns == list(COLUMNS)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


def row(i, lang, text="Some Text", source="s", n=9):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n, "idx": i,
            "path": "clash"}


def test_languages_of_many_depths(spark):
    """1, 7, 8, 9, 65 and 600 leaves; nulls, repeated ids and rows, odd texts."""
    rows = [row(5, "de"), *[row(i, "en") for i in range(7)], *[row(i, None) for i in range(8)],
            *[row(3 * i, "es") for i in range(9)], *[row(i, "fr", f"T{i}") for i in range(65)],
            *[row(i, "é", f"Ünï {i}" * (i % 4)) for i in range(600)],
            row(None, "fr"), row(None, "fr", None), row(7, "fr", "AGAIN"), row(7, "fr", "AGAIN"),
            row(8, "fr", None, None, None), row(9, "", "EMPTY lang"), row(10, "", "L" * 200_000)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[row(1, "en")], [row(0, "en"), row(0, "en")],
                                  [row(i, "en") for i in range(64)],
                                  [row(i, f"l{i}") for i in range(70)], []])
def test_small_trees(spark, rows):
    check(spark, rows)
