"""Token files: canonical length-limited Huffman codes of token ids.

A file is a folder of two Parquet tables. ``codebook`` holds the code length
of every id that occurs; canonical codes follow from lengths alone.
``blocks`` holds one row per block of whole documents: its place in the
stream of all ids (``start``), the documents' ids and token counts, the coded
bits, and the bit offset of every ``CHECKPOINT``-th token. A block needs only
the codebook to be decoded, and inside a block all checkpoints are decoded
side by side through one lookup table.

``write`` takes documents in ascending ``doc_id`` (null first; rows with the
same id by text). Null texts count as empty and an empty text is the end id
alone; an empty table gives empty tables. Other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.llm.common import Table, plain, shared_path
from itemwise.llm.tokens import ENCODED_ROWS, encoder, forget, in_slices

CHECKPOINT, BLOCK_TOKENS, MAX_BITS = 128, 1 << 19, 18

_IDS = "pid int, doc_id long, first long, n_tokens long, width int, ids binary, seen binary"
_BLOCK = ("start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
          "checkpoints binary, bits binary")


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most ``max_bits`` (package-merge) for positive
    ``counts``; one more bit than needed where the alphabet is too large."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, row = [], leaves
    leaf = np.ones(n, dtype=bool)
    levels.append(leaf)
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        row, leaf = both[at], at < n
        levels.append(leaf)
    sorted_lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for leaf in reversed(levels):
        m = int(leaf[:take].sum())
        sorted_lengths[:m] += 1
        take = 2 * (take - m)
    lengths = np.zeros(n, dtype=np.int64)
    lengths[order] = sorted_lengths
    return lengths


class Codebook:
    """Canonical codes: by length, then by id."""

    def __init__(self, ids, lengths):
        ids, lengths = np.asarray(ids, dtype=np.int64), np.asarray(lengths, dtype=np.int64)
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.bits = int(lengths.max()) if len(ids) else 1
        # a code of length l covers 2^(bits-l) entries of the table
        span = np.int64(1) << (self.bits - self.lengths)
        first = np.cumsum(span) - span
        self.codes = first >> (self.bits - self.lengths)
        size = int(ids.max()) + 1 if len(ids) else 0
        self.code_of = np.zeros(size, dtype=np.uint64)
        self.length_of = np.zeros(size, dtype=np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes, self.lengths
        self.symbol = np.zeros(1 << self.bits, dtype=np.uint32)
        self.step = np.ones(1 << self.bits, dtype=np.int64)
        filled = int(span.sum())
        self.symbol[:filled] = np.repeat(self.ids, span)
        self.step[:filled] = np.repeat(self.lengths, span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Bits, and the bit offsets of every CHECKPOINT-th id."""
        length = self.length_of[ids]
        at = np.cumsum(length) - length
        total = int(length.sum())
        # each code fills at most two 32-bit words; no two codes share a bit
        word, shift = at >> 5, at & 31
        value = self.code_of[ids] << (64 - shift - length).astype(np.uint64)
        words = total // 32 + 2
        high = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64),
                           minlength=words)
        low = np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64),
                          minlength=words)
        packed = (high + low).astype(np.uint64).astype(">u4").tobytes()
        return packed[: (total + 7) // 8], at[::CHECKPOINT].astype("<u8").tobytes()

    def decode(self, bits: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """All ids of a block, its checkpoints side by side."""
        at = np.frombuffer(checkpoints, dtype="<u8").astype(np.int64)
        lanes = len(at)
        out = np.zeros((CHECKPOINT, lanes), dtype=np.uint32)
        raw = np.frombuffer(bits + bytes(16 - len(bits) % 4), dtype=">u4").astype(np.uint64)
        window = (raw[:-1] << np.uint64(32)) | raw[1:]
        last = len(window) - 1
        mask, width = np.uint64((1 << self.bits) - 1), 64 - self.bits
        for k in range(CHECKPOINT):
            at_word = np.minimum(at >> 5, last)
            look = (window[at_word] >> (width - (at & 31)).astype(np.uint64)) & mask
            out[k] = self.symbol[look]
            at = at + self.step[look]
        return out.T.reshape(-1)[:n]


def _encode_sorted(docs: DataFrame, vocabulary: str, end_id: int) -> Table:
    """Ids of every document, range-partitioned and sorted by doc_id; ``first``
    counts the ids before it in its partition. The first row of a slice of
    rows carries how often each id stands in them (``seen``)."""

    def run(batches):
        enc = encoder(vocabulary)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        pid, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in in_slices(batch, ENCODED_ROWS):
                ids = [x + end for x in enc.encode(part.column("text").to_pylist())]
                n = np.array([len(x) // enc.width for x in ids], dtype=np.int64)
                before = first + np.cumsum(n) - n
                first += int(n.sum())
                seen = np.bincount(np.frombuffer(b"".join(ids), dtype=enc.dtype))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid] * len(ids), pa.int32()), part.column("doc_id"),
                     pa.array(before), pa.array(n), pa.array([enc.width] * len(ids), pa.int32()),
                     pa.array(ids, pa.binary()),
                     pa.array([seen.astype("<i8").tobytes(), *[None] * (len(ids) - 1)],
                              pa.binary())],
                    names=["pid", "doc_id", "first", "n_tokens", "width", "ids", "seen"])

    ordered = plain(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    path = shared_path(docs.sparkSession, "token-ids")
    ids = ordered.mapInArrow(run, _IDS)
    ids.write.option("compression", "zstd").parquet(path)
    return Table(docs.sparkSession.read.schema(ids.schema).parquet(path), path)


def _counts(ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur and their global counts; at most one row per vocabulary entry."""

    def run(batches):
        forget()
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for x in batch.column("seen").to_pylist():
                here = np.frombuffer(x, dtype="<i8").copy()
                if len(here) > len(total):
                    here, total = total, here
                total[: len(here)] += here
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    rows = (ids.select("seen").where("seen is not null").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas())
    return rows["id"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=np.int64)


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2,
          block_tokens: int = BLOCK_TOKENS, max_bits: int = MAX_BITS) -> None:
    """Write the ids of all documents into ``folder``.

    Texts are sorted once and encoded once; the driver sees one count per
    vocabulary entry and one total per partition."""
    spark = docs.sparkSession
    table = _encode_sorted(docs, vocabulary, end_id)
    used, counts = _counts(table.df)
    lengths = code_lengths(counts, max_bits)
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(used, lengths, strict=True)],
                          "id long, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    totals = {r.pid: r.n for r in table.df.groupBy("pid").agg(F.sum("n_tokens").alias("n"))
              .collect()}
    bases = dict(zip(sorted(totals), itertools.accumulate(
        [0, *[totals[p] for p in sorted(totals)]]), strict=False))

    def run(batches):
        forget()
        book = Codebook(used, lengths)
        held: list[tuple] = []

        def block():
            got = np.concatenate([np.frombuffer(x[3], dtype=f"<u{x[4]}") for x in held])
            bits, marks = book.encode(got.astype(np.int64))
            row = [[bases[held[0][0]] + held[0][2]], [len(got)], [[x[1] for x in held]],
                   [[x[5] for x in held]], [marks], [bits]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.binary()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                names=["start", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "bits"])

        size = 0
        for batch in batches:
            for part in in_slices(batch):
                cols = [part.column(c).to_pylist()
                        for c in ("pid", "doc_id", "first", "ids", "width", "n_tokens")]
                for row in zip(*cols, strict=True):
                    # a split may begin in another file: blocks hold neighbours only
                    if held and (held[-1][0] != row[0] or held[-1][2] + held[-1][5] != row[2]
                                 or size >= block_tokens):
                        yield block()
                        size = 0
                    held.append(row)
                    size += row[5]
        if held:
            yield block()

    (table.df.drop("seen").mapInArrow(run, _BLOCK)
     .write.option("compression", "none").parquet(f"{folder}/blocks"))
    table.drop()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before
    it), n_tokens, and ids as little-endian unsigned 32-bit integers."""
    book = spark.read.schema("id long, bits int").parquet(f"{folder}/codebook").collect()
    used, lengths = [r.id for r in book], [r.bits for r in book]

    def run(batches):
        forget()
        codes = Codebook(used, lengths)
        for batch in batches:
            for part in in_slices(batch, 1):
                row = part.to_pylist()[0]
                ids = codes.decode(row["bits"], row["checkpoints"], row["n_tokens"]).astype("<u4")
                n = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(n)
                offsets = np.concatenate([[0], ends * 4]).astype("<i4")
                out = pa.Array.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - n),
                     pa.array(n), out],
                    names=["doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def write_and_read(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Round trip through a fresh token file in the shared folder."""
    folder = shared_path(docs.sparkSession, "token-file")
    write(docs, folder, vocabulary, end_id)
    return read(docs.sparkSession, folder)


__all__ = ["Codebook", "code_lengths", "read", "write", "write_and_read"]
