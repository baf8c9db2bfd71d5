"""Sequence packing by first-fit decreasing over a tournament tree (operator 6)."""

from __future__ import annotations

import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each, let_go, tidy
from .tokens import encoder

LENGTH, END_ID, GROUP_DOCS = 4096, 2, 4096


class BinTree:
    """Capacities left in bins as leaves of a tree whose nodes hold the larger child."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves, self.best = capacity, 1, [capacity, capacity]

    def grow(self) -> None:
        old, n = self.best[self.leaves :], self.leaves
        self.leaves *= 2
        self.best = [0] * self.leaves + old + [self.capacity] * n
        for k in range(self.leaves - 1, 0, -1):
            self.best[k] = max(self.best[2 * k], self.best[2 * k + 1])

    def put(self, size: int) -> tuple[int, int]:
        """The first bin with room for size, and the offset there."""
        if self.best[1] < size:
            self.grow()
        best, k = self.best, 1
        while k < self.leaves:
            k = 2 * k if best[2 * k] >= size else 2 * k + 1
        offset, bin_ = self.capacity - best[k], k - self.leaves
        best[k] -= size
        while k > 1:
            k //= 2
            best[k] = max(best[2 * k], best[2 * k + 1])
        return bin_, offset


def pack(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size, by first-fit decreasing; equal sizes keep their order."""
    tree, out = BinTree(capacity), [(0, 0)] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        out[k] = tree.put(sizes[k])
    return out


def pieces(docs: DataFrame, tokenizer: str, groups: int, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of at most ``length``, with the random group it is packed in."""
    kind = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, _group int".format(docs.schema["doc_id"].dataType.simpleString())
    end = end_id.to_bytes(4, "little")

    @tidy
    def run(batches):
        by, row = encoder(tokenizer, False), 0
        for b in batches:
            index, start, size, crc, total, group = [], [], [], [], [], []
            for k, t in enumerate(each(b.column("text"))):
                data = by.packed(t or "") + end
                n = len(data) // 4
                row += 1
                seed = zlib.crc32(data)
                for s in range(0, n, length):
                    part = data[4 * s : 4 * (s + length)]
                    index.append(k)
                    start.append(s)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    group.append(zlib.crc32(b"%d %d" % (seed, row)) % groups)
            long = [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(index, pa.int64())), *long, pa.array(group, pa.int32())], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_group"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, group_docs: int = GROUP_DOCS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece.

    Documents go to random groups of about ``group_docs``, with all their pieces; each is packed alone, so a task holds a bounded
    number of small rows whatever the input, and at most one sequence a group stays unfilled beyond first-fit's own
    loss. Groups come from ids and row, so repeated rows and null ids spread too. Null and empty texts: one
    piece with the end id alone. No documents: no rows. Other columns are not read.
    """
    groups = max(1, -(-docs.count() // group_docs))
    rows = pieces(docs, tokenizer, groups, length, end_id)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_group") + ", sequence_id long, offset long"

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        let_go()
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        placed = pack(rows["length"].tolist(), length)
        rows["sequence_id"] = [(int(key[0]) << 32) + b for b, _ in placed]
        rows["offset"] = [o for _, o in placed]
        return rows.drop(columns="_group")

    return rows.groupBy("_group").applyInPandas(one, kind)
