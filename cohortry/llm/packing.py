"""Packing documents into windows of fixed size: full windows are cut off first, the rest is packed best fit decreasing."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.pretokens import code_point_offsets, encoder
from cohortry.llm.scan import bound_batches, slices

#: Documents packed together. More would save hardly any padding; a group of them takes a few megabytes.
GROUP = 100_000

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)
PIECE = "doc_id bigint, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def token_ids(enc, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts of a slice, and the offsets of each text in them."""
    string = data.tobytes().decode()
    starts, ends, found, owner = enc.split(string, code_point_offsets(data, offsets))
    distinct, at, inverse = np.unique(found, return_index=True, return_inverse=True)
    first, count = enc.lookup(distinct, string, starts[at], ends[at])
    first, count = first[inverse], count[inverse]
    edges = np.concatenate([[0], np.cumsum(count)])
    ids = enc.ids[np.arange(edges[-1]) + np.repeat(first - edges[:-1], count)]
    texts = np.bincount(owner, weights=count, minlength=len(offsets) - 1).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(texts)])


def _pieces(path: str, window: int, end_id: int, id_column: str, text: str):
    def run(batches):
        enc = encoder(path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            names = batch.column(id_column).to_pylist()
            for first, data, offsets in slices(batch, text):
                ids, edges = token_ids(enc, data, offsets)
                made = []
                for i in range(len(offsets) - 1):
                    own = np.append(ids[edges[i] : edges[i + 1]], np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(own), window):
                        piece = own[start : start + window]
                        made.append((names[first + i], row, start, len(piece), zlib.crc32(piece), len(own)))
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made, strict=True)], schema=PIECES)

    return run


class OpenWindows:
    """Open windows by remaining capacity. A segment tree over the capacities holds how many are open in each range."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, remaining: int, name: int) -> None:
        self.stacks[remaining].append(name)
        at = remaining + self.leaves
        while at:
            self.open[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The remaining capacity and name of the tightest open window with room for ``length``."""
        tree, at = self.open, length + self.leaves
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        remaining = at - self.leaves
        while at:
            tree[at] -= 1
            at >>= 1
        return remaining, self.stacks[remaining].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset for each length (1 to ``window``); longest first, ties in the given order."""
    windows, number, offset = OpenWindows(window), [0] * len(lengths), [0] * len(lengths)
    made = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = windows.take(lengths[i])
        if found is None:
            found, made = (window, made), made + 1
        remaining, number[i] = found
        offset[i] = window - remaining
        if remaining > lengths[i]:
            windows.put(remaining - lengths[i], number[i])
    return number, offset


def _place(window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("start", "ascending")])
        number, offset = best_fit_decreasing(table.column("length").to_pylist(), window)
        sequence = (key[0].as_py() << 32) + np.array(number, np.int64)
        kept = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_column: str = "doc_id", text: str = "text", group: int = GROUP
) -> DataFrame:
    """A row for each piece: ``doc_id start length ids_crc32 doc_tokens sequence_id offset``.

    A document is its ids and then ``end_id``. It is cut into full windows from its start; what is left is packed best
    fit decreasing within groups of about ``group`` documents, dealt by row number, so groups hold equally many however
    ids repeat. Only the places of pieces are shuffled, never ids. ``ids_crc32`` is that of the ids as little-endian
    unsigned 32-bit numbers.

    Null and empty texts are the end id alone; repeated rows are packed each; an empty table gives no row; other columns
    are ignored. A retried task gives the same rows as long as its input does. Integer ids.
    """
    groups = max(1, -(-docs.count() // group))
    pieces = bound_batches(docs).select(id_column, text).mapInArrow(_pieces(tokenizer, window, end_id, id_column, text), PIECE)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(lambda key, table: _place(window)(key, table.drop_columns(["_group"])), PLACED)
