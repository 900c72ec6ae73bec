"""Benchmark decontamination over a positional inverted index of the training text.

The index is a table of segments, each written by the task that read its documents: the sorted terms of about two
megabytes of whole documents, and for each term the places of its occurrences. Nothing is shuffled to build it. Test
windows are looked up in every segment, in blocks of bounded size: the postings of a window's rarest term are
intersected with those of its other terms, rarest first, each list moved by the term's offset. What is left is where
the phrase stands. For proximity the other terms have to stand near the rarest one, in any order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import bound_batches, slices, words
from cohortry.session import scratch_path, settle

SEGMENT = 2 << 20
#: Test windows that are looked up at once; with ten terms a window they take under ten megabytes in each task.
BLOCK = 50_000

INDEX = pa.schema(
    [("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_words", pa.list_(pa.int32())), ("terms", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())]
)
INDEX_DDL = "segment bigint, doc_ids array<bigint>, doc_words array<int>, terms binary, counts binary, places binary"
MATCH = pa.schema(
    [("segment", pa.int64()), ("row", pa.int32()), ("places", pa.list_(pa.int32())), ("items", pa.list_(pa.int64())), ("near_items", pa.list_(pa.int64()))]
)
MATCH_DDL = "segment bigint, row int, places array<int>, items array<bigint>, near_items array<bigint>"


def _segments(id_column: str, text: str):
    def run(batches):
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            names = batch.column(id_column).cast(pa.int64())
            for first, data, offsets in slices(batch, text, SEGMENT, SEGMENT):
                hashes, owner, _, _ = words(data, offsets)
                order = np.argsort(hashes, kind="stable")
                terms, counts = np.unique(hashes[order], return_counts=True)
                made = {
                    "segment": [segment],
                    "doc_ids": [names.slice(first, len(offsets) - 1).to_pylist()],
                    "doc_words": [np.bincount(owner, minlength=len(offsets) - 1).astype(np.int32)],
                    "terms": [terms.tobytes()],
                    "counts": [counts.astype(np.uint32).tobytes()],
                    "places": [order.astype(np.uint32).tobytes()],
                }
                yield pa.RecordBatch.from_pydict(made, schema=INDEX)
                segment += 1

    return run


def build_index(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, written to the shared folder and read back; one row a segment.

    Words are runs of ASCII letters, digits and characters beyond ASCII, capital ASCII letters taken as small ones. A
    null text has no words; every row of ``docs`` is in the index, repeated ones too.
    """
    path = scratch_path(docs.sparkSession, "postings")
    index = bound_batches(docs).select(id_column, text).mapInArrow(_segments(id_column, text), INDEX_DDL)
    index.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def test_windows(benchmark: DataFrame, size: int = 10, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows (arrays of term hashes) of all items and the items that hold each.

    A window is ``size`` consecutive words; an item of fewer, but not none, is one window.
    """

    def run(batches):
        for batch in batches:
            names = batch.column(id_column).to_pylist()
            for first, data, offsets in slices(batch, text):
                hashes, owner, _, _ = words(data, offsets)
                signed, edges = hashes.view(np.int64), np.searchsorted(owner, np.arange(len(offsets)))
                rows = [
                    (names[first + i], signed[a : min(a + size, edges[i + 1])].tolist())
                    for i in range(len(offsets) - 1)
                    for a in range(edges[i], max(edges[i + 1] - size + 1, min(edges[i] + 1, edges[i + 1])))
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["item_id", "window"])

    found = benchmark.select(id_column, text).mapInArrow(run, "item_id bigint, window array<bigint>")
    return found.where("item_id is not null").groupBy("window").agg(F.collect_set("item_id").alias("items"))


class Block:
    """Test windows as numbers of their terms, padded with -1."""

    def __init__(self, rows: list) -> None:
        self.items = [list(r["items"]) for r in rows]
        self.lengths = np.array([len(r["window"]) for r in rows], np.int64)
        flat = np.array([h for r in rows for h in r["window"]], np.int64).view(np.uint64)
        self.vocabulary, numbers = np.unique(flat, return_inverse=True)
        self.terms = np.full((len(rows), int(self.lengths.max(initial=0))), -1, np.int64)
        self.terms[np.arange(self.terms.shape[1]) < self.lengths[:, None]] = numbers


class Segment:
    def __init__(self, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, doc_words: np.ndarray) -> None:
        self.terms, self.counts, self.places = terms, counts.astype(np.int64), places.astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        #: Sorted, as terms are and places within a term are.
        self.keys = (np.repeat(np.arange(len(terms)), self.counts) << 32) + self.places
        self.edges = np.concatenate([[0], np.cumsum(doc_words)])

    def doc(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, places, "right") - 1

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        wanted = (terms << 32) + places
        return self.keys[np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)] == wanted

    def nearby(self, terms: np.ndarray, places: np.ndarray, docs: np.ndarray, reach: int) -> np.ndarray:
        """Whether the term stands in the same document at most ``reach`` words from the place."""
        after = np.searchsorted(self.keys, (terms << 32) + places)
        close = np.zeros(len(terms), bool)
        for at in (after - 1, after):
            key = self.keys[np.clip(at, 0, len(self.keys) - 1)]
            other = key & 0xFFFFFFFF
            close |= (key >> 32 == terms) & (abs(other - places) <= reach) & (self.doc(other) == docs)
        return close

    def candidates(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows all of whose terms occur here, their terms and offsets from the rarest on, and how many occur."""
        none = np.zeros(0, np.int64), np.zeros((0, 0), np.int64), np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
        if not len(self.terms) or not len(block.lengths):
            return none
        at = np.minimum(np.searchsorted(self.terms, block.vocabulary), len(self.terms) - 1)
        met = np.append(self.terms[at] == block.vocabulary, True)
        windows = np.flatnonzero(met[block.terms].all(axis=1))
        terms = np.append(at, -1)[block.terms[windows]]
        often = np.where(terms < 0, np.iinfo(np.int64).max, self.counts[terms])
        order = np.argsort(often, axis=1, kind="stable")
        return windows, np.take_along_axis(terms, order, 1), order, np.take_along_axis(often, order, 1)[:, :1].ravel()

    def matches(self, block: Block, reach: int) -> tuple[np.ndarray, ...]:
        """(window, first place) of phrases, (window, document) of windows that stand near together."""
        windows, terms, offsets, often = self.candidates(block)
        if not len(windows):
            return (np.zeros(0, np.int64),) * 4
        which = np.repeat(np.arange(len(windows)), often)
        within = np.arange(len(which)) - np.repeat(np.cumsum(often) - often, often)
        rare = self.places[self.first[terms[which, 0]] + within]
        start, near, found = rare - offsets[which, 0], np.arange(len(which)), np.arange(len(which))
        docs = self.doc(rare)
        found = found[start >= 0]
        for k in range(1, terms.shape[1]):
            used = terms[which[found], k] >= 0
            keep = ~used
            keep[used] = self.holds(terms[which[found[used]], k], start[found[used]] + offsets[which[found[used]], k])
            found = found[keep]
            if reach:
                used = terms[which[near], k] >= 0
                keep = ~used
                keep[used] = self.nearby(terms[which[near[used]], k], rare[near[used]], docs[near[used]], reach)
                near = near[keep]
        window, start = windows[which[found]], start[found]
        inside = self.doc(start) == self.doc(start + block.lengths[window] - 1)
        window, start = window[inside], start[inside]
        if not reach:
            near = near[:0]
        return window, start, windows[which[near]], docs[near]


def _search(block: Block, reach: int):
    def groups(docs: np.ndarray, windows: np.ndarray) -> dict[int, list[int]]:
        made: dict[int, set[int]] = {}
        for doc, window in np.unique(np.stack([docs, windows], 1), axis=0).tolist():
            made.setdefault(doc, set()).update(block.items[window])
        return {doc: sorted(items) for doc, items in made.items()}

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.uint32), np.frombuffer(row["places"], np.uint32), np.array(row["doc_words"], np.int64))
                window, start, near_window, near_doc = segment.matches(block, reach)
                if not len(window) and not len(near_window):
                    continue
                cover = np.zeros(int(segment.edges[-1]) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + block.lengths[window], -1)
                hit = np.flatnonzero(np.cumsum(cover)[:-1])
                owner = segment.doc(hit)
                items, near = groups(segment.doc(start), window), groups(near_doc, near_window)
                docs = sorted({*items, *near})
                edges = np.searchsorted(owner, [docs, [d + 1 for d in docs]])
                made = {
                    "segment": [row["segment"]] * len(docs),
                    "row": docs,
                    "places": [(hit[a:b] - segment.edges[d]).astype(np.int32) for d, a, b in zip(docs, *edges.tolist(), strict=True)],
                    "items": [items.get(d, []) for d in docs],
                    "near_items": [near.get(d, []) for d in docs],
                }
                yield pa.RecordBatch.from_pydict(made, schema=MATCH)

    return run


def find_matches(index: DataFrame, windows: DataFrame, reach: int = 0, block: int = BLOCK) -> DataFrame:
    """A row for each indexed document: ``doc_id n_words places items near_items``.

    ``places``: the words (from 0) inside any occurrence of a window. ``items``: the items with a window that occurs as
    a phrase. ``near_items``: those with a window whose terms all stand in the document within ``reach`` words of an
    occurrence of its rarest term (none are looked for if 0). Windows are passed to the tasks ``block`` at a time, so
    what is sent is bounded whatever the number of test items; each block searches the whole index.
    """
    windows = settle(windows, "windows")
    blocks = max(1, -(-windows.count() // block))
    numbered = windows.withColumn("_block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    base = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("row", "d"))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    parts = base.select("segment", "row", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"), empty("int").alias("places"), empty("bigint").alias("items"), empty("bigint").alias("near_items"))
    searched = index.select("segment", "doc_words", "terms", "counts", "places")
    for i in range(blocks):
        held = Block(numbered.where(F.col("_block") == i).collect())
        found = searched.mapInArrow(_search(held, reach), MATCH_DDL)
        parts = parts.unionByName(found.withColumn("doc_id", F.lit(None).cast("bigint")).withColumn("n_words", F.lit(None).cast("int")))

    def joined(name: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)

    return parts.groupBy("segment", "row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").cast("bigint").alias("n_words"), joined("places"), joined("items"), joined("near_items")
    ).drop("segment", "row")


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, reach: int = 0, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``find_matches`` of the windows of ``benchmark`` in ``docs``.

    Null and empty texts have no words and no matches; an item without words has no window; items without an id are left
    out; repeated documents give a row each and repeated items count once; empty tables on either side give no match;
    other columns are ignored, whatever their names. Ids are integers. Words and windows are compared by 64-bit hashes.
    """
    return find_matches(build_index(docs, id_column, text), test_windows(benchmark, size, item_column, item_text), reach)


def digest(matches: DataFrame) -> DataFrame:
    """The counted form of ``find_matches``: ``doc_id n_words n_hit n_items items_sha256 contaminated``."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return matches.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"),
    )
