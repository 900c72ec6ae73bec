"""Near copies by the Jaccard similarity of word n-grams, with Bayesian pruning of candidate pairs.

Documents of the same words in the same order are one node. Nodes that agree in a band of MinHash values are tied to
the first node of that bucket; pairs are compared within the components of these ties, a block of nodes against another
at a time. A pair's MinHash values are compared a few at a time; it is given up as soon as the posterior probability of
reaching the threshold, given the matches so far and a uniform prior, falls below the tolerance. What is left is
verified on the whole sets. Only counts of links and a spanning forest of each block pair leave the task, never pairs.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.components import components
from cohortry.llm.scan import bound_batches, mix, slices, span_hashes, windows, words
from cohortry.session import settle

HASHES = 128
#: Values in a band. At a similarity of 0.8 a pair agrees in none of the 32 bands with probability 5e-8.
ROWS = 4
#: Values compared before each look at the posterior.
LOOK = 16
#: Nodes in a block; two blocks and their sets are in memory at once.
BLOCK = 2048
TILE = 256
#: Bits of the bitmap of candidates' ids (eight megabytes).
MARKS = 1 << 26

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_FACTORS = (_SEEDS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = _SEEDS.astype(np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each shingle, its text, the texts that have any, and a hash of each text's words in order.

    A shingle is ``size`` consecutive words; a text of fewer, but not none, is one shingle.
    """
    hashes, owner, _, _ = words(data, offsets)
    edges = np.searchsorted(owner, np.arange(len(offsets)))
    keys = span_hashes(hashes, edges[:-1], edges[1:])
    found, first = windows(hashes, owner, size)
    holders = owner[first]
    short = np.flatnonzero((np.diff(edges) > 0) & (np.diff(edges) < size))
    if len(short):
        found, holders = np.concatenate([found, keys[short]]), np.concatenate([holders, short])
        order = np.argsort(holders, kind="stable")
        found, holders = found[order], holders[order]
    return found, holders, np.flatnonzero(np.diff(edges)), keys


def minhashes(found: np.ndarray, holders: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """A row of ``HASHES`` values for each of ``texts``, all of which have a shingle."""
    if not len(texts):
        return np.zeros((0, HASHES), np.uint32)
    first = np.searchsorted(holders, texts)
    folded = (found >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(texts)), np.uint32)
    for i in range(HASHES):
        value = folded * _FACTORS[i] + _SHIFTS[i]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        out[i] = np.minimum.reduceat(value, first)
    return np.ascontiguousarray(out.T)


def _sketches(size: int, id_column: str, text: str):
    bands = HASHES // ROWS
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            names = batch.column(id_column).cast(pa.int64())
            for first, data, offsets in slices(batch, text):
                found, holders, texts, keys = shingles(data, offsets, size)
                values = minhashes(found, holders, texts).astype(np.uint64).reshape(len(texts), bands, ROWS)
                band = np.zeros((len(texts), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                for i in range(ROWS):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i])
                has = np.zeros(len(offsets) - 1, bool)
                has[texts] = True
                edges = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(band.ravel().view(np.int64)))
                own = [x.slice(first, len(has)) for x in (names, batch.column("at"))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(keys.view(np.int64), mask=~has), lists], schema=schema)

    return run


def _sets(size: int):
    columns = ["node", "copies", "label", "blocks"]

    def run(batches):
        for batch in batches:
            for first, data, offsets in slices(batch, "text"):
                found, holders, texts, keys = shingles(data, offsets, size)
                values = minhashes(found, holders, texts)
                edges = np.searchsorted(holders, np.arange(len(offsets)))
                sets = [np.unique(found[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                signature = [b""] * (len(offsets) - 1)
                for i, t in enumerate(texts.tolist()):
                    signature[t] = values[i].tobytes()
                kept = [batch.column(c).slice(first, len(sets)) for c in columns]
                made = pa.RecordBatch.from_arrays([*kept, pa.array(signature, pa.binary()), pa.array(sets, pa.binary())], names=[*columns, "signature", "shingles"])
                # A repeated id may stand for another text as well, and a hash may be an id.
                yield made.filter(pa.array(keys.view(np.int64) == made.column("node").to_numpy()))

    return run


def marked(rows: DataFrame, ids: DataFrame, among: bool = True) -> DataFrame:
    """``rows`` whose ``doc_id`` may be among ``ids`` (``id``), or the others: a bitmap of hashed ids, of fixed size,
    spares a join most texts.

    It lets through every id that is there and few others; as ids fill the bitmap it lets through more of them. A null
    ``doc_id`` is never among them.
    """
    bit = F.pmod(F.xxhash64(F.col("id")), F.lit(MARKS))
    parts = ids.select((bit + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    marks = np.zeros(MARKS // 8, np.uint8)
    # At most MARKS / 32,768 rows of 4,096 bytes; buckets and positions count from value 1.
    for bucket, bits in parts.collect():
        first = (bucket - 1) * 4096
        marks[first : first + len(bits)] = np.frombuffer(bits, np.uint8)[: len(marks) - first]

    def run(batches):
        for batch in batches:
            at = batch.column("_bit").to_numpy()
            found = (at >= 0) & (marks[at >> 3] >> (at & 7) & 1 == 1)
            yield batch.filter(pa.array(found == among)).drop_columns(["_bit"])

    hashed = rows.withColumn("_bit", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(MARKS))).cast("bigint"))
    return hashed.mapInArrow(run, rows.schema)


def without_ids(docs: DataFrame, ids: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """``docs`` without those whose ``doc_id`` is in ``ids`` (``id``), and with one row each of the ids in ``once``.

    Only documents that the bitmap of these ids marks are shuffled; all others pass as they are read.
    """
    bound_batches(docs)
    named = settle(ids.select("id").distinct(), "dropped")
    repeated = settle(once.select("id").distinct(), "repeated") if once is not None else named.where("false")
    touched = named.unionByName(repeated)
    maybe = marked(docs, touched).join(named.hint("merge"), F.col("doc_id") == F.col("id"), "left_anti")
    single = maybe.join(repeated.select(F.col("id").alias("_id")).hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    single = single.where("_id is null").drop("_id").unionByName(single.where("_id is not null").drop("_id").dropDuplicates(["doc_id"])) if once is not None else maybe
    return marked(docs, touched, among=False).unionByName(single)


def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of values compared, the fewest matches at which a pair is still pursued.

    With ``m`` matches of ``n`` and a uniform prior, the similarity has a Beta(m+1, n-m+1) posterior; the probability
    that it reaches ``threshold`` is that of at most ``m`` successes in ``n + 1`` trials of that probability.
    """
    out = {}
    for n in range(LOOK, HASHES + 1, LOOK):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out[n] = m
    return out


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


class Verifier:
    def __init__(self, threshold: float, tolerance: float) -> None:
        exact = Fraction(threshold).limit_denominator(10**6)
        self.up, self.down = exact.numerator, exact.denominator
        self.fewest = fewest_matches(threshold, tolerance)

    def pursued(self, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose MinHash values leave the threshold possible."""
        n, m = len(left), len(right)
        count = np.zeros((n, m), np.uint8)
        for k in range(LOOK):
            count += left[:, k, None] == right[None, :, k]
        alive = count >= self.fewest[LOOK]
        if same:
            alive &= np.arange(n)[:, None] < np.arange(m)[None, :]
        rows, columns = np.nonzero(alive)
        matched = count[rows, columns].astype(np.int64)
        for at in range(LOOK, HASHES, LOOK):
            if not len(rows):
                break
            matched += (left[rows, at : at + LOOK] == right[columns, at : at + LOOK]).sum(1)
            keep = matched >= self.fewest[at + LOOK]
            rows, columns, matched = rows[keep], columns[keep], matched[keep]
        return rows, columns

    def shared(self, left: list[np.ndarray], right: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Exact size of the intersection of each pair."""
        if len(rows) < 32:
            return np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in zip(rows.tolist(), columns.tolist(), strict=True)], np.int64)
        flat = [np.concatenate(x) for x in (left, right)]
        common = np.intersect1d(*flat)
        total = np.zeros((len(left), len(right)), np.float32)
        places = []
        for sets, values in zip((left, right), flat, strict=True):
            at = np.searchsorted(common, values)
            met = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == values) if len(common) else np.zeros(len(values), bool)
            places.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[met], at[met]))
        for first in range(0, len(common), 4096):
            parts = []
            for sets, (who, at) in zip((left, right), places, strict=True):
                inside = (at >= first) & (at < first + 4096)
                part = np.zeros((len(sets), min(4096, len(common) - first)), np.float32)
                part[who[inside], at[inside] - first] = 1
                parts.append(part)
            total += parts[0] @ parts[1].T
        return total[rows, columns].astype(np.int64)

    def links(self, signatures: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray):
        """Pairs (numbers of nodes) of ``left`` x ``right`` that reach the threshold; each pair once if they are the same."""
        same = left is right
        for a in range(0, len(left), TILE):
            for b in range(a if same else 0, len(right), TILE):
                i, j = left[a : a + TILE], right[b : b + TILE]
                rows, columns = self.pursued(signatures[i], signatures[j], same and a == b)
                if not len(rows):
                    continue
                chosen = [sets[k] for k in i], [sets[k] for k in j]
                both = self.shared(*chosen, rows, columns)
                sizes = [np.array([len(s) for s in x], np.int64) for x in chosen]
                either = sizes[0][rows] + sizes[1][columns] - both
                linked = both * self.down >= either * self.up
                yield i[rows[linked]], j[columns[linked]]


LINKS = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def _verify(threshold: float, tolerance: float):
    """Of one pair of blocks (or of several small components): links of each node, and rows that tie linked nodes."""

    def run(table: pa.Table) -> pa.Table:
        verifier = Verifier(threshold, tolerance)
        names, at = np.unique(table.column("node").to_numpy(), return_index=True)
        table = table.take(pa.array(at))
        copies, labels, blocks = (table.column(c).to_numpy() for c in ("copies", "label", "block"))
        signatures = np.stack([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("signature")])
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        links, forest = np.zeros(len(names), np.int64), _Forest(len(names))
        first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
        order = np.argsort(labels, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
            left = members[blocks[members] == first] if second >= 0 else members
            right = left if second < 0 or first == second else members[blocks[members] == second]
            for i, j in verifier.links(signatures, sets, left, right):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                # A tile's links as a forest: each row with its first partner, and each column with its first.
                for pairs in (np.unique(i, return_index=True)[1], np.unique(j, return_index=True)[1]):
                    for p in pairs.tolist():
                        forest.join(int(i[p]), int(j[p]))
                if len(i):
                    loose = np.array([forest.root(x) for x in i.tolist()]) != np.array([forest.root(x) for x in j.tolist()])
                    for p in np.flatnonzero(loose).tolist():
                        forest.join(int(i[p]), int(j[p]))
        counted = np.flatnonzero(links)
        tied = np.array(forest.edges, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays(
            [
                pa.array(np.concatenate([names[counted], names[tied[:, 0]]])),
                pa.array(np.concatenate([names[counted], names[tied[:, 1]]])),
                pa.array(np.concatenate([links[counted], np.zeros(len(tied), np.int64)])),
            ],
            schema=LINKS,
        )

    return run


def jaccard_join(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, tolerance: float = 1e-6, id_column: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """``doc_id class_id n_links n_copies`` for each row of ``docs``.

    Two documents are linked if their sets of word ``size``-grams have a Jaccard similarity of at least ``threshold``.
    ``class_id`` is the smallest id in the document's connected component, ``n_links`` the number of other documents
    linked to it, ``n_copies`` how many have the same words in the same order, itself included. A pair at the threshold
    is lost with a probability of about ``tolerance`` a look (eight looks at most); none is ever made up.

    Null and empty texts and texts without words are linked to nothing. A text of one to ``size - 1`` words is one
    shingle. Repeated rows and ids count as documents of their own, and so do rows without an id; a class of only such
    rows has no id. An empty table gives no row; other columns are ignored. Ids are integers; words are compared by
    64-bit hashes.
    """
    rows = bound_batches(docs).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # Rows without an id are found again by a hash of their text.
    rows = rows.withColumn("at", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    sketches = settle(rows.mapInArrow(_sketches(size, "doc_id", "text"), "doc_id bigint, at bigint, node bigint, bands array<bigint>"), "sketches")
    known = sketches.where("node is not null")
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("id"), F.min("at").alias("at"), F.count("*").alias("copies"))
    # A bucket holds the nodes that agree in a band; all are tied to the smallest.
    banded = known.groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.explode("bands").alias("band"))
    banded = settle(banded, "bands")
    buckets = banded.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("_last")).where("a < _last")
    ties = banded.join(buckets, "band").where("node <> a").select("a", F.col("node").alias("b"))
    grouped = components(ties)
    sizes = grouped.groupBy("label").agg(F.count("*").alias("members"))
    chosen = grouped.join(sizes, "label").join(nodes, "node").select("node", F.coalesce("id", "at").alias("id"), "copies", "label", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    chosen = settle(chosen, "candidates")
    wanted = marked(rows.select(F.coalesce("doc_id", "at").alias("doc_id"), "text"), chosen.select("id"))
    # One plan at every size: a table that is small now is shuffled as it will be.
    texts = wanted.join(chosen.hint("merge"), wanted.doc_id == chosen.id).select("node", "copies", "label", "blocks", "text")
    sets = texts.mapInArrow(_sets(size), "node bigint, copies bigint, label bigint, blocks int, signature binary, shingles binary")
    # Small components are verified together; a large one is dealt out as pairs of its blocks.
    bins = max(1, chosen.count() // block)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    paired = sets.withColumn("block", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    paired = paired.withColumn("bin", F.when(alone, F.pmod(F.xxhash64("label"), F.lit(bins))).otherwise(F.col("label")))
    paired = paired.withColumn("first", F.least("block", "_other")).withColumn("second", F.when(alone, F.lit(-1)).otherwise(F.greatest("block", "_other")))
    verify = _verify(threshold, tolerance)
    found = paired.select("bin", "first", "second", "node", "copies", "label", "block", "signature", "shingles").groupBy("bin", "first", "second").applyInArrow(verify, "node bigint, other bigint, links bigint")
    found = settle(found, "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    labelled = nodes.join(classes, "node", "left").join(counts, "node", "left").select("node", "id", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    smallest = labelled.groupBy("label").agg(F.min("id").alias("class_id"))
    result = settle(labelled.join(smallest, "label").select("node", "class_id", "copies", "links"), "classes")
    return sketches.select("doc_id", "node").join(result, "node", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )
