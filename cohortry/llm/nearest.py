"""Nearest neighbours by inner product over multi-index hashing of learned binary codes.

Vectors are given one more component so that all have the same length; the order of inner products is then that of
angles. Rotations learned on a bounded sample (iterative quantisation) turn a vector into bits, and the bits are cut
into substrings. A shard of the index has a table of its substrings' values for each position. By the pigeonhole
principle a code within ``radius`` bits of the query's is within ``radius // substrings`` bits of it in at least one
substring; those values are probed, the codes found are compared whole, and what is within the radius is ranked by exact
inner products. The radius is learned on the sample. Every row is indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.session import settle

BITS = 256
SUBSTRING = 16
SAMPLE = 8192
SHARD = 16_384
QUERY_BLOCK = 1024
TILE = 128


def usable(vector: str) -> Column:
    """Not null, not empty, all components finite and one of them not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


@dataclass
class Codes:
    """Means and rotations of the extended vectors, the common length, and the search radius."""

    centre: np.ndarray
    rotation: np.ndarray
    length: float
    radius: int
    #: Coding multiplies vectors by this power of two, so that no square of a component leaves the range of a double.
    scale: float = 1.0

    def extended(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        vectors = vectors * self.scale
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.length**2 - (vectors**2).sum(axis=1), 0))
        if query:
            vectors = vectors * (self.length / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300))
        return np.hstack([vectors, rest[:, None]])

    def encode(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Substrings (16-bit numbers) of each vector's code."""
        bits = (self.extended(vectors, query) - self.centre) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which each code of ``left`` differs from each of ``right``."""
    a, b = left.view(np.uint64), right.view(np.uint64)
    total = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        total += np.bitwise_count(a[:, i, None] ^ b[None, :, i])
    return total


def learn(sample: np.ndarray, length: float, k: int, recall: float, rounds: int = 20, scale: float = 1.0) -> Codes:
    """Rotations by iterative quantisation from several starts, and the radius that holds ``recall`` of the true ``k``
    nearest within the sample. In more rows than the sample's the k nearest are nearer, so the radius errs on the safe side."""
    codes = Codes(np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, BITS)), length, 0, scale)
    extended = codes.extended(sample, False)
    centre = extended.mean(axis=0)
    centred = extended - centre
    dims = centred.shape[1]
    rng, parts = np.random.default_rng(11), []
    while sum(p.shape[1] for p in parts) < BITS:
        rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(centred @ rotation).T @ centred, full_matrices=False)
            rotation = (left @ right).T
        parts.append(rotation)
    codes = Codes(centre, np.hstack(parts)[:, :BITS], length, 0, scale)
    asked = sample[:: max(1, len(sample) // 256)][:256]
    near = (asked * scale) @ (sample * scale).T
    count = min(k + 1, len(sample))
    best = np.argpartition(-near, count - 1, axis=1)[:, :count]
    apart = np.take_along_axis(distances(codes.encode(asked, True), codes.encode(sample)), best, 1)
    codes.radius = int(np.quantile(apart, recall, method="higher"))
    return codes


class Shard:
    """Rows of the index: a table of substring values for each position, whole codes and vectors."""

    def __init__(self, codes: Codes, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.codes, self.ids, self.vectors = codes, ids, vectors
        self.code = codes.encode(vectors)
        self.tables = [np.unique(self.code[:, s], return_inverse=True) for s in range(self.code.shape[1])]

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, bits apart) of every code within ``radius`` of the queries' codes."""
        parts = asked.shape[1]
        found = np.zeros((len(asked), len(self.ids)), bool)
        for s, (values, rows) in enumerate(self.tables):
            # Substrings share the radius: the first radius % parts + 1 may differ in one bit more than the others.
            reach = radius // parts - (s > radius % parts)
            if reach >= 0:
                probed = np.bitwise_count(asked[:, s, None] ^ values[None, :]) <= reach
                found |= probed[:, rows]
        query, row = np.nonzero(found)
        apart = np.zeros(len(query), np.int64)
        a, b = asked.view(np.uint64), self.code.view(np.uint64)
        for i in range(a.shape[1]):
            apart += np.bitwise_count(a[query, i] ^ b[row, i])
        near = apart <= radius
        return query[near], row[near], apart[near]

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, row id, score) of the ``k`` best found of each query; a query's own id takes no part."""
        asked = self.codes.encode(vectors, True)
        out = []
        for a in range(0, len(ids), TILE):
            left, radius = np.arange(a, min(a + TILE, len(ids))), self.codes.radius
            while len(left):
                query, row, _ = self.within(asked[left], radius)
                other = self.ids[row] != ids[left[query]]
                query, row = query[other], row[other]
                # Too few within the radius: it is widened for these queries until there are enough or all rows are in.
                enough = (np.bincount(query, minlength=len(left)) >= k) | (radius >= BITS)
                keep = enough[query]
                query, row = query[keep], row[keep]
                score = np.empty(len(query))
                for b in range(0, len(query), 65_536):
                    own = slice(b, b + 65_536)
                    score[own] = (vectors[left[query[own]]] * self.vectors[row[own]]).sum(axis=1)
                order = np.lexsort((self.ids[row], -score, query))
                query, row, score = query[order], row[order], score[order]
                place = np.arange(len(query)) - np.searchsorted(query, query)
                best = place < k
                out.append((ids[left[query[best]]], self.ids[row[best]], score[best]))
                left, radius = left[~enough], min(BITS, radius + max(8, radius // 4))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    flat = table.column("vector").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return ids, flat.flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.98, id_column: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, shard: int = SHARD
) -> DataFrame:
    """``query_id rank vec_id score``: the ``k`` rows of ``vectors`` with the largest inner product found for each query.

    ``score`` is the exact inner product in double precision, ties go to the smaller id, ``rank`` starts at 1, and a
    row with the query's own id takes no part. Rotations and radius are learned from at most ``sample`` rows (those of
    the smallest hash); every row is indexed, in shards of about ``shard`` rows, and a block of queries meets each shard
    once. If fewer than ``k`` codes of a shard are within the radius it is widened, so a query gets ``k`` rows whenever
    there are so many.

    Vectors that are null or zero, hold a null or a component that is not finite, or have another dimension than most
    take no part on either side; nor do null ids. Repeated ids in ``vectors`` are rows of their own; in ``queries`` they
    are one query. Empty tables give no row; other columns are ignored.
    """
    spark = vectors.sparkSession

    def cleaned(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return rows.where(F.col("id").isNotNull() & usable("vector"))

    base, asked = cleaned(vectors), cleaned(queries)
    facts = base.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("largest")).orderBy(F.desc("n"), "dims").first()
    if facts is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    base, asked = (df.where(F.size("vector") == facts["dims"]) for df in (base, asked))
    asked = settle(asked.groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    taken = base.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(sample).toPandas()
    scale = 2.0 ** -np.clip(np.frexp(facts["largest"])[1], -1000, 1000)
    # No vector is longer than this; the common length only has to be as large.
    scaled = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x * float(scale)) * (x * float(scale)))
    length = float(np.sqrt(base.agg(F.max(scaled)).first()[0]))
    codes = learn(np.stack(taken["vector"].to_numpy()).astype(np.float64), length, k, recall, scale=float(scale))
    shards, blocks = max(1, -(-facts["n"] // shard)), max(1, -(-asked.count() // QUERY_BLOCK))
    # Rows are dealt by a hash of their id and vector, so rows of one id spread too.
    left = base.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return FOUND.empty_table()
        query, row, score = Shard(codes, *_vectors(rows)).search(*_vectors(wanted), k)
        return pa.Table.from_arrays([pa.array(query), pa.array(row), pa.array(score)], schema=FOUND)

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
