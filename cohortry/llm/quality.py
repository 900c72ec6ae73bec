"""Text quality by nearest neighbours: labelled documents vote in a latent-semantic space.

A document is a vector of hashed terms of three families: trigrams of character classes (how the text looks), words,
and repetition. Within a family a term weighs the square root of its share. The latent space is the singular value
decomposition of the labelled reference documents; their vectors are passed to every task, every document's cosine with
each of them is computed in blocks, and the labels of the nearest are averaged by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import DENSE_ROWS, bound_batches, kept_columns, kept_types, slices, with_kept, words

SLICE = 1 << 19
SHAPES, WORDS, REPEATS = 4096, 2048, 4
TERMS = SHAPES + WORDS + REPEATS

_CLASS = np.full(256, 14, np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 1
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 2, 3, 4, 15
for _i, _group in enumerate((".;:", ",", "|", "!?", "%", "&", "$", "*", "#")):
    _CLASS[list(_group.encode())] = 5 + _i


def term_shares(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and weight of each term that a text has, sorted by text and term."""
    n = len(offsets) - 1
    table = np.zeros((n, TERMS), np.float32)
    if len(data) >= 3:
        owner = np.repeat(np.arange(n), np.diff(offsets))
        kind = _CLASS[data].astype(np.int64)
        code = (kind[:-2] << 8) + (kind[1:-1] << 4) + kind[2:]
        inner = owner[:-2] == owner[2:]
        table[:, :SHAPES] = np.bincount((owner[:-2] * SHAPES + code)[inner], minlength=n * SHAPES).reshape(n, SHAPES)
    hashes, owner, _, _ = words(data, offsets)
    if len(hashes):
        table[:, SHAPES : SHAPES + WORDS] = np.bincount(owner * WORDS + (hashes >> np.uint64(53)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
        total = np.bincount(owner, minlength=n)
        again = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
        order = np.lexsort((hashes, owner))
        seen = np.bincount(owner[order][1:][(hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])], minlength=n)
        table[:, -4], table[:, -3], table[:, -2], table[:, -1] = again, total - again, seen, total - seen
    for a, b in ((0, SHAPES), (SHAPES, SHAPES + WORDS), (TERMS - 4, TERMS - 2), (TERMS - 2, TERMS)):
        part = table[:, a:b]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1)
    at = np.flatnonzero(table)
    return at // TERMS, at % TERMS, np.sqrt(table.ravel()[at])


def dense(owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    table = np.zeros((n, TERMS), np.float32)
    table[owner, term] = weight
    return table


@dataclass
class QualityModel:
    #: Terms to latent dimensions, the references' unit vectors and their labels (0 to 1), the mean label.
    projection: np.ndarray
    references: np.ndarray
    labels: np.ndarray
    prior: float


def _references(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents, chosen by a hash of their id; repeated labels of an id are averaged.

    Of an id on several rows one text is taken, that of the smallest hash; ids with the same text are one reference with
    the mean of their labels. So at most ``most`` rows remain however often ids repeat, and every run takes the same.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("double").alias("_label")).where("doc_id is not null and _label is not null")
    known = known.groupBy("doc_id").agg(F.avg("_label").alias("_label"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit("references")), "doc_id").limit(most)
    # The side that is broadcast has at most ``most`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id").agg(F.min("_label").alias("_label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return single.groupBy("text").agg(F.avg("_label").alias("_label")).select("_label", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str, most: int = 4096, dimensions: int = 64) -> QualityModel:
    """A model from at most ``most`` rows of ``docs`` (``doc_id text``) that have a label in ``labels``.

    No labelled row, and so an empty table, gives a model that scores everything with 0.5. Null texts are empty ones.
    """

    def run(batches):
        for batch in batches:
            marks = batch.column("_label")
            for first, data, offsets in slices(batch, "text", SLICE, DENSE_ROWS):
                n = len(offsets) - 1
                owner, term, weight = term_shares(data, offsets)
                edges = np.searchsorted(owner, np.arange(n + 1))
                parts = [(term[a:b].astype(np.uint16).tobytes(), weight[a:b].astype(np.float32).tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([marks.slice(first, n), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], names=["label", "terms", "weights"])

    rows = _references(bound_batches(docs), labels, label, most).mapInArrow(run, "label double, terms binary, weights binary").collect()
    if not rows:
        return QualityModel(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    rows.sort(key=lambda r: (bytes(r["terms"]), bytes(r["weights"]), r["label"]))
    table = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        table[i, np.frombuffer(r["terms"], np.uint16)] = np.frombuffer(r["weights"], np.float32)
    # Randomised range finder with power iterations.
    size = min(dimensions + 32, *table.shape)
    base = np.linalg.qr(table @ np.random.default_rng(7).standard_normal((TERMS, size)).astype(np.float32))[0]
    for _ in range(3):
        base = np.linalg.qr(table @ np.linalg.qr(table.T @ base)[0])[0]
    _, _, right = np.linalg.svd(base.T @ table, full_matrices=False)
    projection = np.ascontiguousarray(right[:dimensions].T.astype(np.float32))
    marks = np.array([r["label"] for r in rows], np.float32)
    return QualityModel(projection, unit(table @ projection), marks, float(marks.mean()))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def vote(model: QualityModel, vectors: np.ndarray, neighbours: int, sharpness: float, block: int = 512) -> np.ndarray:
    """Mean label of the nearest references of each vector, weighted by a power of the cosine."""
    count = min(neighbours, len(model.references))
    scores = np.full(len(vectors), model.prior)
    if not count:
        return scores
    for a in range(0, len(vectors), block):
        cosines = vectors[a : a + block] @ model.references.T
        nearest = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        weights = np.clip(np.take_along_axis(cosines, nearest, 1), 0, 1).astype(np.float64) ** sharpness
        total = weights.sum(axis=1)
        seen = total > 0
        scores[a : a + block][seen] = (weights * model.labels[nearest]).sum(axis=1)[seen] / total[seen]
    return np.clip(scores, 0, 1)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3, neighbours: int = 15, sharpness: float = 16.0, id_column: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id score predicted`` for each row of ``docs``; ``predicted`` is 1 if the score is at least ``threshold``.

    The model is a matrix of fixed size and a bounded number of reference vectors. Null and empty texts have no terms
    and get the mean label of the references. Equal texts get equal scores; repeated rows give a row each; an empty
    table gives none; of the other columns those of ``keep`` are handed on, after the operator's own.
    """
    kept = bound_batches(docs).select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), *kept_columns(docs, keep))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, data, offsets in slices(batch, "text", SLICE, DENSE_ROWS):
                n = len(offsets) - 1
                table = dense(*term_shares(data, offsets), n)
                scores = vote(model, unit(table @ model.projection), neighbours, sharpness)
                marks = (scores >= threshold).astype(np.int32)
                others = batch.select(range(2, batch.num_columns)).slice(first, n)
                made = [batch.column("doc_id").slice(first, n), pa.array(scores), pa.array(marks)]
                yield pa.RecordBatch.from_arrays([*made, *others.columns], names=["doc_id", "score", "predicted", *others.schema.names])

    return with_kept(kept.mapInArrow(run, f"doc_id {kind}, score double, predicted int" + kept_types(kept)), keep)
