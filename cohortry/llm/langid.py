"""Language identification of mixed texts: language proportions by expectation maximisation over n-gram likelihoods.

Each language has a distribution over hashed byte trigrams that are centred on a letter. A document is taken for a
mixture: every trigram comes from one of its languages. EM estimates the proportions over all languages; then the
document's language set is chosen among the 1, 2, 3 ... largest proportions by penalised likelihood, with the
proportions estimated again within each set.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import DENSE_ROWS, bound_batches, kept_columns, kept_types, slices, with_kept

BUCKETS = 8192
#: A table of more languages than this is refused; the model, which every task gets, has a row of BUCKETS for each.
MOST_LANGUAGES = 500
SLICE = 1 << 19

_LETTER = np.full(256, 32, np.uint32)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and count of each trigram bucket that a text has, sorted by text."""
    n = len(offsets) - 1
    if len(data) < 3:
        return (np.zeros(0, np.int64),) * 3
    letters = _LETTER[data]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    inner = np.flatnonzero((letters[1:-1] != 32) & (owner[:-2] == owner[2:]))
    code = letters[inner] * np.uint32(0x9E3779B1) ^ letters[inner + 1] * np.uint32(0x85EBCA6B) ^ letters[inner + 2] * np.uint32(0xC2B2AE35)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    bucket = (code >> np.uint32(19)).astype(np.int64)
    counts = np.bincount(owner[inner] * BUCKETS + bucket, minlength=n * BUCKETS)
    at = np.flatnonzero(counts)
    return at // BUCKETS, at % BUCKETS, counts[at]


@dataclass
class LanguageModel:
    languages: list[str]
    #: Log probability of each bucket (column) in each language (row).
    log_likelihood: np.ndarray


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", smoothing: float = 0.5) -> LanguageModel:
    """Trigram frequencies of each non-null ``lang`` over all rows of ``docs``, counted on the executors.

    The driver gets one count for each language and bucket. No labelled row gives a model without languages.
    """

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("lang").to_pylist()
            for first, data, offsets in slices(batch, "text", SLICE, DENSE_ROWS):
                owner, bucket, count = grams(data, offsets)
                own = np.array(labels[first : first + len(offsets) - 1], object)
                for name in {x for x in own.tolist() if x is not None}:
                    chosen = (own == name)[owner]
                    totals[name] = totals.get(name, 0) + np.bincount(bucket[chosen], weights=count[chosen], minlength=BUCKETS).astype(np.int64)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "count"])

    labelled = bound_batches(docs).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null")
    counts = labelled.mapInArrow(run, "lang string, bucket int, count bigint").groupBy("lang", "bucket").agg(F.sum("count").alias("count"))
    rows = counts.limit(MOST_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.full((len(languages), BUCKETS), smoothing)
    table[np.searchsorted(languages, rows["lang"]) if len(rows) else [], rows["bucket"]] += rows["count"]
    return LanguageModel(languages, np.log(table / table.sum(axis=1, keepdims=True)) if languages else table)


class Mixtures:
    """Proportions for the texts of a slice, from their trigrams (sorted by text)."""

    def __init__(self, model: LanguageModel, owner: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> None:
        self.texts, self.first, self.owner = np.unique(owner, return_index=True, return_inverse=True)
        self.count = count.astype(np.float64)
        logs = model.log_likelihood[:, bucket]
        #: Within a trigram only the ratios of the languages matter to the proportions.
        self.top = logs.max(axis=0)
        self.likelihood = np.exp(logs - self.top)
        self.total = np.add.reduceat(self.count, self.first) if len(self.first) else self.count

    def em(self, start: np.ndarray, rounds: int) -> np.ndarray:
        """Proportions (texts x languages) after some rounds; what starts as zero stays zero."""
        share = start
        for _ in range(rounds):
            spread = self.likelihood * share.T[:, self.owner]
            spread *= self.count / np.maximum(spread.sum(axis=0), 1e-300)
            share = np.add.reduceat(spread, self.first, axis=1).T / self.total[:, None]
        return share

    def log_likelihood(self, share: np.ndarray) -> np.ndarray:
        mixed = (self.likelihood * share.T[:, self.owner]).sum(axis=0)
        return np.add.reduceat(self.count * (np.log(np.maximum(mixed, 1e-300)) + self.top), self.first)

    def subset(self, chosen: np.ndarray) -> Mixtures:
        """Of some of the texts (true in ``chosen``)."""
        made = object.__new__(Mixtures)
        kept = chosen[self.owner]
        made.texts = self.texts[chosen]
        made.owner = (np.cumsum(chosen) - 1)[self.owner[kept]]
        made.count, made.top, made.likelihood, made.total = self.count[kept], self.top[kept], self.likelihood[:, kept], self.total[chosen]
        made.first = np.searchsorted(made.owner, np.arange(len(made.texts)))
        return made


def proportions(mixtures: Mixtures, languages: int, rounds: int, penalty: float, least: float) -> np.ndarray:
    """Proportions within the language set of the largest penalised likelihood."""
    n = len(mixtures.texts)
    full = mixtures.em(np.full((n, languages), 1 / languages), rounds)
    ranked = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros((n, languages))
    best[np.arange(n), ranked[:, 0]] = 1
    score = mixtures.log_likelihood(best)
    going = np.ones(n, bool)
    for size in range(2, languages + 1):
        # A language of next to no share cannot pay for itself.
        going &= full[np.arange(n), ranked[:, size - 1]] >= least
        if not going.any():
            break
        part, at = mixtures.subset(going), np.flatnonzero(going)
        start = np.zeros((len(at), languages))
        np.put_along_axis(start, ranked[at, :size], np.take_along_axis(full[at], ranked[at, :size], 1), 1)
        share = part.em(start / start.sum(axis=1, keepdims=True), rounds)
        value = part.log_likelihood(share) - penalty * (size - 1) * np.log(part.total)
        better = value > score[at]
        best[at[better]], score[at[better]] = share[better], value[better]
    return best


def predict(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text: str = "text", rounds: int = 15, penalty: float = 3.0, least: float = 0.005,
    keep: list[str] | None = None,
) -> DataFrame:
    """``doc_id lang_pred score languages proportions`` of each row of ``docs``.

    ``languages`` is the chosen set, largest proportion first, with its ``proportions``; ``lang_pred`` is the first of
    them (ties: the first in the alphabet) and ``score`` its proportion. ``penalty`` is for each language beyond the first, times the logarithm of the number
    of trigrams. Null texts and texts without a letter are ``und`` with score 0 and no languages, and so is every text if
    the model has none. A text too short for a trigram gets the languages' common rank: the first language in the alphabet,
    with equal proportions as score. Repeated rows give a row each; of the
    other columns those of ``keep`` are handed on, after the operator's own.
    """
    count = len(model.languages)
    names = np.array(model.languages, object)
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))])
    kept = bound_batches(docs).select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), *kept_columns(docs, keep))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, data, offsets in slices(batch, "text", SLICE, DENSE_ROWS):
                n = len(offsets) - 1
                share = np.full((n, count), 1 / max(count, 1))
                if count:
                    mixtures = Mixtures(model, *grams(data, offsets))
                    if len(mixtures.texts):
                        share[mixtures.texts] = proportions(mixtures, count, rounds, penalty, least)
                ascii_letters = np.concatenate([[0], np.cumsum((data | 32 >= 97) & (data | 32 <= 122))])[offsets]
                lettered = np.diff(ascii_letters) > 0
                for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)).tolist():
                    lettered[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
                lettered &= count > 0
                order = np.argsort(-share, axis=1, kind="stable")
                ranked = np.take_along_axis(share, order, 1)
                size = np.where(lettered, (ranked > 0).sum(axis=1), 0)
                inside = np.arange(count) < size[:, None]
                edges = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                made = [
                    pa.array(np.where(lettered, names[order[:, 0]], "und") if count else ["und"] * n, pa.string()),
                    pa.array(np.where(lettered, ranked[:, 0], 0.0) if count else np.zeros(n)),
                    pa.ListArray.from_arrays(edges, pa.array(names[order[inside]] if count else [], pa.string())),
                    pa.ListArray.from_arrays(edges, pa.array(ranked[inside], pa.float64())),
                ]
                others = batch.select(range(2, batch.num_columns)).slice(first, n)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), *made, *others.columns], names=["doc_id", *schema.names, *others.schema.names])

    made = f"doc_id {kind}, lang_pred string, score double, languages array<string>, proportions array<double>"
    return with_kept(kept.mapInArrow(run, made + kept_types(kept)), keep)
