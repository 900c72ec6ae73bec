"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Lexicons of words and of word beginnings are mined from labelled documents by how far their use by toxic documents
exceeds chance; a short list of insults and some patterns are added. Each list, cut by strength, is a voter. The label
model is a mixture of two classes in which each voter fires with its own rates; EM estimates them from the votes on all
training documents, whose labels it does not see, and voters that agree beyond what the classes explain count for less.
A logistic regression is then trained on documents with the model's posteriors as targets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import FOLDED_VALUES, WORD_BYTES, bound_batches, mix, slices, span_hashes, spans
from cohortry.session import settle

#: Insults that any corpus of English may hold.
INSULTS = "idiot stupid moron trash scum loser pathetic worthless disgusting clown dumb ugly fool jerk filth vermin imbecile".split()
PREFIXES = (3, 4, 5, 6, 7, 8, 9)
#: Evidence (nats) and precision that a mined term needs for each tier.
TIERS = ((18.0, 0.95), (18.0, 0.8), (11.0, 0.6))
VOTERS = ["insults", *(f"{kind}{tier}{part}" for kind in ("words", "starts") for tier in ("strong", "medium", "weak") for part in "ab"), "shouting", "exclaiming", "repeating", "several", "dense", "sparse", "silent"]
LEXICAL = VOTERS.index("shouting")
SLICE = 1 << 19


def terms(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, text) of each word, and of each beginning of a word for each length of ``PREFIXES``."""
    starts, ends, owner = spans(WORD_BYTES[data], offsets)
    values = FOLDED_VALUES[data]
    out = [(span_hashes(values, starts, ends), owner)]
    for size in PREFIXES:
        chosen = ends - starts >= size
        first = starts[chosen]
        out.append((mix(span_hashes(values, first, first + size) + np.uint64(size)), owner[chosen]))
    return out


def patterns(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Whether a text is shouting, exclaiming or repeating itself, and its number of words."""
    n = len(offsets) - 1
    starts, ends, owner = spans(WORD_BYTES[data], offsets)

    def sums(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    size = np.maximum(np.diff(offsets), 1)
    upper = sums((data >= 65) & (data <= 90))
    lower = sums((data >= 97) & (data <= 122))
    hashes = span_hashes(FOLDED_VALUES[data], starts, ends)
    again = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    return [(upper > lower) & (upper >= 20), sums(data == 33) / size > 0.01, again / total > 0.1], total


@dataclass
class Lexicon:
    """Sorted hashes of terms and the voter of each."""

    hashes: np.ndarray
    voters: np.ndarray
    _filter: np.ndarray = field(init=False)
    _weak: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self._filter = np.zeros(1 << 16, bool)
        self._filter[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        self._weak = np.isin(self.voters, [i for i, name in enumerate(VOTERS) if "weak" in name])

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text and number of the term, for each occurrence of a term of the lexicon; how many words of a text have a firm one."""
        texts, numbers, often = [], [], np.zeros(len(offsets) - 1, np.int64)
        for hashes, owner in terms(data, offsets):
            maybe = np.flatnonzero(self._filter[(hashes >> np.uint64(48)).astype(np.int64)])
            if len(maybe) and len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
                met = self.hashes[at] == hashes[maybe]
                texts.append(owner[maybe[met]])
                numbers.append(at[met])
                firm = texts[-1][~self._weak[numbers[-1]]]
                often = np.maximum(often, np.bincount(firm, minlength=len(often)))
        return (np.concatenate(texts), np.concatenate(numbers), often) if texts else (np.zeros(0, np.int64), np.zeros(0, np.int64), often)


def votes(lexicon: Lexicon, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes (texts x voters), and text and term of each hit."""
    n = len(offsets) - 1
    text, term, often = lexicon.hits(data, offsets)
    cast = np.zeros((n, len(VOTERS)), bool)
    cast[text, lexicon.voters[term] if len(term) else term] = True
    looks, size = patterns(data, offsets)
    cast[:, LEXICAL:] = np.stack([*looks, often >= 3, often > 0.01 * size, often < 0.003 * size, often == 0], axis=1)
    return cast, text, term


def _labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` / 4 toxic and three times as many other documents, chosen by a hash of their id.

    Of an id on several rows the text of the smallest hash is taken; a text of several ids is toxic if half of them are.
    """
    known = labels.select("doc_id", F.col(label).cast("double").alias("_label")).where("doc_id is not null and _label is not null")
    known = known.groupBy("doc_id").agg((F.avg("_label") >= 0.5).alias("_toxic")).join(docs.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit("voters"))
    chosen = known.where("_toxic").orderBy(order, "doc_id").limit(most // 4).unionByName(known.where("not _toxic").orderBy(order, "doc_id").limit(most - most // 4))
    # The side that is broadcast has at most ``most`` rows of an id and a flag.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id").agg(F.max("_toxic").alias("_toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    known = single.groupBy("text").agg((F.avg(F.col("_toxic").cast("int")) >= 0.5).alias("_toxic")).select("_toxic", "text")
    return known.withColumn("_mined", F.pmod(F.xxhash64("text"), F.lit(3)) > 0)


def mine(sample: DataFrame) -> tuple[Lexicon, float]:
    """The voters' terms, from labelled documents (``_toxic text``), and the share of them that are toxic."""

    def run(batches):
        for batch in batches:
            toxic = np.array(batch.column("_toxic").to_pylist(), bool)
            for first, data, offsets in slices(batch, "text", SLICE):
                own = toxic[first : first + len(offsets) - 1]
                for kind, (hashes, owner) in enumerate(terms(data, offsets)):
                    if len(hashes):
                        order = np.lexsort((owner, hashes))
                        hashes, owner = hashes[order], owner[order]
                        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
                        found, at = np.unique(hashes[new], return_inverse=True)
                        bad = np.bincount(at, weights=own[owner[new]], minlength=len(found)).astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), kind, np.int32)), pa.array(bad), pa.array(np.bincount(at) - bad)], names=["term", "kind", "bad", "good"])

    size = sample.agg(F.coalesce(F.sum(F.col("_toxic").cast("int")), F.lit(0)).alias("bad"), F.count("*").alias("all")).first()
    share = min(max(size["bad"] / max(size["all"], 1), 0.001), 0.999)
    counted = sample.mapInArrow(run, "term bigint, kind int, bad bigint, good bigint").groupBy("term", "kind").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    precision = F.col("bad") / (F.col("bad") + F.col("good"))
    # How far the toxic share among its documents is beyond chance: n times the Kullback-Leibler divergence.
    rest = F.when(F.col("good") > 0, F.col("good") * F.log((1 - precision) / (1 - share))).otherwise(0.0)
    scored = counted.where(precision > share).withColumn("precision", precision).withColumn("evidence", F.col("bad") * F.log(precision / share) + rest)
    top = scored.where((F.col("evidence") >= TIERS[-1][0]) & (F.col("precision") >= TIERS[-1][1]))
    chosen: dict[int, int] = {}
    # As many as the bounded sample gives reason for: each has at least the weakest tier's evidence.
    for r in sorted(top.collect(), key=lambda r: (-r["evidence"], r["term"], r["kind"])):
        tier = next(i for i, (evidence, precision) in enumerate(TIERS) if r["evidence"] >= evidence and r["precision"] >= precision)
        chosen[r["term"]] = 1 + 6 * (r["kind"] > 0) + 2 * tier + (r["term"] & 1)
    seeds = " ".join(INSULTS).encode()
    starts, ends, _ = spans(WORD_BYTES[np.frombuffer(seeds, np.uint8)], np.array([0, len(seeds)]))
    for h in span_hashes(FOLDED_VALUES[np.frombuffer(seeds, np.uint8)], starts, ends).view(np.int64).tolist():
        chosen[h] = 0
    hashes = np.array(list(chosen), np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], np.array(list(chosen.values()), np.int64)[order]), share


@dataclass
class LabelModel:
    """Rates at which each voter fires on clean (0) and toxic (1) texts, its weight, and the toxic share."""

    rates: np.ndarray
    weights: np.ndarray
    share: float
    correlations: np.ndarray

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        log_odds = np.log(self.share / (1 - self.share)) + self._log_odds(cast)
        return 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))

    def _log_odds(self, cast: np.ndarray) -> np.ndarray:
        # A voter that does not fire abstains: a lexicon of one language says nothing about texts in another.
        return cast @ (np.log(self.rates[1] / self.rates[0]) * self.weights)


def fit_label_model(cast: np.ndarray, counts: np.ndarray, share: float, known: np.ndarray | None = None, rounds: int = 50) -> LabelModel:
    """EM over distinct vote patterns (rows of ``cast``) and how often each occurs.

    ``known``: how often each pattern occurs on labelled clean and toxic documents (columns). They anchor the classes:
    their posterior is their label, and together they weigh as much as the documents without one.

    The toxic share is that of the labelled documents. It starts from the strong lexicons: a text on which one of them fires is taken for toxic with probability 0.9. After
    each half the correlation of every two voters within a class is taken from the posteriors, and a voter's evidence is
    divided by the sum of its correlations.
    """
    cast, counts = cast.astype(float), counts.astype(float)
    strong = cast[:, [0, 1, 2, 7, 8]].any(axis=1)
    posterior = np.where(strong, 0.9, 0.02)
    voters = cast.shape[1]
    weights, correlations = np.ones(voters), np.eye(voters)
    anchors = np.zeros((2, len(cast))) if known is None else known.T.astype(float)
    anchors = anchors * (counts.sum() / max(anchors.sum(), 1))
    model = LabelModel(np.full((2, voters), 0.5), weights, share, correlations)
    for half in range(2):
        for _ in range(rounds):
            mass = np.stack([counts * (1 - posterior), counts * posterior]) + anchors
            rates = (mass @ cast + [[0.5], [1.0]] * np.array([[0.01], [1.0]])) / (mass.sum(axis=1, keepdims=True) + 2)
            model = LabelModel(np.clip(rates, 1e-5, 1 - 1e-5), weights, share, correlations)
            posterior = model.posterior(cast)
        if half == 0:
            parts = []
            for mass, rate in zip(mass, model.rates, strict=True):
                centred = cast - rate
                covariance = (centred * mass[:, None]).T @ centred / max(mass.sum(), 1e-9)
                scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
                parts.append(np.clip(covariance / scale[:, None] / scale, 0, 1) * (mass.sum() > 0))
            correlations = np.maximum((parts[0] + parts[1]) / 2, np.eye(voters))
            weights = 1 / correlations.sum(axis=1)
    return model


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    labels: LabelModel
    #: Weights of the voters' counts and then of the single terms, and the constant.
    weights: np.ndarray
    constant: float

    def scores(self, cast: np.ndarray, text: np.ndarray, term: np.ndarray) -> np.ndarray:
        voters = len(VOTERS)
        value = self.constant + cast @ self.weights[:voters]
        pairs = np.unique(np.stack([text, term], 1), axis=0) if len(text) else np.zeros((0, 2), np.int64)
        value += np.bincount(pairs[:, 0], weights=self.weights[voters + pairs[:, 1]], minlength=len(cast))
        return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def _train(features: list[np.ndarray], targets: np.ndarray, counts: np.ndarray, size: int, ridge: float = 1e-5, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse binary features with soft targets, by accelerated gradient steps.

    A step is scaled for each feature by its bound on the curvature, so that rare features are learned as fast.
    """
    rows = np.repeat(np.arange(len(features)), [len(f) + 1 for f in features])
    columns = np.concatenate([np.append(f, size) for f in features]) if features else np.zeros(0, np.int64)
    share = counts / max(counts.sum(), 1)
    most = max((len(f) + 1 for f in features), default=1)
    bound = np.bincount(columns, weights=share[rows], minlength=size + 1) * most / 4 + ridge
    penalty = np.append(np.full(size, ridge), 0)
    weights = ahead = np.zeros(size + 1)
    momentum = 1.0
    for _ in range(rounds):
        value = np.bincount(rows, weights=ahead[columns], minlength=len(features))
        error = (1 / (1 + np.exp(-np.clip(value, -50, 50))) - targets) * share
        new = ahead - (np.bincount(columns, weights=error[rows], minlength=size + 1) + penalty * ahead) / bound
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    return weights[:-1], float(weights[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str, most: int = 8192, trained: int = 8192) -> ToxicityModel:
    """The voters from at most ``most`` labelled rows of ``docs`` (``doc_id text``), the label model from the votes on all
    of ``docs``, and the classifier from at most ``trained`` distinct sets of votes and terms, each weighed by how many documents have it.

    Null and empty texts have no words. Without labelled rows, and for an empty table, only the fixed list and patterns vote.
    """
    sample = settle(_labelled(bound_batches(docs), labels, label, most), "labelled")
    lexicon, share = mine(sample.where("_mined"))

    def patterns_of(batches):
        for batch in batches:
            for _, data, offsets in slices(batch, "text", SLICE):
                cast, _, _ = votes(lexicon, data, offsets)
                codes, counts = np.unique(cast @ (1 << np.arange(len(VOTERS))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["pattern", "count"])

    def hits_of(batches):
        for batch in batches:
            for _, data, offsets in slices(batch, "text", SLICE):
                cast, text, term = votes(lexicon, data, offsets)
                order = np.lexsort((term, text))
                edges = np.searchsorted(text[order], np.arange(len(offsets)))
                found = [np.unique(term[order[a:b]]).tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(cast @ (1 << np.arange(len(VOTERS)))), pa.array(found, pa.list_(pa.int64()))], names=["pattern", "terms"])

    # Voters cannot make more than 2 ** 20 patterns, and hardly ever make a thousand. Labelled documents that no term was
    # mined from show the voters' rates as they are on new documents.
    def counted(rows: DataFrame) -> DataFrame:
        return rows.select("text").mapInArrow(patterns_of, "pattern bigint, count bigint").groupBy("pattern").agg(F.sum("count").alias("count"))

    kept = sample.where("not _mined")
    kinds = [(docs, 0), (kept.where("not _toxic"), 1), (kept.where("_toxic"), 2)]
    rows = [(r["pattern"], column, r["count"]) for part, column in kinds for r in counted(part).collect()]
    codes, at = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    counts = np.zeros((len(codes), 3))
    counts[at, np.array([r[1] for r in rows], np.int64)] = [r[2] for r in rows]
    model = fit_label_model((codes[:, None] >> np.arange(len(VOTERS)) & 1).astype(bool), counts[:, 0], share, counts[:, 1:])
    # What the classifier sees: the first by hash of the vote sets with and of those without a lexical vote.
    cast = docs.select("text").mapInArrow(hits_of, "pattern bigint, terms array<bigint>")
    order = F.xxhash64("pattern", "terms")
    lexical = F.size("terms") > 0
    chosen = cast.where(lexical).groupBy("pattern", "terms").agg(F.count("*").alias("n")).orderBy(order).limit(trained // 2)
    plain = cast.where(~lexical).groupBy("pattern", "terms").agg(F.count("*").alias("n")).orderBy(order).limit(trained // 2)
    rows = sorted((r["pattern"], tuple(r["terms"]), r["n"]) for r in chosen.unionByName(plain).collect())
    features = [np.array([*(i for i in range(len(VOTERS)) if code >> i & 1), *(len(VOTERS) + t for t in found)], np.int64) for code, found, _ in rows]
    codes = np.array([r[0] for r in rows], np.int64)
    targets = model.posterior((codes[:, None] >> np.arange(len(VOTERS)) & 1).astype(float)) if len(rows) else np.zeros(0)
    weights, constant = _train(features, targets, np.array([r[2] for r in rows], float), len(VOTERS) + len(lexicon.hashes))
    return ToxicityModel(lexicon, model, weights, constant)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id score predicted votes`` for each row; ``votes`` names the voters that fired.

    Null and empty texts get no votes and the score of the constant. Equal texts get equal scores; repeated rows give a
    row each; an empty table gives none; other columns are ignored. Without labelled toxic rows only the fixed list votes.
    """
    kept = bound_batches(docs).select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, data, offsets in slices(batch, "text", SLICE):
                n = len(offsets) - 1
                cast, text, term = votes(model.lexicon, data, offsets)
                scores = model.scores(cast, text, term)
                fired = [[VOTERS[i] for i in np.flatnonzero(row)] for row in cast]
                made = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(fired, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), *made], names=["doc_id", "score", "predicted", "votes"])

    return kept.mapInArrow(run, f"doc_id {kind}, score double, predicted int, votes array<string>")
