"""Language-model scores by masked pseudo-likelihood: a window network predicts every word from both of its sides.

The vocabulary is the most frequent words of the whole corpus and grows with it; other words share buckets by hash, in
which each has its exact share of the bucket's occurrences, from a table of the counts of all words. The hidden layer adds
an embedding of each neighbour by its place in the window; the output is a softmax over classes of words and one over the
words of a class. Training masks a part of the places of every document and predicts them; each task goes through its own
documents, and after each round the tasks' weights are averaged on the executors. A document's score is the sum of the
log probabilities of all of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import bound_batches, give_back, mix, slices, words
from cohortry.session import settle

#: Classes, words and buckets of the smallest vocabulary; ``classes`` classes have ``classes`` members, the last two classes are buckets.
CLASSES = 32
WORDS = CLASSES * CLASSES
BUCKETS = 2 * CLASSES
#: Neighbours on each side, width of the hidden layer, places in a batch.
REACH, WIDTH, BATCH = 3, 32, 4096
#: Places that are scored together.
SCORED = 2 * BATCH
#: Places of a gradient step, and the squares that past gradients begin with: small ones let the first steps be as long as the rate.
STEP, SQUARES = 2048, 1e-8
#: Weights in one row of the table in which they are averaged.
CHUNK = 8192
SLICE = 1 << 19


#: Groups in which rare words meet their counts, at least, and occurrences for each group beyond that; entries held by a task.
PARTS, PART, HELD = 64, 1 << 21, 1 << 18


@dataclass
class Vocabulary:
    """Sorted hashes of the frequent words and the number of each; the last ``2 * classes`` numbers are buckets."""

    hashes: np.ndarray
    numbers: np.ndarray
    classes: int = CLASSES
    counts: np.ndarray | None = None
    _levels: list[np.ndarray] | None = None

    @property
    def first_bucket(self) -> int:
        return self.classes * (self.classes - 2)

    def levels(self) -> list[np.ndarray]:
        """Tables of the words' places by the low bits of their hashes; words with the same bits lie in different tables."""
        if self._levels is None:
            self._levels, left = [], np.arange(len(self.hashes))
            size = 1 << (16 * len(left)).bit_length()
            slots = (self.hashes & np.uint64(size - 1)).astype(np.int64)
            while len(left):
                found, first = np.unique(slots[left], return_index=True)
                table = np.zeros(size, np.int32)
                table[found] = left[first]
                self._levels.append(table)
                left = np.delete(left, first)
        return self._levels

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        out = np.empty(len(hashes), np.int64)
        rest = np.arange(len(hashes))
        for table in self.levels():
            at = table[(hashes[rest] & np.uint64(len(table) - 1)).astype(np.int64)]
            met = self.hashes[at] == hashes[rest]
            out[rest[met]] = self.numbers[at[met]]
            rest = rest[~met]
        out[rest] = self.first_bucket + (hashes[rest] % np.uint64(2 * self.classes)).astype(np.int64)
        return out


def counted_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word count`` of every word of all documents."""

    def run(batches):
        for batch in batches:
            found = [np.unique(words(data, offsets)[0], return_counts=True) for _, data, offsets in slices(batch, text)]
            if found:
                names, at = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([x[1] for x in found]), minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(counts)], names=["word", "count"])

    return docs.select(text).mapInArrow(run, "word bigint, count bigint").groupBy("word").agg(F.sum("count").alias("count"))


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The most frequent words, half as many as the root of the number of occurrences; ties go to the smaller hash.

    A corpus of a hundred times as many words has ten times as many numbers; classes and members grow as the root of that.
    Frequent words are spread over classes.
    """
    size = counted.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    classes = max(CLASSES, 1 + int(np.ceil(np.sqrt(np.sqrt(size) / 2 + 1))))
    top = counted.orderBy(F.desc("count"), "word").limit(classes * (classes - 2)).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    rank = np.arange(len(top))
    numbers = rank % (classes - 2) * classes + rank // (classes - 2)
    order = np.argsort(hashes)
    counts = np.array([r["count"] for r in top], np.int64)
    return Vocabulary(hashes[order], numbers[order], classes, counts[order])


def bucket_totals(counted: DataFrame, known: Vocabulary) -> np.ndarray:
    """Occurrences of all words of each bucket."""

    def run(batches):
        totals = np.zeros(2 * known.classes, np.int64)
        for batch in batches:
            bucket = known.encode(batch.column("word").to_numpy().view(np.uint64)) - known.first_bucket
            rare = bucket >= 0
            np.add.at(totals, bucket[rare], batch.column("count").to_numpy()[rare])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(totals))), pa.array(totals)], names=["bucket", "total"])

    totals = np.zeros(2 * known.classes, np.int64)
    for r in counted.mapInArrow(run, "bucket bigint, total bigint").groupBy("bucket").agg(F.sum("total").alias("total")).collect():
        totals[r["bucket"]] = r["total"]
    return totals


def _rare(known: Vocabulary, parts: int):
    """Packed (text key, word, occurrences in the text) of the words in buckets, by part of the words."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            keys, names, times = (np.concatenate(x) for x in zip(*held, strict=True))
            part = ((names & np.uint64(0x7FFFFFFF)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            found, edges = np.unique(part[order], return_index=True)
            edges = np.append(edges, len(order))
            columns = [pa.array([x[order[a:b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()) for x in (keys, names, times)]
            return pa.RecordBatch.from_arrays([pa.array(found), *columns], names=["part", "keys", "words", "times"])

        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, data, offsets in slices(batch, "text", SLICE):
                hashes, owner, _, _ = words(data, offsets)
                rare = known.encode(hashes) >= known.first_bucket
                names, own = hashes[rare], keys[first + owner[rare]]
                # Equal words of a text are one entry.
                at = owner[rare].astype(np.uint64)
                _, chosen, times = np.unique(mix(names + mix(at + np.uint64(1))), return_index=True, return_counts=True)
                held.append((own[chosen], names[chosen], times.astype(np.int32)))
                size += len(chosen)
                if size >= HELD:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()
            held = []
        give_back()

    return run


RARE = pa.schema([("key", pa.int64()), ("rare", pa.float64())])


def _rare_sums(entries: pa.Table, counted: pa.Table) -> pa.Table:
    """Of one part of the words: for each text the sum of the logarithms of the counts of its words."""
    if not entries.num_rows:
        return RARE.empty_table()
    keys, names, times = (np.frombuffer(b"".join(entries.column(c).to_pylist()), kind) for c, kind in (("keys", np.int64), ("words", np.uint64), ("times", np.int32)))
    # Copies of a text have one key and the same entries.
    _, chosen = np.unique(mix(names + mix(keys.view(np.uint64))), return_index=True)
    keys, names, times = keys[chosen], names[chosen], times[chosen]
    known, counts = counted.column("word").to_numpy().view(np.uint64), counted.column("count").to_numpy()
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    value = np.zeros(len(names))
    if len(known):
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        value = np.where(known[at] == names, times * np.log(counts[at]), 0.0)
    found, at = np.unique(keys, return_inverse=True)
    sums = pa.Table.from_arrays([pa.array(found), pa.array(np.bincount(at, weights=value, minlength=len(found)))], schema=RARE)
    del keys, names, times, chosen, known, counts, order, value, found, at
    give_back()
    return sums


def shapes(classes: int = CLASSES) -> dict[str, tuple[int, ...]]:
    return {
        "embedding": (2 * REACH, classes * classes + 1, WIDTH),
        "hidden": (WIDTH,),
        "classes": (classes, WIDTH),
        "class_bias": (classes,),
        "members": (classes, classes, WIDTH),
        "member_bias": (classes, classes),
    }


def initial(seed: int = 5, classes: int = CLASSES) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {name: (rng.standard_normal(shape) * 0.1).astype(np.float32) if len(shape) > 1 else np.zeros(shape, np.float32) for name, shape in shapes(classes).items()}


def unigram_start(weights: dict[str, np.ndarray], known: Vocabulary, totals: np.ndarray) -> dict[str, np.ndarray]:
    """Weights whose outputs are the shares of all numbers in the corpus whatever surrounds them, so that training only has
    to learn what the neighbours add."""
    shares = np.full(known.classes**2, 0.5)
    shares[known.numbers] += known.counts
    shares[known.first_bucket :] += totals
    shares = (shares / shares.sum()).reshape(known.classes, known.classes)
    whole = shares.sum(axis=1)
    biases = {"class_bias": np.log(whole), "member_bias": np.log(shares / whole[:, None])}
    small = {name: weights[name] * np.float32(0.1) for name in ("classes", "members")}
    return {**weights, **small, **{name: x.astype(np.float32) for name, x in biases.items()}}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in weights.values()])


def shaped(values: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(classes).items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def neighbours(numbers: np.ndarray, owner: np.ndarray, places: np.ndarray, beyond: int) -> np.ndarray:
    """Numbers of the words around each place (places x 2 * REACH); ``beyond`` where the text has none."""
    out = np.full((len(places), 2 * REACH), beyond, np.int32)
    for i, step in enumerate((*range(-REACH, 0), *range(1, REACH + 1))):
        at = places + step
        inside = (at >= 0) & (at < len(numbers))
        inside[inside] = owner[at[inside]] == owner[places[inside]]
        out[inside, i] = numbers[at[inside]]
    return out


# Hidden values are within -1 and 1, so with weights of trained size no sum comes near what a float can hold.
def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the logits and their sum in each row."""
    np.minimum(logits, 60, out=logits)
    raised = np.exp(logits)
    return raised, raised @ np.ones(raised.shape[1], np.float32)


def forward(weights: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    total = np.take(weights["embedding"][0], around[:, 0], axis=0, mode="clip")
    part = np.empty_like(total)
    for i in range(1, 2 * REACH):
        total += np.take(weights["embedding"][i], around[:, i], axis=0, mode="clip", out=part)
    total += weights["hidden"]
    return np.tanh(total, out=total)


def by_class(target: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the targets by class, and where each class begins in it."""
    kind = (target // classes).astype(np.uint16)
    order = np.argsort(kind, kind="stable")
    return order, np.searchsorted(kind[order], np.arange(classes + 1))


def log_probabilities(weights: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of each target given its neighbours."""
    classes = len(weights["classes"])
    order, edges = by_class(target, classes)
    # All work is done in the order of the classes, whose members then lie side by side.
    hidden, target = forward(weights, around[order]), target[order]
    logits = hidden @ weights["classes"].T + weights["class_bias"]
    _, total = _exponentials(logits)
    rows = np.arange(len(target))
    value = logits[rows, target // classes].astype(np.float64) - np.log(total)
    for c in range(classes):
        a, b = edges[c], edges[c + 1]
        if a < b:
            np.matmul(hidden[a:b], weights["members"][c].T, out=logits[a:b])
            logits[a:b] += weights["member_bias"][c]
    _, total = _exponentials(logits)
    value += logits[rows, target % classes] - np.log(total)
    out = np.empty(len(target))
    out[order] = value
    return out


class Trainer:
    """Gradient steps on batches, with a step size that shrinks by the squares of past gradients (Adagrad)."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.squares = {k: np.full(v.shape, SQUARES, np.float32) for k, v in weights.items()}
        self.rate = rate
        self.seen = 0

    def _move(self, name: str, gradient: np.ndarray, index=...) -> None:
        squares = self.squares[name][index] + gradient * gradient
        self.squares[name][index] = squares
        np.sqrt(squares, out=squares)
        np.divide(gradient, squares, out=gradient)
        gradient *= np.float32(self.rate)
        self.weights[name][index] -= gradient

    def step(self, around: np.ndarray, target: np.ndarray) -> None:
        w, n = self.weights, len(target)
        classes = len(w["classes"])
        order, edges = by_class(target, classes)
        around, target = around[order], target[order]
        hidden, rows = forward(w, around), np.arange(n)
        raised, total = _exponentials(hidden @ w["classes"].T + w["class_bias"])
        error = raised / total[:, None]
        error[rows, target // classes] -= 1
        error /= n
        back = error @ w["classes"]
        logits = np.empty_like(error)
        for c in range(classes):
            a, b = edges[c], edges[c + 1]
            logits[a:b] = hidden[a:b] @ w["members"][c].T + w["member_bias"][c]
        raised, total = _exponentials(logits)
        wrong = raised / total[:, None]
        wrong[rows, target % classes] -= 1
        wrong /= n
        members, biases = np.zeros_like(w["members"]), np.zeros_like(w["member_bias"])
        for c in range(classes):
            a, b = edges[c], edges[c + 1]
            if a < b:
                members[c], biases[c] = wrong[a:b].T @ hidden[a:b], wrong[a:b].sum(axis=0)
                back[a:b] += wrong[a:b] @ w["members"][c]
        back *= 1 - hidden**2
        self._move("classes", error.T @ hidden)
        self._move("class_bias", error.sum(axis=0))
        self._move("members", members)
        self._move("member_bias", biases)
        self._move("hidden", back.sum(axis=0))
        # Short numbers are sorted by their bytes, which is faster.
        short = np.uint16 if classes * classes < 1 << 16 else np.int32
        for i in range(2 * REACH):
            column = around[:, i].astype(short)
            order = np.argsort(column, kind="stable")
            column = column[order]
            first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            self._move("embedding", np.add.reduceat(back[order], first, axis=0), (i, column[first]))
        self.seen += n


def _trained(words_: Vocabulary, weights: np.ndarray, masked: float, rate: float, salt: int):
    limit = np.uint64(int(masked * 2**32))

    def run(batches):
        trainer = Trainer(shaped(weights, words_.classes), rate)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def spend() -> None:
            around, target = (np.concatenate(x) for x in zip(*held, strict=True))
            for a in range(0, len(target), STEP):
                trainer.step(around[a : a + STEP], target[a : a + STEP])

        for batch in batches:
            for _, data, offsets in slices(batch, "text", SLICE):
                hashes, owner, _, _ = words(data, offsets)
                # Masked places depend on the word, its place in the slice and the round.
                places = np.flatnonzero(mix(hashes + np.arange(len(hashes), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) >> np.uint64(32) < limit)
                if len(places):
                    numbers = words_.encode(hashes)
                    held.append((neighbours(numbers, owner, places, words_.classes**2), numbers[places]))
                    size += len(places)
                if size >= 8 * BATCH:
                    spend()
                    held, size = [], 0
        if held:
            spend()
        if trainer.seen:
            values = flat(trainer.weights)
            for chunk, a in enumerate(range(0, len(values), CHUNK)):
                part = values[a : a + CHUNK].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([TaskContext.get().partitionId() % 8]), pa.array([trainer.seen]), pa.array([part], pa.binary())], names=["chunk", "part", "seen", "weights"])

    return run


def _added(batches):
    """Means of rows that are sorted by chunk, by the number of places each has seen."""
    chunk, seen, total = None, 0, None

    def mean() -> pa.RecordBatch:
        values = (total / seen).astype(np.float32).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([seen]), pa.array([values], pa.binary())], names=["chunk", "seen", "weights"])

    for batch in batches:
        for own, count, values in zip(batch.column("chunk").to_pylist(), batch.column("seen").to_pylist(), batch.column("weights"), strict=True):
            values = np.frombuffer(values.as_buffer(), np.float32)
            if own != chunk:
                if chunk is not None:
                    yield mean()
                chunk, seen, total = own, 0, np.zeros(len(values))
            seen += count
            total += values * float(count)
    if chunk is not None:
        yield mean()


@dataclass
class LanguageModel:
    """``counts`` (``word count``) and ``totals``, those of the buckets, give the shares of the words in buckets."""

    vocabulary: Vocabulary
    weights: np.ndarray
    counts: DataFrame
    totals: np.ndarray


def fit(docs: DataFrame, rounds: int = 2, masked: float = 0.15, rate: float = 0.2, text: str = "text") -> LanguageModel:
    """A model of all of ``docs``: counts of all words, then ``rounds`` passes that mask a share of every text's places.

    Training starts from the shares of words in the corpus. The tasks' weights are averaged by the number of places each saw, in two shuffled steps of running sums; the driver
    gets one set of weights. A table without words gives the initial weights.
    """
    rows = bound_batches(docs).select(F.col(text).alias("text"))
    counted = settle(counted_words(rows), "word-counts")
    known = vocabulary(counted)
    totals = bucket_totals(counted, known)
    weights = flat(unigram_start(initial(classes=known.classes), known, totals))
    sums = "chunk bigint, seen bigint, weights binary"
    for i in range(rounds):
        trained = rows.mapInArrow(_trained(known, weights, masked, rate / (i + 1), i), "chunk bigint, part bigint, seen bigint, weights binary")
        partly = trained.repartition("chunk", "part").sortWithinPartitions("chunk").drop("part").mapInArrow(_added, sums)
        whole = partly.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_added, sums).collect()
        if whole:
            weights = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(whole, key=lambda r: r["chunk"])])
    return LanguageModel(known, weights, counted, totals)


def score(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id n_words log_likelihood mean_log_likelihood`` of each row: every word of the whole text is predicted.

    A word in a bucket has the bucket's probability times its share of the bucket's occurrences; a word that the model
    has never counted has the share of a single occurrence, which each bucket keeps free for it.

    Null texts and texts without words have 0 words, a sum of 0 and no mean. Equal texts get equal scores; repeated rows
    give a row each; an empty table gives none; other columns are ignored.
    """
    kept = bound_batches(docs).select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    known, flat_weights, totals = model.vocabulary, model.weights, np.log(model.totals + 1.0)

    def run(batches):
        weights = shaped(flat_weights, known.classes)
        for batch in batches:
            for first, data, offsets in slices(batch, "text", SLICE):
                n = len(offsets) - 1
                hashes, owner, _, _ = words(data, offsets)
                numbers = known.encode(hashes)
                values = np.zeros(len(numbers))
                for a in range(0, len(numbers), SCORED):
                    places = np.arange(a, min(a + SCORED, len(numbers)))
                    values[places] = log_probabilities(weights, neighbours(numbers, owner, places, known.classes**2), numbers[places])
                rare = numbers >= known.first_bucket
                values[rare] -= totals[numbers[rare] - known.first_bucket]
                count = np.bincount(owner, minlength=n)
                total = np.bincount(owner, weights=values, minlength=n).astype(float)
                made = [batch.column(c).slice(first, n) for c in ("doc_id", "key")]
                yield pa.RecordBatch.from_arrays([*made, pa.array(count), pa.array(total)], names=["doc_id", "key", "n_words", "total"])

    parts = max(PARTS, int(model.totals.sum()) // PART)
    entries = kept.select("key", "text").mapInArrow(_rare(known, parts), "part int, keys binary, words binary, times binary")
    counted = model.counts.select(F.expr(f"cast((word & 2147483647) % {parts} as int)").alias("part"), "word", "count")
    sums = entries.groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(_rare_sums, "key bigint, rare double")
    sums = settle(sums.groupBy("key").agg(F.sum("rare").alias("rare")), "rare-words")
    scored = kept.mapInArrow(run, f"doc_id {kind}, key bigint, n_words bigint, total double").join(sums, "key", "left")
    scored = scored.withColumn("log_likelihood", F.col("total") + F.coalesce("rare", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood")
    return scored.select("doc_id", "n_words", "log_likelihood", mean)
