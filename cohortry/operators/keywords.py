"""TF-IDF keywords per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.tokens import ngram_terms, phrases, terms
from cohortry.operators.lexicons import STOP_WORDS
from cohortry.operators.ordering import match
from cohortry.session import settle

# Bits of a group's filter of words that a frequent phrase can be made of (64 to a number).
FILTER_BITS = 1 << 16


def tokenize(df: DataFrame, text_col: str, stop_words: Sequence[str] = STOP_WORDS, max_n: int = 2) -> DataFrame:
    """Add ``terms``: lower-case words without stop words, then their n-grams."""
    kept = df.withColumn("_k", terms(F.col(text_col), stop_words))
    return kept.withColumn("terms", ngram_terms(F.col("_k"), max_n)).drop("_k")


def _with_first_flag(grams: Column) -> Column:
    """Sorted terms of one document, the first of each run marked: one element per occurrence."""
    return F.transform(
        grams,
        lambda g, i: F.struct(
            g.alias("term"), F.when((i > 0) & (F.get(grams, i - 1) == g), 0).otherwise(1).alias("first")
        ),
    )


def _count_terms(df: DataFrame, group: Sequence[str], grams: str) -> DataFrame:
    """Occurrences and document frequency per term, from one pass over per-document term arrays.

    No (document, term) shuffle: each element carries whether it is the first of its document. Counts are
    combined per map task, so a frequent term or a large group is no hot key.
    """
    return (
        df.select(*group, F.sort_array(grams).alias("_g"))
        .select(*group, F.inline_outer(_with_first_flag(F.col("_g"))))
        .filter(F.col("term").isNotNull())
        .groupBy(*group, "term")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("first").alias("df"))
    )


def _most_frequent(counts: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    """Top ``k`` terms per group; Spark pushes the row-number filter below the exchange as a group limit."""
    w = Window.partitionBy(*group).orderBy(F.desc("total"), "term")
    return counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def _bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FILTER_BITS)).cast("int")


def _phrase_words(counts: DataFrame, best: DataFrame, group: list[str], k: int) -> DataFrame:
    """Per group a filter (``_mask``, of fixed size) of the words that a top-``k`` phrase can be made of.

    A phrase is at most as frequent as each of its words, so a phrase among the ``k`` best has only words
    that reach the ``k``-th best word's count. The filter passes all of these and few others; the more words
    there are, the more phrases are counted, and the counts stay exact.
    """
    floor = best.groupBy(*group).agg(F.when(F.count(F.lit(1)) >= k, F.min("total")).otherwise(0).alias("_floor"))
    able = match(counts, floor, group).filter(F.col("total") >= F.col("_floor")).select(*group, _bit(F.col("term")).alias("_b"))
    slot, one = F.shiftright("_b", 6), F.expr("shiftleft(1L, _b & 63)")
    slots = F.explode(F.sequence(F.lit(0), F.lit(FILTER_BITS // 64 - 1))).alias("_slot")
    none = floor.select(*group, slots).withColumn("_bits", F.lit(0).cast("bigint"))
    set_ = able.select(*group, slot.alias("_slot"), one.alias("_bits"))
    filled = none.unionByName(set_).groupBy(*group, "_slot").agg(F.bit_or("_bits").alias("_bits"))
    return filled.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_slot", "_bits"))), lambda s: s["_bits"]).alias("_mask"))


def vocabulary(
    df: DataFrame,
    group: Sequence[str],
    text_col: str,
    max_features: int | None = 50,
    stop_words: Sequence[str] = STOP_WORDS,
    max_n: int = 2,
) -> DataFrame:
    """Per group the ``max_features`` most frequent terms (ties: term), with document frequency.

    Single words are counted first; phrases are then formed from words that can still reach the top, which
    keeps the bigrams of the whole corpus out of the shuffle. The result is exact. Texts are split into words
    once; a null group is a group like any other.
    """
    group = list(group)
    words = df.select(*group, terms(F.col(text_col), stop_words).alias("_k"))
    if max_features is not None and max_n > 1:
        words = settle(words, "words")
    return _vocabulary(words, group, max_features, max_n)


def _vocabulary(words: DataFrame, group: list[str], max_features: int | None, max_n: int) -> DataFrame:
    """Of documents that are split into words (``_k``); they are read more than once."""
    if max_features is None:
        return _count_terms(words.withColumn("_t", ngram_terms(F.col("_k"), max_n)), group, "_t")
    counts = _count_terms(words, group, "_k")
    if max_n == 1:
        return _most_frequent(counts, group, max_features)
    counts = settle(counts, "word-counts")
    best = _most_frequent(counts, group, max_features)
    listed = settle(_phrase_words(counts, best, group, max_features), "phrase-words")
    able = lambda w: F.getbit(F.get("_mask", F.shiftright(_bit(w), 6)), _bit(w).bitwiseAND(63)) == 1
    masked = match(words, listed, group).withColumn("_m", F.transform("_k", lambda w: F.when(able(w), w)))
    found = _count_terms(masked.withColumn("_t", phrases(F.col("_m"), max_n)), group, "_t")
    return _most_frequent(best.unionByName(found), group, max_features)


#: Cells of (document, vocabulary term) that a task counts at once.
CELLS = 2_000_000
PARTIAL = "_gid bigint, term string, w double"


def _term_counts(words: pa.ListArray, vocabulary: list[str]) -> np.ndarray:
    """Occurrences of each vocabulary term, of one word or more, in each document: an array of documents x terms."""
    flat, n, size = words.flatten(), len(words), len(vocabulary)
    doc = np.repeat(np.arange(n), pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    parts = [t.split(" ") for t in vocabulary]
    known = pa.array(sorted({w for p in parts for w in p}), pa.string())
    code_of = dict(zip(known.to_pylist(), pc.index_in(known, value_set=coded.dictionary).to_pylist()))
    counts = np.zeros(n * size)
    term_of = np.full(len(coded.dictionary) + 1, -1)
    for t, p in enumerate(parts):
        if len(p) == 1 and code_of[p[0]] is not None:
            term_of[code_of[p[0]]] = t
    found = term_of[codes]
    at = np.flatnonzero(found >= 0)
    counts += np.bincount(doc[at] * size + found[at], minlength=n * size)
    places: dict[int, np.ndarray] = {}
    for t, p in enumerate(parts):
        if len(p) == 1 or any(code_of[w] is None for w in p):
            continue
        first = code_of[p[0]]
        if first not in places:
            places[first] = np.flatnonzero(codes == first)
        at = places[first][places[first] + len(p) <= len(codes)]
        for i, word in enumerate(p[1:], 1):
            at = at[(codes[at + i] == code_of[word]) & (doc[at + i] == doc[at])]
        counts += np.bincount(doc[at] * size + t, minlength=n * size)
    return counts.reshape(n, size)


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (``_gid _k _names _idf``) to the sums of their normalised weights by group and term."""
    for whole in batches:
        if not whole.num_rows:
            continue
        rows = max(1, CELLS // max(1, pc.max(pc.list_value_length(whole.column("_names"))).as_py()))
        for start in range(0, whole.num_rows, rows):
            batch = whole.slice(start, rows)
            groups, first, member = np.unique(batch.column("_gid").to_numpy(), return_index=True, return_inverse=True)
            for g, gid in enumerate(groups):
                names = batch.column("_names")[int(first[g])].as_py()
                idf = np.array(batch.column("_idf")[int(first[g])].as_py())
                own = batch.column("_k") if len(groups) == 1 else batch.column("_k").take(pa.array(np.flatnonzero(member == g)))
                weights = _term_counts(own, names) * idf
                norm = np.sqrt((weights * weights).sum(axis=1, keepdims=True))
                sums = np.divide(weights, norm, out=np.zeros_like(weights), where=norm > 0).sum(axis=0)
                hit = np.flatnonzero(sums > 0)
                out = [pa.array([int(gid)] * len(hit), pa.int64()), pa.array([names[i] for i in hit], pa.string()), pa.array(sums[hit])]
                yield pa.RecordBatch.from_arrays(out, ["_gid", "term", "w"])


def tfidf_keywords(
    df: DataFrame,
    group: Sequence[str],
    text_col: str,
    top_n: int | None = 10,
    max_features: int = 50,
    stop_words: Sequence[str] = STOP_WORDS,
    max_n: int = 2,
) -> DataFrame:
    """Mean L2-normalised TF-IDF weight per (group, term), ranked within the group.

    The last pass carries each group's vocabulary (at most ``max_features`` entries) to its documents as one
    array. A task numbers the words of a batch once, counts and normalises by document, and only shuffles one
    partial sum per (batch, group, term). Every document of the group counts in the mean, also those without any
    kept term.
    """
    group = list(group)
    source = df if group else df.withColumn("_all", F.lit(1))
    key = group or ["_all"]
    docs = settle(source.select(*key, terms(F.col(text_col), stop_words).alias("_k")), "words")
    sizes = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("_docs"))
    idf = F.ln((1.0 + F.col("_docs")) / (1.0 + F.col("df"))) + 1.0
    vocab = (
        match(_vocabulary(docs, key, max_features, max_n), sizes, key)
        .withColumn("idf", idf)
        .groupBy(*key, "_docs")
        .agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("_v"))
        .select(*key, "_docs", F.monotonically_increasing_id().alias("_gid"), F.col("_v.term").alias("_names"), F.col("_v.idf").alias("_idf"))
    )
    kept = settle(vocab, "vocabulary")
    known = match(docs, kept.select(*key, "_gid", "_names", "_idf"), key).select("_gid", "_k", "_names", "_idf")
    sums = known.mapInArrow(_weigh, PARTIAL).groupBy("_gid", "term").agg(F.sum("w").alias("_sum"))
    scored = sums.join(kept.select(*key, "_docs", "_gid"), "_gid").select(*key, "term", (F.col("_sum") / F.col("_docs")).alias("score"))
    w = Window.partitionBy(*key).orderBy(F.desc(F.round("score", 10)), "term")
    ranked = scored.withColumn("rank", F.row_number().over(w))
    if top_n is not None:
        ranked = ranked.filter(F.col("rank") <= top_n)
    return ranked.select(*group, "rank", "term", F.round("score", 4).alias("score"))


def keywords_by_sentiment(
    df: DataFrame, text_col: str = "review_text", sentiment: str = "predicted_sentiment", top_n: int = 10
) -> DataFrame:
    """Keywords of the three sentiment classes in one job."""
    kept = df.filter(F.col(sentiment).isin("positive", "negative", "neutral"))
    return tfidf_keywords(kept, [sentiment], text_col, top_n)


def keyword_lists(keywords: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group with its ranked keywords as an array (at most top_n entries)."""
    return keywords.groupBy(*group).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "term", "score"))),
            lambda k: F.struct(k["term"].alias("term"), k["score"].alias("score")),
        ).alias("keywords")
    )
