"""Lexicon sentiment with negation, and classifier evaluation."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scalars import parse_number, strip_ws
from cohortry.functions.tokens import split_words
from cohortry.operators import lexicons
from cohortry.session import settle

CLASSES = ("positive", "neutral", "negative")


def two_places(c: Column) -> Column:
    """Two decimals; a score that is just a tie (0.695) rounds down, as its binary value does."""
    return F.round(c - 1e-9, 2)


def _contributions(
    words: Column, positive: Sequence[str], negative: Sequence[str], negators: Sequence[str], intensifiers: Sequence[str]
) -> Column:
    """Signed weight per token: > 0 counts towards positive, < 0 towards negative, 0 is no sentiment word.

    The three-token look-back is taken only for sentiment words; the branches of ``when`` are lazy.
    """

    def weigh(word: Column, i: Column) -> Column:
        back = F.slice(words, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3)))
        negated = F.exists(back, lambda w: w.isin(*negators))
        weight = F.when(F.exists(back, lambda w: w.isin(*intensifiers)), 1.5).otherwise(1.0)
        return (
            F.when(word.isin(*positive), F.when(negated, -weight).otherwise(weight))
            .when(word.isin(*negative), F.when(negated, weight * 0.5).otherwise(-weight))
            .otherwise(0.0)
        )

    return F.filter(F.transform(words, weigh), lambda x: x != 0)


def add_sentiment(
    df: DataFrame,
    text_col: str = "review_text",
    label_col: str = "predicted_sentiment",
    score_col: str = "sentiment_confidence",
    positive: Sequence[str] = lexicons.POSITIVE,
    negative: Sequence[str] = lexicons.NEGATIVE,
    negators: Sequence[str] = lexicons.NEGATORS,
    intensifiers: Sequence[str] = lexicons.INTENSIFIERS,
    strip_punct: bool = False,
) -> DataFrame:
    """Label and confidence per row; numeric text is read as a star rating.

    Expressions only: no Python worker and no shuffle. ``strip_punct`` trims punctuation around
    tokens before the lexicon test (off by default: ``good!`` is not a lexicon word).
    """
    inside = df.withColumn("_t", strip_ws(F.coalesce(F.col(text_col), F.lit(""))))
    inside = inside.withColumns({"_num": parse_number(F.col("_t")), "_w": split_words(F.lower("_t"))})
    words = F.col("_w")
    if strip_punct:
        inside = inside.withColumn("_w", F.transform(words, lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    inside = inside.withColumn("_c", _contributions(words, positive, negative, negators, intensifiers))
    total = lambda keep: F.aggregate("_c", F.lit(0.0), lambda acc, x: acc + F.greatest(keep(x), F.lit(0.0)))
    inside = inside.withColumns({"_pos": total(lambda x: x), "_neg": total(lambda x: -x)})

    r, pos, neg = F.col("_num"), F.col("_pos"), F.col("_neg")
    share = F.try_divide(pos, pos + neg)
    confidence = lambda s: F.least(two_places(0.58 + F.least(s * 0.08, F.lit(0.38))), F.lit(0.97))

    def verdict(label: str, score) -> Column:
        return F.struct(F.lit(label).alias("label"), (score if isinstance(score, Column) else F.lit(score)).alias("score"))

    rated = (
        F.when((r < 1) | (r > 5), verdict("out_of_range", 0.0))
        .when(r >= 4, verdict("positive", two_places(0.6 + (r - 4) * 0.19)))
        .when(r == 3, verdict("neutral", 0.65))
        .otherwise(verdict("negative", two_places(0.6 + (2 - r) * 0.19)))
    )
    result = (
        F.when(F.col("_t") == "", verdict("neutral", 0.5))
        .when(r.isNotNull(), rated)
        .when(~F.lower("_t").rlike("[a-z]"), verdict("invalid_input", 0.0))
        .when(pos + neg == 0, verdict("neutral", 0.55))
        .when(share >= 0.65, verdict("positive", confidence(pos)))
        .when(share <= 0.35, verdict("negative", confidence(neg)))
        .otherwise(verdict("neutral", two_places(0.52 + F.abs(share - 0.5) * 0.2)))
    )
    # The result passes through a one-element generator: Catalyst does not push later filters on the label
    # below a generator, where each would expand into a copy of the whole expression.
    keep = [c for c in df.columns if c not in (label_col, score_col)]
    return inside.select(*keep, F.inline_outer(F.array(result)).alias(label_col, score_col))


def lexicon_hits(df: DataFrame, text_col: str, lexicon: DataFrame, keys: Sequence[str] = (), term: str = "term") -> DataFrame:
    """Entries of a lexicon table that occur in texts: ``keys``, the lexicon's columns and ``n_texts``, the texts that hold them.

    A text's distinct lower-case words are joined to the table by word; several entries of one word count each. The table is
    written and read back first, so that Catalyst broadcasts it if its measured size allows and shuffles otherwise; words are
    combined before that. Null and blank texts have no words, a null entry is in no text.
    """
    entries = settle(lexicon.filter(F.col(term).isNotNull()).withColumn(term, F.lower(term)).distinct(), "lexicon")
    words = F.array_distinct(split_words(F.lower(F.coalesce(F.col(text_col), F.lit("")))))
    counted = df.select(*keys, F.explode(words).alias(term)).groupBy(*keys, term).agg(F.count(F.lit(1)).alias("n_texts"))
    return counted.join(entries, term).select(*keys, *lexicon.columns, "n_texts")


def confident_label(label: str, score: str, threshold: float = 0.75) -> Column:
    """A model's label where its score clears the threshold, else neutral."""
    return F.when(F.col(score) > threshold, F.lower(F.col(label))).otherwise("neutral")


def score_with_model(df: DataFrame, text_col: str, load, out_col: str = "model_probability") -> DataFrame:
    """Apply a user's own text model through an iterator pandas UDF.

    ``load`` is a zero-argument function run once per task; it returns a callable that maps a
    pandas Series of texts to a sequence of floats.
    """

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in batches:
            yield pd.Series(predict(texts), index=texts.index, dtype="float64")

    return df.withColumn(out_col, run(F.col(text_col)))


def confusion_counts(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (true, predicted) pair of lower-cased labels; everything below works on this small table."""
    return (
        df.select(*keys, F.lower(F.col(truth).cast("string")).alias("truth"), F.lower(F.col(pred).cast("string")).alias("pred"))
        .filter(F.col("truth").isNotNull() & F.col("pred").isNotNull())
        .groupBy(*keys, "truth", "pred")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def classification_report(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined values are 0.

    Classes are the union of true and predicted labels.
    """
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(zero)
    sides = F.inline(
        F.array(
            F.struct(F.col("truth").alias("label"), F.col("n").alias("s"), zero.alias("p"), hit.alias("tp")),
            F.struct(F.col("pred").alias("label"), zero.alias("s"), F.col("n").alias("p"), zero.alias("tp")),
        )
    )
    per = counts.select(*keys, sides).groupBy(*keys, "label").agg(
        F.sum("s").alias("support"), F.sum("p").alias("_p"), F.sum("tp").alias("_tp")
    )
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp = F.col("_tp")
    return per.select(
        *keys,
        "label",
        safe(tp, F.col("_p")).alias("precision"),
        safe(tp, F.col("support")).alias("recall"),
        safe(2 * tp, F.col("_p") + F.col("support")).alias("f1"),
        "support",
    )


def classification_summary(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 and weighted F1."""
    report = classification_report(counts, keys)
    hits = F.sum(F.col("recall") * F.col("support"))
    support = F.nullif(F.sum("support"), F.lit(0))
    return report.groupBy(*keys).agg(
        (hits / support).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / support).alias("weighted_f1"),
        F.sum("support").alias("n"),
    )


def confusion_matrix(
    counts: DataFrame, keys: Sequence[str] = (), labels: Iterable[str] = CLASSES
) -> DataFrame:
    """Dense grid over the given labels; pairs with other labels are left out."""
    grid = [(t, p) for t in labels for p in labels]
    cell = lambda t, p: F.coalesce(
        F.sum(F.when((F.col("truth") == t) & (F.col("pred") == p), F.col("n"))), F.lit(0)
    )
    wide = counts.groupBy(*keys).agg(*[cell(t, p).alias(f"c{i}") for i, (t, p) in enumerate(grid)])
    rows = [F.struct(F.lit(t).alias("truth"), F.lit(p).alias("pred"), F.col(f"c{i}").alias("n")) for i, (t, p) in enumerate(grid)]
    return wide.select(*keys, F.inline(F.array(*rows)))
