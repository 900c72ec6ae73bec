"""Silver-layer cleaning: keys, ranges, text, dates, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from cohortry.functions.scalars import clamp_negative, parse_number, strip_ws
from cohortry.functions.tokens import split_words
from cohortry.operators.lexicons import QUICK_NEGATORS, REVIEW_KEYWORDS

ARMS = ("control", "treatment")
IDENTITY_COLUMNS = ("customer_id", "name", "email", "signup_date")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, chosen deterministically (smallest by ``order_by``, then all other columns).

    ``row_number() = 1`` lets Spark push a group limit below the shuffle, so a key that
    repeats in a third of the rows leaves each map task as a single row.
    """
    first = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in first]
    order = [F.col(f"`{c}`") for c in first + rest] or [F.col(f"`{keys[0]}`")]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def stamped(df: DataFrame, name: str, as_of: str | None) -> DataFrame:
    return df.withColumn(name, F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp())


def to_time(c: Column, fmt: str | None = None) -> Column:
    """Timestamp or null; a value that does not parse never raises."""
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt)) if fmt else c.try_cast("timestamp")


def flag_customer_quality(df: DataFrame) -> DataFrame:
    """Clamp, cast and trim customer columns and add ``dq_valid``."""
    required = ("monthly_spend_inr", "total_orders", "churned")
    missing = F.lit(False)
    fixed = df.withColumns(
        {
            "monthly_spend_inr": clamp_negative(F.col("monthly_spend_inr"), "double"),
            "total_orders": clamp_negative(F.col("total_orders"), "int"),
            "state": F.trim("state"),
        }
    )
    for c in required:
        missing = missing | F.col(c).isNull()
    return fixed.withColumn("dq_valid", ~missing)


def clean_customers(
    df: DataFrame, keep_invalid: bool = False, as_of: str | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    out = drop_null_keys(df, "customer_id").transform(keep_first, ["customer_id"], order_by)
    out = out.transform(flag_customer_quality).transform(stamped, "_processed_at", as_of)
    return out if keep_invalid else out.filter("dq_valid")


def quality_counts(flagged: DataFrame) -> DataFrame:
    """Valid and total rows in one pass."""
    return flagged.agg(
        F.count_if("dq_valid").alias("valid_rows"), F.count(F.lit(1)).alias("total_rows")
    )


def whitelist_text(c: Column) -> Column:
    """Every character outside letters, digits and ``.,!?'`` becomes one space."""
    return F.trim(F.regexp_replace(c, "[^a-zA-Z0-9 .,!?']", " "))


def repair_rating(c: Column) -> Column:
    """Outside 1..5 -> 3 (tested before the cast, so 5.5 -> 3); null stays null."""
    number = c.try_cast("double")
    return F.when((number < 1) | (number > 5), 3).otherwise(number.try_cast("int"))


def clean_reviews(
    df: DataFrame, as_of: str | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    has_text = F.col("review_text").isNotNull() & (F.col("review_text") != "")
    return (
        keep_first(df, ["review_id"], order_by)
        .filter(has_text)
        .withColumns(
            {
                "review_text": whitelist_text(F.col("review_text")),
                "rating": repair_rating(F.col("rating")),
                "review_date": F.try_to_timestamp(
                    F.substring(F.col("review_date").cast("string"), 1, 10), F.lit("yyyy-MM-dd")
                ),
            }
        )
        .transform(stamped, "_processed_at", as_of)
    )


def event_columns(df: DataFrame) -> DataFrame:
    """Row-wise part of the event cleaning, shared by batch and streaming.

    A time that is a timestamp already is left as it is, so that a stream's watermark stays on it.
    """
    out = df.filter(F.col("group").isin(*ARMS)).withColumns(
        {"revenue_inr": clamp_negative(F.col("revenue_inr"), "double"), "converted": F.col("converted").try_cast("int")}
    )
    if isinstance(df.schema["timestamp"].dataType, TimestampType):
        return out
    return out.withColumn("timestamp", to_time(F.col("timestamp")))


def clean_ab_events(
    df: DataFrame, as_of: str | None = None, order_by: Sequence[str] | None = ("timestamp",)
) -> DataFrame:
    return (
        keep_first(df, ["event_id"], order_by)
        .transform(event_columns)
        .transform(stamped, "_processed_at", as_of)
    )


def prepare_reviews(df: DataFrame, text_col: str = "review_text", label_col: str = "sentiment_label") -> DataFrame:
    """Normalised text, its length and word count, and the label as a number."""
    label = F.col(label_col)
    numeric = F.when(label == "positive", 1).when(label == "neutral", 0).when(label == "negative", -1)
    return (
        df.withColumn("clean_text", F.coalesce(F.lower(strip_ws(F.col(text_col))), F.lit("")))
        .withColumn("text_length", F.length("clean_text"))
        .withColumn("word_count", F.size(split_words(F.col("clean_text"))))
        .withColumn("sentiment_numeric", numeric)
    )


def drop_identity(df: DataFrame, columns: Sequence[str] = IDENTITY_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def is_valid_input(text: Column) -> Column:
    """Whether a text can be scored: a rating in 1..5, or wording with at least one real word."""
    t = F.lower(strip_ws(F.coalesce(text, F.lit(""))))
    number = parse_number(t)
    letter = r"\p{L}"
    wording = (
        (F.length(t) >= 2)
        & F.exists(split_words(t), lambda w: (F.length(w) >= 2) & w.rlike(letter))
        & (
            t.rlike("|".join(sorted(REVIEW_KEYWORDS)))
            | ((F.length(t) >= 4) & t.rlike("[aeiou]"))
        )
    )
    return F.when(number.isNotNull(), number.between(1, 5)).otherwise(wording)


def has_negation(text: Column) -> Column:
    """A negator stands as a whole token in wording (a bare rating has none)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.exists(split_words(t), lambda w: w.isin(*QUICK_NEGATORS))


def sample_rows(
    df: DataFrame,
    order_by: Sequence[str],
    columns: Sequence[str] = (
        "review_text",
        "rating",
        "sentiment_label",
        "predicted_sentiment",
        "sentiment_confidence",
    ),
    n: int = 20,
) -> DataFrame:
    """First ``n`` rows of the wanted columns that exist (a bounded top-n, no full sort)."""
    return df.orderBy(*order_by).limit(n).select([c for c in columns if c in df.columns])
