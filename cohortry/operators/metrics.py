"""Summaries, distributions and KPI tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scalars import ratio
from cohortry.operators.ordering import exact_medians, match
from cohortry.session import one_row, settle


def arm_summary(events: DataFrame, keys: Sequence[str] = ("experiment_name",), arm: str = "group") -> DataFrame:
    """Users, conversions and conversion rate per arm."""
    return events.groupBy(*keys, arm).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("converted").alias("conversions"),
        F.avg("converted").alias("cvr"),
    )


def relative_lift(events: DataFrame, keys: Sequence[str] = ("experiment_name",)) -> DataFrame:
    """One row per experiment: both rates and the lift (0 where control never converts)."""
    rate = lambda a: F.avg(F.when(F.col("group") == a, F.col("converted")))
    wide = events.groupBy(*keys).agg(rate("control").alias("control_cvr"), rate("treatment").alias("treatment_cvr"))
    c, t = F.col("control_cvr"), F.col("treatment_cvr")
    return wide.withColumn("relative_lift", F.when(c > 0, (t - c) / c).when(c == 0, 0.0))


def sentiment_stats(
    df: DataFrame, keys: Sequence[str] = (), sentiment: str = "predicted_sentiment", rating: str = "rating"
) -> DataFrame:
    """Review count, percentage per sentiment (1 dp) and mean rating (2 dp)."""
    share = lambda s: F.round(
        F.count_if(F.col(sentiment) == s) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 1
    ).cast("double")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        share("positive").alias("positive_pct"),
        share("negative").alias("negative_pct"),
        share("neutral").alias("neutral_pct"),
        F.round(F.avg(rating), 2).alias("avg_rating"),
    )


def sentiment_counts(df: DataFrame, keys: Sequence[str] = (), sentiment: str = "predicted_sentiment") -> DataFrame:
    return df.groupBy(*keys, sentiment).agg(F.count(F.lit(1)).alias("n"))


def rating_by_sentiment(df: DataFrame, sentiment: str = "predicted_sentiment", wide: bool = False) -> DataFrame:
    if wide:
        counts = df.groupBy("rating").pivot(sentiment, ["positive", "neutral", "negative"]).count()
        return counts.na.fill(0, ["positive", "neutral", "negative"])
    return df.groupBy("rating", sentiment).agg(F.count(F.lit(1)).alias("n"))


def overview(customers: DataFrame, reviews: DataFrame, events: DataFrame) -> DataFrame:
    """The KPI row: totals and churn rate. Three one-row aggregates, no join."""
    counted = one_row(reviews, F.count(F.lit(1)).alias("n"))
    logged = one_row(events, F.count(F.lit(1)).alias("n"))
    churn = F.avg("churned") if "churned" in customers.columns else F.lit(0.0)
    return customers.agg(F.count(F.lit(1)).alias("total_customers"), churn.alias("churn_rate")).select(
        "*", counted["n"].alias("total_reviews"), logged["n"].alias("total_events")
    )


def risk_counts(predictions: DataFrame, keys: Sequence[str] = (), p: str = "churn_probability") -> DataFrame:
    c = F.col(p)
    return predictions.groupBy(*keys).agg(
        F.count_if(c >= 0.7).alias("high_risk"),
        F.count_if((c >= 0.4) & (c < 0.7)).alias("medium_risk"),
        F.count_if(c < 0.4).alias("low_risk"),
        F.avg(p).alias("avg_probability"),
    )


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins over a known range; the top edge belongs to the last bin.

    Bin 0 counts the values below the range and bin ``bins + 1`` those above it; nulls are left out.
    """
    edges = F.lit(float(low)), F.lit(float(high)), F.lit(bins)
    b = F.when(F.col(value) == high, F.lit(bins)).otherwise(F.width_bucket(F.col(value), *edges))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, b.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram_by(
    df: DataFrame, value: str, bins: int, keys: Sequence[str] = (), series: Sequence[str] = ("group",)
) -> DataFrame:
    """Equal-width bins between the observed extremes, shared by all series of a key."""
    v = F.col(value)
    kept = df.filter(v.isNotNull())
    bounds = (F.min(value).alias("lo"), F.max(value).alias("hi"))
    if keys:
        spans = kept.groupBy(*keys).agg(*bounds)
        ranged = match(kept, settle(spans, "spans"), list(keys))
    else:
        ranged = kept.withColumn("_s", one_row(kept, *bounds)).select("*", "_s.*")
    width = F.col("hi") - F.col("lo")
    b = F.when(width <= 0, 1).otherwise(
        F.least(F.floor((v - F.col("lo")) * bins / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)) + 1
    )
    return ranged.groupBy(*keys, *series, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def numeric_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (column, median); exact."""
    wide = exact_medians(df, columns)
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("median")) for c in columns]))
    )


def revenue_at_risk(
    customers: DataFrame, predictions: DataFrame, p: str = "churn_probability", spend: str = "monthly_spend_inr"
) -> DataFrame:
    """High-risk count times mean spend over all customers."""
    risky = one_row(predictions, F.count_if(F.col(p) >= 0.7).alias("n"))
    return customers.agg(F.avg(spend).alias("mean_spend")).select(
        risky["n"].alias("high_risk_count"),
        "mean_spend",
        F.round(risky["n"] * F.col("mean_spend"), 2).alias("revenue_at_risk"),
    )


def sufficient_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, sum, mean, sample variance and population deviation per key: what every mean test needs."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("var_samp"),
        F.stddev_pop(value).alias("stddev_pop"),
    )


def cube_scorecard(
    events: DataFrame, keys: Sequence[str] = ("experiment_name",), dims: Sequence[str] = ("device", "source")
) -> DataFrame:
    """Arm totals and lift over every combination of the dimensions.

    Rows are combined to the finest cell before the cube, so the 2^d expansion runs over cells.
    """
    arm = lambda a, c: F.sum(F.when(F.col("group") == a, c).otherwise(0))
    cells = events.groupBy(*keys, *dims).agg(
        arm("control", F.lit(1)).alias("cn"),
        arm("control", F.col("converted")).alias("cc"),
        arm("treatment", F.lit(1)).alias("tn"),
        arm("treatment", F.col("converted")).alias("tc"),
    )
    sets = [[]]
    for d in dims:
        sets += [[*s, d] for s in sets]
    grouped = cells.groupingSets([[F.col(c) for c in (*keys, *s)] for s in sets], *keys, *dims).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("cn").alias("control_n"),
        F.sum("cc").alias("control_conversions"),
        F.sum("tn").alias("treatment_n"),
        F.sum("tc").alias("treatment_conversions"),
    )
    pc = ratio(F.col("control_conversions"), F.col("control_n"))
    pt = ratio(F.col("treatment_conversions"), F.col("treatment_n"))
    return grouped.withColumns({"control_cvr": pc, "treatment_cvr": pt}).withColumn(
        "relative_lift",
        F.when(F.col("control_cvr") > 0, (F.col("treatment_cvr") - F.col("control_cvr")) / F.col("control_cvr")).when(
            F.col("control_cvr") == 0, 0.0
        ),
    )


def run_metadata(customers: DataFrame, reviews: DataFrame, events: DataFrame) -> DataFrame:
    """One row: table sizes, churn rate, sentiment counts as a map, conversion rate per arm."""
    dist = reviews.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    labels = one_row(
        dist,
        F.sum("n").alias("rows"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("sentiment_label").isNotNull(), F.struct("sentiment_label", "n")))
        ).alias("dist"),
    )
    rate = lambda a: F.round(F.avg(F.when(F.col("group") == a, F.col("converted"))), 4)
    arms = one_row(
        events, F.count(F.lit(1)).alias("rows"), rate("control").alias("control"), rate("treatment").alias("treatment")
    )
    return customers.agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.avg("churned"), 4).alias("churn_rate")
    ).select(
        "customers",
        labels["rows"].alias("reviews"),
        arms["rows"].alias("ab_events"),
        "churn_rate",
        labels["dist"].alias("review_sentiment_dist"),
        arms["control"].alias("ab_control_cvr"),
        arms["treatment"].alias("ab_treatment_cvr"),
    )


def best_run(runs: DataFrame, metric: str = "val_auc", keys: Sequence[str] = ()) -> DataFrame:
    """The run with the highest metric (ties: smallest run id)."""
    row = F.struct("run_id", metric)
    best = F.min_by(row, F.struct((-F.col(metric)).alias("m"), "run_id"))
    return runs.filter(F.col(metric).isNotNull()).groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")
