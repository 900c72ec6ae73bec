"""Gold-layer features and the data-quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scalars import cut, ratio
from cohortry.operators.cleaning import stamped

TENURE_EDGES = (0.0, 90.0, 180.0, 365.0, 730.0, float("inf"))
TENURE_LABELS = ("new", "growing", "established", "loyal", "champion")


def experiment_features(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """Event count, mean conversion, revenue and page views per customer (one partial + final aggregate)."""
    return events.groupBy(key).agg(
        F.count("event_id").alias("total_ab_events"),
        F.avg("converted").alias("ab_conversion_rate"),
        F.avg("revenue_inr").alias("ab_avg_revenue"),
        F.avg("page_views").alias("ab_avg_page_views"),
    )


def _bounded(c: Column, top: int, clip: bool) -> Column:
    c = c.cast("double")
    if not clip:
        return c
    return F.when(c < 0, 0.0).when(c > top, float(top)).otherwise(c)


def engagement(clip: bool = True) -> Column:
    """0.3 open rate + 0.4 sessions/50 + 0.3 (1 - days/120).

    ``clip=True`` keeps sessions in 0..50 and days in 0..120, so the score stays in 0..1.
    """
    sessions = _bounded(F.col("app_sessions_monthly"), 50, clip)
    days = _bounded(F.col("last_login_days_ago"), 120, clip)
    return F.col("email_open_rate") * 0.3 + sessions / 50.0 * 0.4 + (1.0 - days / 120.0) * 0.3


def add_features(df: DataFrame, clip: bool = True) -> DataFrame:
    per_order = F.col("total_orders") + 1
    return df.withColumns(
        {
            "spend_per_order": ratio(F.col("monthly_spend_inr"), per_order),
            "tickets_per_order": ratio(F.col("support_tickets"), per_order),
            "recency_score": ratio(F.lit(1), F.col("last_login_days_ago") + 1),
            "engagement_score": engagement(clip),
            "high_value_flag": F.when(F.col("monthly_spend_inr") > 3000, 1).otherwise(0),
            "tenure_segment": cut(F.col("tenure_days"), TENURE_EDGES, TENURE_LABELS),
        }
    )


def build_gold(
    customers: DataFrame, events: DataFrame, clip: bool = True, as_of: str | None = None
) -> DataFrame:
    """Customers left-joined to their experiment features, plus the engineered columns.

    Both sides are keyed by customer: the aggregate is already hash-partitioned on the join
    key, so the join adds at most the exchange of the customer table.
    """
    joined = customers.join(experiment_features(events), "customer_id", "left")
    return add_features(joined, clip).transform(stamped, "_feature_timestamp", as_of)


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent (null keys included)."""
    return df.join(parent.select(key), key, "left_anti")


def restrict_to(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``; never multiplies rows."""
    return df.join(parent.select(key), key, "left_semi")


def shape_of(df: DataFrame, layer: str, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"),
        F.lit(name).alias("table_name"),
        F.lit("ok").alias("status"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
    )


def quality_report(spark: SparkSession, tables: Sequence[tuple[str, str, DataFrame | str]]) -> DataFrame:
    """Rows x columns per (layer, table); a path that cannot be read is reported, not fatal."""
    out = None
    for layer, name, source in tables:
        try:
            df = spark.read.parquet(source) if isinstance(source, str) else source
            row = shape_of(df, layer, name)
        except AnalysisException:
            row = spark.range(1).select(
                F.lit(layer).alias("layer"),
                F.lit(name).alias("table_name"),
                F.lit("unreadable").alias("status"),
                F.lit(None).cast("bigint").alias("n_rows"),
                F.lit(None).cast("int").alias("n_columns"),
            )
        out = row if out is None else out.unionByName(row)
    return out
