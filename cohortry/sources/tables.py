"""Star-schema tables and the customer/review/experiment views derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The review phrases of the reviews view (the SQL form uses the same list).
PHRASES = (
    "Great value and fast courier",
    "Not good, never arrived",
    "very poor <b>service</b>!",
    "the sofa arrived",
    "great colour but slow courier",
    "5",
    "not bad at all",
    "Absolutely brilliant screen",
    "2",
    "broken lid and rude reply",
    "easy to clean",
    "???",
)

LABEL_DAY = "2000-08-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(selector: Column, *choices: str) -> Column:
    out = F.when(selector == 0, F.lit(choices[0]))
    for i, choice in enumerate(choices[1:-1], 1):
        out = out.when(selector == i, F.lit(choice))
    return out.otherwise(F.lit(choices[-1]))


def experiment_columns(events: DataFrame) -> DataFrame:
    """Experiment events from the raw event table; map-only, so it also serves streams."""
    kind, amount = F.col("event_type"), F.col("value")
    user, event = F.col("user_id"), F.col("event_id")
    arm = F.when(user % 50 == 0, "holdout").when(user % 2 == 0, "control").otherwise("treatment")
    revenue = F.when(kind == "purchase", amount).when(kind == "error", -amount).otherwise(F.lit(0.0))
    return events.select(
        "event_id",
        user.alias("customer_id"),
        _pick(user % 3, "exp_a", "exp_b", "exp_c").alias("experiment_name"),
        arm.alias("group"),
        F.col("ts").alias("timestamp"),
        (F.get_json_object("props", "$.k").cast("int") % 15 + 1).alias("page_views"),
        F.when(kind == "purchase", 1).otherwise(0).alias("converted"),
        revenue.alias("revenue_inr"),
        _pick(event % 3, "mobile", "desktop", "tablet").alias("device"),
        _pick(event % 5, "organic", "paid_search", "email", "social", "direct").alias("source"),
    )


def ab_events_view(spark: SparkSession, folder: str) -> DataFrame:
    return experiment_columns(table(spark, folder, "events"))


def customers_view(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: order history before the label day, churn = no order from it on.

    Orders and events are each aggregated once by customer, so the joins reuse the
    hash partitioning of the aggregates; a hot customer is combined on the map side.
    """
    day = F.lit(LABEL_DAY).cast("timestamp_ntz")
    past = F.col("o_orderdate") < day
    before = lambda c: F.when(past, c)
    history = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.count_if(~past).alias("later_n"),
            F.count_if(past).alias("n"),
            F.min(before(F.col("o_orderdate"))).alias("first_day"),
            F.max(before(F.col("o_orderdate"))).alias("last_day"),
            F.avg(before(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0))).alias("email_open_rate"),
        )
    )
    activity = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "view").alias("views"),
        )
    )
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    days = lambda c: F.datediff(F.lit(LABEL_DAY).cast("date"), F.col(c).cast("date"))
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .withColumnRenamed("c_custkey", "customer_id")
        .join(history, "customer_id", "left")
        .join(activity, "customer_id", "left")
        .select(
            "customer_id",
            F.col("c_name").alias("name"),
            F.col("n_name").alias("state"),
            F.col("c_mktsegment").alias("preferred_category"),
            F.col("first_day").cast("date").alias("signup_date"),
            days("first_day").alias("tenure_days"),
            F.col("c_acctbal").alias("monthly_spend_inr"),
            F.coalesce("n", F.lit(0)).alias("total_orders"),
            F.coalesce("errors", F.lit(0)).alias("support_tickets"),
            days("last_day").alias("last_login_days_ago"),
            "email_open_rate",
            F.coalesce("views", F.lit(0)).alias("app_sessions_monthly"),
            F.when(F.col("later_n") == 0, 1).otherwise(0).alias("churned"),
        )
    )


def reviews_view(spark: SparkSession, folder: str) -> DataFrame:
    """One review per order, its text chosen from the fixed phrases by order key."""
    key = F.col("o_orderkey")
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (key * 7 % 12).cast("int") + 1)
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        key.alias("review_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("category"),
        (key % 7).cast("int").alias("rating"),
        phrase.alias("review_text"),
        F.when(status == "F", "positive").when(status == "O", "negative").otherwise("neutral").alias(
            "sentiment_label"
        ),
        F.col("o_orderdate").alias("review_date"),
        ((F.col("o_custkey") % 2).cast("int") == 0).alias("verified_purchase"),
    )
