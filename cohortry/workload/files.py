"""Sources, sinks, catalog, the layered run, and streams, through files in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry import schemas, streaming
from cohortry.operators import cleaning
from cohortry.plans import run_insights, run_medallion
from cohortry.session import scratch_path
from cohortry.sources import files
from cohortry.sources.tables import ab_events_view, customers_view, experiment_columns, reviews_view, table
from cohortry.workload.base import query
from cohortry.workload.cleaning import clean_events, gold, gold_sql, rounded_gold
from cohortry.workload.experiments import MONITOR_SQL, experiment_plans

CSV_SCHEMAS = {
    "customers": """customer_id bigint, name string, state string, preferred_category string, signup_date date, tenure_days int,
        monthly_spend_inr double, total_orders int, support_tickets int, last_login_days_ago int, email_open_rate double,
        app_sessions_monthly int, churned int""",
    "reviews": """review_id bigint, customer_id bigint, category string, rating int, review_text string, sentiment_label string,
        review_date string, verified_purchase boolean""",
    "ab_events": """event_id bigint, customer_id bigint, experiment_name string, `group` string, `timestamp` timestamp_ntz,
        page_views int, converted int, revenue_inr double, device string, source string""",
}


def export_sources(spark, d):
    """The three views written as CSV sources."""
    base = scratch_path(spark, "sources")
    views = {"customers": customers_view, "reviews": reviews_view, "ab_events": ab_events_view}
    for name, view in views.items():
        files.write_csv(view(spark, d), f"{base}/{name}")
    return {name: f"{base}/{name}" for name in views}


@query(
    """select review_id, customer_id, category, rating, review_text, sentiment_label, cast(review_date as date) as review_date, verified_purchase, true as has_lineage from v_reviews""",
    "reviews",
)
def csv_bronze_ingest(spark, d):
    """CSV with header and inferred types, landed as a bronze table with lineage columns."""
    base = scratch_path(spark, "bronze")
    files.write_csv(reviews_view(spark, d), f"{base}/reviews.csv")
    bronze, _ = files.ingest_bronze(spark, f"{base}/reviews.csv", base, "reviews")
    return bronze.select(
        F.col("review_id").cast("bigint").alias("review_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "category",
        "rating",
        "review_text",
        "sentiment_label",
        F.col("review_date").cast("date").alias("review_date"),
        "verified_purchase",
        (F.col("_ingested_at").isNotNull() & F.col("_source_file").contains("reviews.csv")).alias("has_lineage"),
    )


@query(
    """select event_id, customer_id, experiment_name, "group", page_views, converted, revenue_inr, cast("timestamp" as date) as event_date from s_events""",
    "events clean_events",
)
def layer_round_trip(spark, d):
    """Silver events written as a date-partitioned layer and read back."""
    path = scratch_path(spark, "silver-events")
    files.write_layer(clean_events(spark, d).withColumn("event_date", F.to_date("timestamp")), path, ["event_date"])
    return files.read_layer(spark, path).select(
        "event_id", "customer_id", "experiment_name", "group", "page_views", "converted", "revenue_inr", "event_date"
    )


@query(gold_sql(True), "events clean_events customers clean_customers")
def medallion_gold(spark, d):
    """CSV sources through bronze, silver and gold layers; the gold table read from the catalog.

    The database serves this run only; dropping it leaves the external table's files, which the result reads.
    """
    name = f"cohortry_{uuid.uuid4().hex}"
    tables = run_medallion(spark, export_sources(spark, d), scratch_path(spark, "medallion"), CSV_SCHEMAS, database=name)
    spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return rounded_gold(tables.gold.withColumn("total_orders", F.col("total_orders").cast("bigint")))


@query(
    """select 'bronze' as layer, 'customers' as table_name, 'ok' as status, count(*) as n_rows, 15 as n_columns from v_customers
       union all select 'bronze', 'reviews', 'ok', count(*), 10 from v_reviews union all select 'bronze', 'ab_events', 'ok', count(*), 12 from v_events
       union all select 'silver', 'customers', 'ok', count(*), 15 from s_customers union all select 'silver', 'reviews', 'ok', count(*), 9 from v_reviews
       union all select 'silver', 'ab_events', 'ok', count(*), 12 from s_events union all select 'gold', 'feature_store', 'ok', count(*), 26 from s_customers""",
    "events clean_events customers clean_customers reviews",
)
def medallion_report(spark, d):
    return run_medallion(spark, export_sources(spark, d), scratch_path(spark, "medallion"), CSV_SCHEMAS).report


@query("""select customer_id, churned from v_customers""", "customers")
def optional_loading(spark, d):
    """Existing files load by extension, a missing one gives None."""
    path = f"{scratch_path(spark, 'optional')}/customers.csv"
    files.write_csv(customers_view(spark, d).select("customer_id", "churned"), path)
    found = files.load_optional(spark, {"customers": path, "report": f"{path}/absent.md"})
    assert found["report"] is None
    return found["customers"].select(F.col("customer_id").cast("bigint").alias("customer_id"), "churned")


@query(
    """select customer_id, case when total_orders > 0 then monthly_spend_inr / total_orders end as per_order,
         null::double as bad from v_customers""",
    "customers",
)
def json_results(spark, d):
    """JSON sink: NaN and infinities become null."""
    path = scratch_path(spark, "results")
    infinite = F.when(F.col("total_orders") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    rows = customers_view(spark, d).select(
        "customer_id",
        F.when(F.col("total_orders") > 0, F.col("monthly_spend_inr") / F.col("total_orders")).otherwise(float("-inf")).alias("per_order"),
        infinite.alias("bad"),
    )
    files.write_json_results(rows, path)
    return spark.read.schema("customer_id bigint, per_order double, bad double").json(path)


@query()
def insights_run(spark, d):
    """Every stage over the views, results written as files; returns the executive summary."""
    tables = run_insights(
        spark, gold(spark, d).drop("dq_valid", "_feature_timestamp"), reviews_view(spark, d), clean_events(spark, d),
        scratch_path(spark, "insights"), kind="logistic",
    )
    return tables.summary


def in_columns(df, ddl):
    """``df`` with exactly the columns of a schema, null where it has none: files without names are read by position."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])


@query(
    """select customer_id, churned, monthly_spend_inr, timestamp '2024-06-01 00:00:00' as stamp, count(*) over () as loaded from s_customers""",
    "customers clean_customers",
)
def feature_store_csv(spark, d):
    """Silver customers stamped with a given time, written as a CSV feature store and loaded back by its schema."""
    path = scratch_path(spark, "feature-store")
    stamped = cleaning.clean_customers(customers_view(spark, d), as_of="2024-06-01 00:00:00")
    files.write_csv(in_columns(stamped, schemas.FEATURE_STORE), path)
    loaded = files.load_feature_store(spark, path)
    named = loaded.select(F.col("customer_id").cast("bigint").alias("customer_id"), F.col("churned").cast("int").alias("churned"), F.col("monthly_spend_inr").cast("double").alias("monthly_spend_inr"))
    return named.withColumns({"stamp": stamped.select(F.max("_processed_at")).scalar().cast("timestamp_ntz"), "loaded": named.agg(F.count(F.lit(1))).scalar()})


@query("select review_id, category, rating, review_text, sentiment_label from v_reviews", "reviews")
def reviews_csv(spark, d):
    """The reviews written as CSV and loaded back by their schema."""
    path = scratch_path(spark, "reviews-csv")
    files.write_csv(in_columns(reviews_view(spark, d), schemas.REVIEWS), path)
    return files.load_reviews(spark, path).select(F.col("review_id").cast("bigint").alias("review_id"), "category", "rating", "review_text", "sentiment_label")


# ---------------------------------------------------------------- streams


def event_stream(spark, d):
    raw = streaming.read_event_stream(spark, d, table(spark, d, "events").schema, "events*.parquet")
    return experiment_columns(raw)


@query(
    """select event_id, customer_id, experiment_name, "group", page_views, converted, revenue_inr, device, source from s_events""",
    "events clean_events",
)
def stream_silver_events(spark, d):
    """The event table replayed as a file stream into a silver table.

    The file source replays the oldest files first, so a day's watermark holds the state down.
    """
    base = scratch_path(spark, "stream-silver")
    cleaned = streaming.clean_event_stream(event_stream(spark, d), watermark="1 day")
    return streaming.run_to_table(cleaned, f"{base}/table", f"{base}/checkpoint").drop("timestamp")


@query(
    """select strftime(date_trunc('day', "timestamp"), '%Y-%m-%d') as day, experiment_name, "group", count(*) as n, sum(converted)::bigint as conversions, round(avg(converted), 6) as cvr
       from s_events group by all""",
    "events clean_events",
)
def daily_arm_counts(spark, d):
    out = streaming.windowed_arm_counts(clean_events(spark, d))
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "experiment_name", "group", "n", "conversions", F.round("cvr", 6).alias("cvr"))


@query(
    """select strftime(date_trunc('day', "timestamp"), '%Y-%m-%d') as day, experiment_name, "group", count(*) as n, sum(converted)::bigint as conversions, round(avg(converted), 6) as cvr
       from s_events where date_trunc('day', "timestamp") + interval 1 day <= (select max("timestamp") from s_events) - interval 1 day group by all""",
    "events clean_events",
)
def stream_closed_days(spark, d):
    """The day's counts from the event stream, each day written once, when a day's watermark has passed its end."""
    base = scratch_path(spark, "stream-days")
    counts = streaming.windowed_arm_counts(streaming.clean_event_stream(event_stream(spark, d), watermark="1 day"))
    out = streaming.closed_windows(counts, f"{base}/table", f"{base}/checkpoint")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "experiment_name", "group", "n", "conversions", F.round("cvr", 6).alias("cvr"))


@query(MONITOR_SQL, "events clean_events")
def stream_monitor(spark, d):
    """Live sequential monitor from the event stream; equals ``sequential_monitor`` over the same events."""
    base = scratch_path(spark, "stream-monitor")
    return streaming.live_monitor(event_stream(spark, d), f"{base}/table", f"{base}/checkpoint", experiment_plans(spark))
