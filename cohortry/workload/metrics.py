"""Summaries, distributions, KPIs and order statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.operators import metrics
from cohortry.operators.sentiment import add_sentiment
from cohortry.sources.tables import ab_events_view, customers_view, reviews_view, table
from cohortry.workload.base import query
from cohortry.workload.cleaning import clean_events


def scored_customers(spark, d):
    """Customers with a logistic score of their recency, rounded so that equal scores occur."""
    days = F.coalesce("last_login_days_ago", F.lit(600))
    return customers_view(spark, d).select(
        "customer_id",
        "preferred_category",
        "monthly_spend_inr",
        "churned",
        F.round(1.0 / (1.0 + F.exp(-(days - 300) / 200.0)), 3).alias("p"),
    )


@query(
    """select experiment_name, "group", count(*) as n, cast(sum(converted) as bigint) as conversions, round(avg(converted), 6) as cvr
       from s_events group by experiment_name, "group" """,
    "events clean_events",
)
def arm_summary(spark, d):
    return metrics.arm_summary(clean_events(spark, d)).withColumn("cvr", F.round("cvr", 6))


@query(
    """select experiment_name, round(c, 6) as control_cvr, round(t, 6) as treatment_cvr,
         round(case when c > 0 then (t - c) / c else 0.0 end, 6) as relative_lift from (
         select experiment_name, avg(case when "group" = 'control' then converted end) as c,
           avg(case when "group" = 'treatment' then converted end) as t from v_events group by experiment_name)""",
    "events",
)
def relative_lift(spark, d):
    out = metrics.relative_lift(ab_events_view(spark, d))
    return out.select("experiment_name", *[F.round(c, 6).alias(c) for c in ("control_cvr", "treatment_cvr", "relative_lift")])


@query(
    """select category, count(*) as total_reviews,
         round(count(case when sentiment_label = 'positive' then 1 end) * 100.0::double / count(*), 1) as positive_pct,
         round(count(case when sentiment_label = 'negative' then 1 end) * 100.0::double / count(*), 1) as negative_pct,
         round(count(case when sentiment_label = 'neutral' then 1 end) * 100.0::double / count(*), 1) as neutral_pct,
         round(avg(rating), 2) as avg_rating from v_reviews group by category""",
    "reviews",
)
def sentiment_distribution_by_category(spark, d):
    return metrics.sentiment_stats(reviews_view(spark, d), ["category"], "sentiment_label")


@query("select rating, sentiment_label, count(*) as n from v_reviews group by rating, sentiment_label", "reviews")
def rating_by_sentiment(spark, d):
    return metrics.rating_by_sentiment(reviews_view(spark, d), "sentiment_label")


@query(
    """select rating, count(case when sentiment_label = 'positive' then 1 end) as positive,
         count(case when sentiment_label = 'neutral' then 1 end) as neutral,
         count(case when sentiment_label = 'negative' then 1 end) as negative from v_reviews group by rating""",
    "reviews",
)
def rating_by_sentiment_crosstab(spark, d):
    return metrics.rating_by_sentiment(reviews_view(spark, d), "sentiment_label", wide=True)


@query(
    """select count(*) as total_customers, round(avg(churned), 6) as churn_rate, (select count(*) from v_reviews) as total_reviews,
         (select count(*) from v_events) as total_events from v_customers""",
    "events customers reviews",
)
def overview_kpis(spark, d):
    out = metrics.overview(customers_view(spark, d), reviews_view(spark, d), ab_events_view(spark, d))
    return out.withColumn("churn_rate", F.round("churn_rate", 6))


@query(
    """select preferred_category, count(case when p >= 0.7 then 1 end) as high_risk,
         count(case when p >= 0.4 and p < 0.7 then 1 end) as medium_risk, count(case when p < 0.4 then 1 end) as low_risk,
         round(avg(p), 6) as avg_probability from v_scored group by preferred_category""",
    "customers scored",
)
def risk_tiers_by_category(spark, d):
    out = metrics.risk_counts(scored_customers(spark, d), ["preferred_category"], "p")
    return out.withColumn("avg_probability", F.round("avg_probability", 6))


@query(
    """select cast(least(floor(p * 40), 39) + 1 as int) as bin, count(*) as n from v_scored group by 1""", "customers scored"
)
def probability_histogram(spark, d):
    return metrics.histogram(scored_customers(spark, d), "p", 0, 1, 40)


@query(
    """with c as (select * from v_events where converted = 1),
         b as (select experiment_name, min(revenue_inr) as lo, max(revenue_inr) as hi from c group by experiment_name)
       select c.experiment_name, "group", cast(least(floor((revenue_inr - lo) * 35 / nullif(hi - lo, 0)), 34) + 1 as int) as bin, count(*) as n
       from c join b on c.experiment_name = b.experiment_name group by 1, 2, 3""",
    "events",
)
def converter_revenue_histogram(spark, d):
    buyers = ab_events_view(spark, d).filter("converted = 1")
    return metrics.histogram_by(buyers, "revenue_inr", 35, ["experiment_name"], ["group"])


@query(
    """with b as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
       select o_orderpriority, cast(least(floor((o_totalprice - lo) * 35 / (hi - lo)), 34) + 1 as int) as bin, count(*) as n
       from orders, b group by 1, 2"""
)
def order_price_histogram(spark, d):
    return metrics.histogram_by(table(spark, d, "orders"), "o_totalprice", 35, [], ["o_orderpriority"])


@query(
    """select 'tenure_days' as "column", median(tenure_days) as median from v_customers
       union all select 'monthly_spend_inr', median(monthly_spend_inr) from v_customers
       union all select 'email_open_rate', median(email_open_rate) from v_customers
       union all select 'last_login_days_ago', median(last_login_days_ago) from v_customers""",
    "customers",
)
def customer_medians(spark, d):
    return metrics.numeric_medians(
        customers_view(spark, d), ["tenure_days", "monthly_spend_inr", "email_open_rate", "last_login_days_ago"]
    )


@query(
    """select 'l_quantity' as "column", median(l_quantity) as median from lineitem
       union all select 'l_extendedprice', median(l_extendedprice) from lineitem
       union all select 'l_discount', median(l_discount) from lineitem"""
)
def lineitem_medians(spark, d):
    return metrics.numeric_medians(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    """select (select count(*) from v_scored where p >= 0.7) as high_risk_count, round(avg(monthly_spend_inr), 6) as mean_spend,
         round((select count(*) from v_scored where p >= 0.7) * avg(monthly_spend_inr), 2) as revenue_at_risk from v_customers""",
    "customers scored",
)
def revenue_at_risk(spark, d):
    out = metrics.revenue_at_risk(customers_view(spark, d), scored_customers(spark, d), "p")
    return out.withColumn("mean_spend", F.round("mean_spend", 6))


@query(
    """select l_returnflag, l_linestatus, count(l_extendedprice) as n, round(sum(l_extendedprice), 2) as total, round(avg(l_extendedprice), 4) as mean,
         round(var_samp(l_extendedprice), 2) as var_samp, round(stddev_pop(l_extendedprice), 4) as stddev_pop
       from lineitem group by l_returnflag, l_linestatus"""
)
def lineitem_sufficient_stats(spark, d):
    out = metrics.sufficient_stats(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    digits = {"total": 2, "mean": 4, "var_samp": 2, "stddev_pop": 4}
    return out.withColumns({c: F.round(c, k) for c, k in digits.items()})


@query(
    """with g as (select experiment_name, device, source, grouping_id(device, source) as level,
           count(case when "group" = 'control' then 1 end) as cn, sum(case when "group" = 'control' then converted else 0 end) as cc,
           count(case when "group" = 'treatment' then 1 end) as tn, sum(case when "group" = 'treatment' then converted else 0 end) as tc
         from s_events group by experiment_name, cube (device, source))
       select experiment_name, device, source, cast(level as bigint) as level, cn as control_n, cast(cc as bigint) as control_conversions,
         tn as treatment_n, cast(tc as bigint) as treatment_conversions, round(cast(cc as double) / cn, 6) as control_cvr, round(cast(tc as double) / tn, 6) as treatment_cvr,
         round(case when cc > 0 then (cast(tc as double) / tn - cast(cc as double) / cn) / (cast(cc as double) / cn) when cc = 0 then 0.0 end, 6) as relative_lift from g""",
    "events clean_events",
)
def cube_scorecard(spark, d):
    out = metrics.cube_scorecard(clean_events(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("control_cvr", "treatment_cvr", "relative_lift")})


@query(
    """select (select count(*) from v_customers) as customers, (select count(*) from v_reviews) as reviews, (select count(*) from v_events) as ab_events,
         (select round(avg(churned), 4) from v_customers) as churn_rate,
         (select count(*) from v_reviews where sentiment_label = 'positive') as n_positive,
         (select count(*) from v_reviews where sentiment_label = 'negative') as n_negative,
         (select count(*) from v_reviews where sentiment_label = 'neutral') as n_neutral,
         (select round(avg(converted), 4) from v_events where "group" = 'control') as ab_control_cvr,
         (select round(avg(converted), 4) from v_events where "group" = 'treatment') as ab_treatment_cvr""",
    "events customers reviews",
)
def run_metadata(spark, d):
    meta = metrics.run_metadata(customers_view(spark, d), reviews_view(spark, d), ab_events_view(spark, d))
    seen = {f"n_{s}": F.coalesce(F.try_element_at("review_sentiment_dist", F.lit(s)), F.lit(0)) for s in ("positive", "negative", "neutral")}
    return meta.withColumns(seen).drop("review_sentiment_dist")


@query(
    """select o_custkey % 10 as family, arg_min(o_orderkey, (-o_totalprice, o_orderkey)) as run_id, max(o_totalprice) as val_auc
       from orders group by 1"""
)
def best_run_by_metric(spark, d):
    """Best value and its id per family: the rule used to pick a model, over the order table."""
    runs = table(spark, d, "orders").select(
        (F.col("o_custkey") % 10).alias("family"), F.col("o_orderkey").alias("run_id"), F.col("o_totalprice").alias("val_auc")
    )
    return metrics.best_run(runs, "val_auc", ["family"])


@query(
    """select l_returnflag, l_orderkey, l_linenumber from (
         select *, row_number() over (partition by l_returnflag order by md5('42:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber) as rn from lineitem)
       where rn <= 500"""
)
def sample_by_hash(spark, d):
    from cohortry.operators.ordering import first_by_hash

    rows = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return first_by_hash(rows, ["l_returnflag"], ["l_orderkey", "l_linenumber"], 500)


@query(
    """select predicted_sentiment, count(*) as n from (select case review_text
           when 'Great value and fast courier' then 'positive' when 'Not good, never arrived' then 'neutral'
           when 'very poor <b>service</b>!' then 'negative' when 'the sofa arrived' then 'neutral'
           when 'great colour but slow courier' then 'neutral' when '5' then 'positive' when 'not bad at all' then 'positive'
           when 'Absolutely brilliant screen' then 'positive' when '2' then 'negative' when 'broken lid and rude reply' then 'negative'
           when 'easy to clean' then 'positive' when '???' then 'invalid_input' end as predicted_sentiment from v_reviews)
       group by predicted_sentiment""",
    "reviews",
)
def predicted_sentiment_counts(spark, d):
    return metrics.sentiment_counts(add_sentiment(reviews_view(spark, d)))
