"""Cleaning, features, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.functions import ratio
from cohortry.operators import cleaning, features, lexicons
from cohortry.operators.lexicons import QUICK_NEGATORS, REVIEW_KEYWORDS
from cohortry.sources.tables import ab_events_view, customers_view, reviews_view, table
from cohortry.workload.base import query, text_list

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_events(spark, d):
    return cleaning.clean_ab_events(ab_events_view(spark, d)).drop("_processed_at")


def clean_customers(spark, d):
    return cleaning.clean_customers(customers_view(spark, d)).drop("_processed_at")


@query(
    """select review_id, customer_id, review_text, rating from (
         select *, row_number() over (partition by customer_id, review_text order by review_date, review_id) as rn from v_reviews)
       where rn = 1""",
    "reviews",
)
def dedup_reviews_by_customer_text(spark, d):
    rows = reviews_view(spark, d).select("customer_id", "review_text", "review_date", "review_id", "rating")
    kept = cleaning.keep_first(rows, ["customer_id", "review_text"], ["review_date", "review_id"])
    return kept.select("review_id", "customer_id", "review_text", "rating")


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from (
         select *, row_number() over (partition by l_orderkey order by l_extendedprice, l_linenumber, l_partkey) as rn from lineitem)
       where rn = 1"""
)
def dedup_lineitem_by_order(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_linenumber", "l_partkey")
    return cleaning.keep_first(rows, ["l_orderkey"], ["l_extendedprice", "l_linenumber", "l_partkey"])


@query("select * from v_customers where tenure_days is not null", "customers")
def filter_null_keys(spark, d):
    return cleaning.drop_null_keys(customers_view(spark, d), "tenure_days")


@query(
    """select customer_id, name, state, preferred_category, signup_date, tenure_days, monthly_spend_inr, total_orders::int as total_orders,
         support_tickets, last_login_days_ago, email_open_rate, app_sessions_monthly, churned, true as dq_valid
       from s_customers""",
    "customers clean_customers",
)
def silver_customers(spark, d):
    return clean_customers(spark, d)


@query(
    """select count(case when tenure_days is not null and spend is not null then 1 end) as valid_rows, count(*) as total_rows
       from (select tenure_days, case when monthly_spend_inr < 0 then 0.0 else monthly_spend_inr end as spend from v_customers)""",
    "customers",
)
def customer_quality_counts(spark, d):
    view = customers_view(spark, d).withColumn("total_orders", F.col("tenure_days"))
    return cleaning.quality_counts(cleaning.flag_customer_quality(view))


@query(
    """select review_id, customer_id, category, case when rating < 1 or rating > 5 then 3 else rating end as rating,
         trim(regexp_replace(review_text, '[^a-zA-Z0-9 .,!?'']', ' ', 'g')) as review_text,
         sentiment_label, cast(review_date as date) as review_date, verified_purchase
       from v_reviews where review_text <> ''""",
    "reviews",
)
def silver_reviews(spark, d):
    out = cleaning.clean_reviews(reviews_view(spark, d)).drop("_processed_at")
    return out.withColumn("review_date", F.to_date("review_date"))


@query(
    """select event_id, customer_id, experiment_name, "group", strftime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp",
         page_views, converted, revenue_inr, device, source from s_events""",
    "events clean_events",
)
def silver_events(spark, d):
    return clean_events(spark, d).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    """select doc_id, trim(regexp_replace(text, '[^a-zA-Z0-9 .,!?'']', ' ', 'g')) as cleaned from documents"""
)
def whitelist_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", cleaning.whitelist_text(F.col("text")).alias("cleaned"))


@query("""select page_id, trim(regexp_replace(html, '[^a-zA-Z0-9 .,!?'']', ' ', 'g')) as cleaned from pages""")
def whitelist_pages(spark, d):
    return table(spark, d, "pages").select("page_id", cleaning.whitelist_text(F.col("html")).alias("cleaned"))


@query(
    f"""with t as (select doc_id, lower(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) as clean_text from documents)
       select doc_id, md5(clean_text) as text_md5, length(clean_text) as text_length,
         cast(len(list_filter(regexp_split_to_array(clean_text, '{WS}+'), lambda x: x <> '')) as int) as word_count from t"""
)
def normalise_documents(spark, d):
    docs = table(spark, d, "documents").withColumn("sentiment_label", F.lit("neutral"))
    out = cleaning.prepare_reviews(docs, "text")
    return out.select("doc_id", F.md5("clean_text").alias("text_md5"), F.length("clean_text").cast("bigint").alias("text_length"), "word_count")


@query(
    """select review_id, lower(trim(review_text)) as clean_text, cast(length(trim(review_text)) as int) as text_length,
         cast(len(string_split(trim(review_text), ' ')) as int) as word_count,
         case sentiment_label when 'positive' then 1 when 'neutral' then 0 when 'negative' then -1 end as sentiment_numeric
       from v_reviews""",
    "reviews",
)
def review_metrics(spark, d):
    out = cleaning.prepare_reviews(reviews_view(spark, d))
    return out.select("review_id", "clean_text", "text_length", "word_count", "sentiment_numeric")


@query(
    """select state, preferred_category, tenure_days, monthly_spend_inr, churned from v_customers""", "customers"
)
def drop_identity_columns(spark, d):
    view = customers_view(spark, d).select("customer_id", "name", "signup_date", "state", "preferred_category", "tenure_days", "monthly_spend_inr", "churned")
    return cleaning.drop_identity(view)


def valid_sql(ids: str, text: str, source: str) -> str:
    keyword = "|".join(sorted(REVIEW_KEYWORDS))
    letter = r"\p{L}"
    return f"""
  select {ids}, case when regexp_matches(t, '{NUM}') then cast(t as double) between 1 and 5
    else length(t) >= 2
      and len(list_filter(regexp_split_to_array(t, '{WS}+'), lambda w: length(w) >= 2 and regexp_matches(w, '{letter}'))) > 0
      and (regexp_matches(t, '{keyword}') or (length(t) >= 4 and regexp_matches(t, '[aeiou]'))) end as valid,
    not regexp_matches(t, '{NUM}') and list_has_any(regexp_split_to_array(t, '{WS}+'), [{text_list(QUICK_NEGATORS)}]) as negated
  from (select *, lower(regexp_replace(coalesce({text}, ''), '^{WS}+|{WS}+$', '', 'g')) as t from {source})"""


@query(valid_sql("review_id", "review_text", "v_reviews"), "reviews")
def review_input_checks(spark, d):
    t = F.col("review_text")
    return reviews_view(spark, d).select(
        "review_id", cleaning.is_valid_input(t).alias("valid"), cleaning.has_negation(t).alias("negated")
    )


@query(valid_sql("conv_id, turn", "text", "conversations"))
def conversation_input_checks(spark, d):
    t = F.col("text")
    return table(spark, d, "conversations").select(
        "conv_id", "turn", cleaning.is_valid_input(t).alias("valid"), cleaning.has_negation(t).alias("negated")
    )


@query(
    """select review_text, rating, sentiment_label from v_reviews order by review_id limit 20""", "reviews"
)
def review_sample(spark, d):
    return cleaning.sample_rows(reviews_view(spark, d), ["review_id"])


# ---------------------------------------------------------------- features

def six_places(c: str):
    """Six decimals for comparison; the shift settles exact ties (sums of cents over 64 rows) and -0.0."""
    return (F.round(F.col(c) + 1e-10, 6) + 0.0).alias(c)


FEATURES_SQL = """f as (
  select customer_id, count(event_id) as total_ab_events, avg(converted) as ab_conversion_rate,
    avg(revenue_inr) as ab_avg_revenue, avg(page_views) as ab_avg_page_views
  from s_events group by customer_id)"""


@query(
    f"""with {FEATURES_SQL} select customer_id, total_ab_events, round(ab_conversion_rate + 1e-10, 6) as ab_conversion_rate,
         round(ab_avg_revenue + 1e-10, 6) as ab_avg_revenue, round(ab_avg_page_views + 1e-10, 6) as ab_avg_page_views from f""",
    "events clean_events",
)
def customer_experiment_features(spark, d):
    out = features.experiment_features(clean_events(spark, d))
    return out.select(
        "customer_id", "total_ab_events", *[six_places(c) for c in ("ab_conversion_rate", "ab_avg_revenue", "ab_avg_page_views")]
    )


GOLD_COLUMNS = [
    "customer_id", "total_ab_events", "ab_conversion_rate", "ab_avg_revenue", "ab_avg_page_views", "spend_per_order",
    "tickets_per_order", "recency_score", "engagement_score", "high_value_flag", "tenure_segment", "churned",
]
GOLD_ROUNDED = [c for c in GOLD_COLUMNS if c not in ("customer_id", "total_ab_events", "high_value_flag", "tenure_segment", "churned")]


def gold_sql(clip: bool) -> str:
    s = "least(greatest(app_sessions_monthly, 0), 50)" if clip else "app_sessions_monthly"
    days = "case when last_login_days_ago < 0 then 0 when last_login_days_ago > 120 then 120 else last_login_days_ago end" if clip else "last_login_days_ago"
    return f"""with {FEATURES_SQL}, g as (
      select c.customer_id, total_ab_events, ab_conversion_rate, ab_avg_revenue, ab_avg_page_views,
        monthly_spend_inr / (total_orders + 1) as spend_per_order,
        cast(support_tickets as double) / (total_orders + 1) as tickets_per_order,
        1.0::double / (last_login_days_ago + 1) as recency_score,
        email_open_rate * 0.3::double + {s} / 50.0::double * 0.4::double + (1.0::double - ({days}) / 120.0::double) * 0.3::double as engagement_score,
        case when monthly_spend_inr > 3000 then 1 else 0 end as high_value_flag,
        case when tenure_days <= 0 then null when tenure_days <= 90 then 'new' when tenure_days <= 180 then 'growing'
             when tenure_days <= 365 then 'established' when tenure_days <= 730 then 'loyal' when tenure_days > 730 then 'champion' end as tenure_segment,
        churned
      from s_customers c left join f on c.customer_id = f.customer_id)
    select {", ".join(f"round({c} + 1e-10, 6) + 0.0 as {c}" if c in GOLD_ROUNDED else c for c in GOLD_COLUMNS)} from g"""


def rounded_gold(df):
    return df.select(*[six_places(c) if c in GOLD_ROUNDED else F.col(c) for c in GOLD_COLUMNS])


def gold(spark, d, clip=True):
    return features.build_gold(clean_customers(spark, d), clean_events(spark, d), clip)


@query(gold_sql(True), "events clean_events customers clean_customers")
def gold_feature_store(spark, d):
    return rounded_gold(gold(spark, d))


@query(gold_sql(False), "events clean_events customers clean_customers")
def gold_feature_store_unclipped(spark, d):
    return rounded_gold(gold(spark, d, clip=False))


@query(
    """select 'silver' as layer, 'customers' as table_name, 'ok' as status, count(*) as n_rows, 14 as n_columns from s_customers
       union all select 'silver', 'ab_events', 'ok', count(*), 10 from s_events
       union all select 'bronze', 'reviews', 'ok', count(*), 8 from v_reviews
       union all select 'gold', 'missing', 'unreadable', null, null""",
    "events clean_events customers clean_customers reviews",
)
def data_quality_report(spark, d):
    return features.quality_report(
        spark,
        [
            ("silver", "customers", clean_customers(spark, d)),
            ("silver", "ab_events", clean_events(spark, d)),
            ("bronze", "reviews", reviews_view(spark, d)),
            ("gold", "missing", f"{d}/no-such-layer"),
        ],
    )


@query(
    """select event_id, customer_id, experiment_name from v_events
       where customer_id not in (select customer_id from v_customers where tenure_days is not null)""",
    "events customers",
)
def orphan_events(spark, d):
    parents = customers_view(spark, d).filter("tenure_days is not null")
    return features.orphans(ab_events_view(spark, d), parents, "customer_id").select("event_id", "customer_id", "experiment_name")


@query(
    """select review_id, customer_id from v_reviews
       where customer_id in (select customer_id from v_customers where monthly_spend_inr < 0)""",
    "reviews customers",
)
def reviews_of_negative_balance_customers(spark, d):
    owing = customers_view(spark, d).filter("monthly_spend_inr < 0")
    return features.restrict_to(reviews_view(spark, d), owing, "customer_id").select("review_id", "customer_id")


@query(
    f"""select term, kind, count(*) as n_reviews from
         (select review_id, unnest(list_distinct(string_split(lower(review_text), ' '))) as term from v_reviews)
         join (select unnest([{text_list(lexicons.POSITIVE)}]) as term, 'positive' as kind union all select unnest([{text_list(lexicons.NEGATIVE)}]), 'negative') using (term)
       group by term, kind""",
    "reviews",
)
def lexicon_table_lookup(spark, d):
    """A lexicon kept as a table: token rows joined to it; Catalyst broadcasts it by its known size."""
    entries = [F.struct(F.lit(w).alias("term"), F.lit(kind).alias("kind")) for kind, words in (("positive", lexicons.POSITIVE), ("negative", lexicons.NEGATIVE)) for w in words]
    lexicon = spark.range(1).select(F.inline(F.array(*entries)))
    words = reviews_view(spark, d).select(F.explode(F.array_distinct(F.split(F.lower("review_text"), " "))).alias("term"))
    return words.join(lexicon, "term").groupBy("term", "kind").agg(F.count(F.lit(1)).alias("n_reviews"))


# ---------------------------------------------------------------- scalar function families


@query(
    """select c_custkey, upper(trim(c_name)) as up, lower(c_mktsegment) as low, substring(c_name, 1, 8) as head,
         length(c_name) as len, regexp_matches(c_name, '00[0-9]$') as hit, regexp_replace(c_name, '[#0]+', '-', 'g') as swapped,
         contains(c_mktsegment, 'MACH') as has, upper(substring(lower(c_mktsegment), 1, 1)) || substring(lower(c_mktsegment), 2) as title,
         concat_ws('/', c_mktsegment, c_name) as joined, string_split(c_name, '#')[1] as first_part from customer"""
)
def string_functions(spark, d):
    n, m = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        "c_custkey",
        F.upper(F.trim(n)).alias("up"),
        F.lower(m).alias("low"),
        F.substring(n, 1, 8).alias("head"),
        F.length(n).cast("bigint").alias("len"),
        n.rlike("00[0-9]$").alias("hit"),
        F.regexp_replace(n, "[#0]+", "-").alias("swapped"),
        m.contains("MACH").alias("has"),
        F.initcap(m).alias("title"),
        F.concat_ws("/", m, n).alias("joined"),
        F.split(n, "#")[0].alias("first_part"),
    )


@query(
    f"""select review_id, case when regexp_matches(review_text, '{NUM}') then cast(review_text as double) end as number from v_reviews""",
    "reviews",
)
def soft_number_parsing(spark, d):
    from cohortry.functions import parse_number, strip_ws

    return reviews_view(spark, d).select("review_id", parse_number(strip_ws(F.col("review_text"))).alias("number"))


@query(
    """select o_orderkey, round(sqrt(o_totalprice), 6) as root, abs(o_totalprice - 150000) as gap, ceil(o_totalprice / 1000) as up,
         least(o_totalprice, 100000.0::double) as low, greatest(o_totalprice, 100000.0::double) as high,
         round(asin(sqrt((o_orderkey % 1000) / 1000.0::double)), 6) as arc, round(ln(o_totalprice), 6) as log from orders"""
)
def math_functions(spark, d):
    p = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.round(F.sqrt(p), 6).alias("root"),
        F.abs(p - 150000).alias("gap"),
        F.ceil(p / 1000).cast("double").alias("up"),
        F.least(p, F.lit(100000.0)).alias("low"),
        F.greatest(p, F.lit(100000.0)).alias("high"),
        F.round(F.asin(F.sqrt(F.col("o_orderkey") % 1000 / 1000.0)), 6).alias("arc"),
        F.round(F.ln(p), 6).alias("log"),
    )


@query(
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day_text, cast(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') as date) as parsed,
         cast(date_diff('day', cast(o_orderdate as date), date '2002-01-01') as int) as age from orders"""
)
def date_functions(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("day_text"),
        F.to_date(cleaning.to_time(day, "yyyy-MM-dd")).alias("parsed"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).alias("age"),
    )


@query(
    """with w as (select review_id, string_split(review_text, ' ') as w from v_reviews)
       select review_id, array_to_string(w[1:2], ' ') as head, len(list_filter(w, lambda x: length(x) > 4)) > 0 as has_long,
         cast(len(list_filter(w, lambda x: length(x) > 3)) as int) as n_long, w[-1] as last_word,
         array_to_string(list_transform(w, lambda x: substring(x, 1, 1)), '') as initials,
         cast(list_sum(list_transform(w, lambda x: length(x))) as bigint) as n_letters,
         cast(len(flatten([w, w])) as int) as twice from w""",
    "reviews",
)
def array_functions(spark, d):
    w = F.col("w")
    return reviews_view(spark, d).select("review_id", F.split("review_text", " ").alias("w")).select(
        "review_id",
        F.array_join(F.slice(w, 1, 2), " ").alias("head"),
        F.exists(w, lambda x: F.length(x) > 4).alias("has_long"),
        F.size(F.filter(w, lambda x: F.length(x) > 3)).alias("n_long"),
        F.element_at(w, -1).alias("last_word"),
        F.array_join(F.transform(w, lambda x: F.substring(x, 1, 1)), "").alias("initials"),
        F.aggregate(w, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x)).alias("n_letters"),
        F.size(F.flatten(F.array(w, w))).alias("twice"),
    )


@query(
    """select event_id, case when value > 100 then 'big' when value > 10 then 'mid' else 'small' end as size_band,
         coalesce(case event_type when 'view' then 'seen' when 'purchase' then 'bought' end, event_type) as mapped from events"""
)
def conditional_functions(spark, d):
    v, kind = F.col("value"), F.col("event_type")
    words = F.create_map(F.lit("view"), F.lit("seen"), F.lit("purchase"), F.lit("bought"))
    return table(spark, d, "events").select(
        "event_id",
        F.when(v > 100, "big").when(v > 10, "mid").otherwise("small").alias("size_band"),
        F.coalesce(F.try_element_at(words, kind), kind).alias("mapped"),
    )


@query(
    """select event_id, cast(json_extract_string(props, '$.k') as int) as k,
         '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' as doc from events"""
)
def json_functions(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("doc"),
    )


@query(
    """select o_orderkey, printf('%.1f%%', o_totalprice / 1e6 * 100) as share, format('{:,.2f}', o_totalprice) as grouped,
         '₹' || format('{:,.0f}', round_even(o_totalprice, 0)) as money from orders"""
)
def number_formatting(spark, d):
    from cohortry.functions import as_percent, fixed, format_money

    p = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", as_percent(p / 1e6).alias("share"), fixed(p, 2, grouped=True).alias("grouped"), format_money(p).alias("money")
    )


@query(
    """select customer_id, coalesce(tenure_days, 0) as tenure_days, coalesce(email_open_rate, (select median(email_open_rate) from v_customers)) as email_open_rate,
         round(monthly_spend_inr / nullif(total_orders, 0), 6) as per_order from v_customers""",
    "customers",
)
def null_functions(spark, d):
    from cohortry.operators.ordering import exact_medians

    view = customers_view(spark, d)
    mid = exact_medians(view, ["email_open_rate"]).scalar()
    return view.select(
        "customer_id",
        F.coalesce("tenure_days", F.lit(0)).alias("tenure_days"),
        F.coalesce("email_open_rate", mid).alias("email_open_rate"),
        F.round(ratio(F.col("monthly_spend_inr"), F.col("total_orders")), 6).alias("per_order"),
    )
