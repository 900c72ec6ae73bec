"""Explicit DDL schemas of the domain tables (CSV inference costs a full extra pass)."""

from __future__ import annotations

CUSTOMERS = """customer_id string, name string, email string, city string, state string, signup_date date,
    tenure_days int, monthly_spend_inr double, total_orders int, avg_order_value double,
    support_tickets int, last_login_days_ago int, email_open_rate double, app_sessions_monthly int,
    preferred_category string, payment_method string, churned int"""

REVIEWS = """review_id string, customer_id string, product_id string, category string, rating int,
    review_text string, sentiment_label string, review_date string, helpful_votes int,
    verified_purchase boolean"""

AB_EVENTS = """event_id string, customer_id string, experiment_name string, `group` string,
    `timestamp` timestamp, page_views int, time_on_page_sec double, converted int,
    revenue_inr double, device string, source string"""

FEATURE_STORE = (
    CUSTOMERS
    + """, spend_per_order double, tickets_per_order double, recency_score double,
    engagement_score double, high_value_flag int, tenure_segment string"""
)

CHURN_PREDICTIONS = """churn_probability double, predicted_class int, risk_level string, true_label int"""

DOMAIN = {
    "customers": CUSTOMERS,
    "reviews": REVIEWS,
    "ab_events": AB_EVENTS,
    "feature_store": FEATURE_STORE,
    "churn_predictions": CHURN_PREDICTIONS,
}
