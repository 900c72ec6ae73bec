"""Query registry and the SQL forms of the derived views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortry.sources.tables import LABEL_DAY, PHRASES

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: str = "", name: str | None = None):
    """Register a query; ``views`` names the derived views its SQL reads (``events``, ``customers``, ``reviews``)."""

    def add(fn: Runner) -> Runner:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_views(sql, views.split())
        return fn

    return add


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def with_views(sql: str, names: list[str]) -> str:
    """Prefix the SQL with the named views; its own ``with`` clause is continued."""
    needed = [VIEWS[n] for n in names]
    if not needed:
        return sql
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(needed) + ",\n" + body[15:]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(needed) + ",\n" + body[5:]
    return "with " + ",\n".join(needed) + "\n" + body


V_EVENTS = """v_events as (
  select event_id, user_id as customer_id,
    case user_id % 3 when 0 then 'exp_a' when 1 then 'exp_b' else 'exp_c' end as experiment_name,
    case when user_id % 50 = 0 then 'holdout' when user_id % 2 = 0 then 'control' else 'treatment' end as "group",
    ts as "timestamp",
    cast(json_extract_string(props, '$.k') as int) % 15 + 1 as page_views,
    case when event_type = 'purchase' then 1 else 0 end as converted,
    case when event_type = 'purchase' then value when event_type = 'error' then -value else 0.0::double end as revenue_inr,
    case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device,
    case event_id % 5 when 0 then 'organic' when 1 then 'paid_search' when 2 then 'email' when 3 then 'social' else 'direct' end as source
  from events)"""

# Cleaned events: valid arms only, negative revenue set to 0.
S_EVENTS = """s_events as (
  select * replace (case when revenue_inr < 0 then 0.0::double else revenue_inr end as revenue_inr)
  from (select *, row_number() over (partition by event_id order by "timestamp") as rn from v_events)
  where rn = 1 and "group" in ('control', 'treatment'))"""

V_CUSTOMERS = f"""v_customers as (
  select c_custkey as customer_id, c_name as name, n_name as state, c_mktsegment as preferred_category,
    cast(h.f as date) as signup_date,
    cast(date_diff('day', cast(h.f as date), date '{LABEL_DAY}') as int) as tenure_days,
    c_acctbal as monthly_spend_inr, coalesce(h.n, 0) as total_orders, coalesce(e.err, 0) as support_tickets,
    cast(date_diff('day', cast(h.l as date), date '{LABEL_DAY}') as int) as last_login_days_ago,
    h.fr as email_open_rate, coalesce(e.vw, 0) as app_sessions_monthly,
    case when o.later_n = 0 then 1 else 0 end as churned
  from customer join nation on c_nationkey = n_nationkey
  left join (select o_custkey, sum(case when o_orderdate >= timestamp '{LABEL_DAY}' then 1 else 0 end) as later_n
             from orders group by o_custkey) o on c_custkey = o.o_custkey
  left join (select o_custkey, count(*) as n, min(o_orderdate) as f, max(o_orderdate) as l,
               avg(case when o_orderstatus = 'F' then 1.0::double else 0.0::double end) as fr
             from orders where o_orderdate < timestamp '{LABEL_DAY}' group by o_custkey) h on c_custkey = h.o_custkey
  left join (select user_id, cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as err,
               cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) as vw
             from events group by user_id) e on c_custkey = e.user_id)"""

# Cleaned customers: spend clamped, state trimmed, rows without spend, orders or label dropped.
S_CUSTOMERS = """s_customers as (
  select * replace (case when monthly_spend_inr < 0 then 0.0::double else monthly_spend_inr end as monthly_spend_inr,
                    trim(state) as state)
  from v_customers where customer_id is not null and monthly_spend_inr is not null and churned is not null)"""

V_REVIEWS = f"""v_reviews as (
  select o_orderkey as review_id, o_custkey as customer_id, o_orderpriority as category,
    cast(o_orderkey % 7 as int) as rating,
    ([{text_list(PHRASES)}])[cast(o_orderkey * 7 % 12 as int) + 1] as review_text,
    case o_orderstatus when 'F' then 'positive' when 'O' then 'negative' else 'neutral' end as sentiment_label,
    o_orderdate as review_date, o_custkey % 2 = 0 as verified_purchase
  from orders)"""

# Scored customers: a rounded logistic score, so that equal scores occur.
V_SCORED = """v_scored as (
  select customer_id, preferred_category, monthly_spend_inr, churned,
    round(1.0::double / (1.0::double + exp(-(coalesce(last_login_days_ago, 600) - 300) / 200.0::double)), 3) as p
  from v_customers)"""

VIEWS = {
    "events": V_EVENTS,
    "clean_events": S_EVENTS,
    "customers": V_CUSTOMERS,
    "clean_customers": S_CUSTOMERS,
    "reviews": V_REVIEWS,
    "scored": V_SCORED,
}


# ---------------------------------------------------------------- tail probabilities by Simpson's rule


def _simpson(upper: str, body: str, steps: int = 2000) -> str:
    """Integral of ``body`` (in y) from 0 to ``upper``."""
    return (
        f"(list_sum(list_transform(range(0, {steps + 1}), lambda k: "
        f"(case when k = 0 or k = {steps} then 1 when k % 2 = 1 then 4 else 2 end) * "
        f"{body.replace('{y}', f'(({upper}) * k / {steps}.0)')})) * ({upper}) / {steps}.0 / 3.0)"
    )


def p_normal(z: str) -> str:
    return f"case when {z} is not null then 1 - 2 * {_simpson(f'least(abs({z}), 40.0)', 'exp(-0.5 * {y} * {y})')} / sqrt(2 * pi()) end"


def p_normal_upper(z: str) -> str:
    return f"(case when {z} >= 0 then {p_normal(z)} / 2 else 1 - {p_normal(z)} / 2 end)"


def p_t(t: str, df: str) -> str:
    body = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0) - ({df} + 1) / 2.0 * ln(1 + {{y}} * {{y}} / {df}))"
    return f"(1 - 2 * {_simpson(f'least(abs({t}), 60.0)', body)} / sqrt({df} * pi()))"


def p_f(f: str, d1: str, d2: str) -> str:
    front = f"lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0) + {d1} / 2.0 * ln({d1} / ({d2} * 1.0))"
    body = f"2 * pow({{y}}, {d1} - 1) * exp({front} - ({d1} + {d2}) / 2.0 * ln(1 + {d1} * {{y}} * {{y}} / ({d2} * 1.0)))"
    return f"(1 - {_simpson(f'sqrt({f})', body)})"


def p_chi2(x: str, k: str) -> str:
    body = f"2 * pow({{y}}, {k} - 1) * exp(-{{y}} * {{y}} / 2 - {k} / 2.0 * ln(2.0) - lgamma({k} / 2.0))"
    return f"(1 - {_simpson(f'sqrt({x})', body)})"
