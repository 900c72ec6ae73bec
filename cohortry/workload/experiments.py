"""Experiment statistics and hypothesis tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from cohortry.functions import tails
from cohortry.operators import bayes, experiments, hypothesis
from cohortry.sources.tables import ab_events_view, table
from cohortry.workload.base import p_chi2, p_f, p_normal, p_normal_upper, p_t, query
from cohortry.workload.cleaning import clean_events

Z = NormalDist().inv_cdf
CRIT = repr(Z(0.975))


def totals_sql(keys: str, source: str = "s_events") -> str:
    return f"""totals as (select {keys}, count(case when "group" = 'control' then 1 end) as nc, coalesce(sum(case when "group" = 'control' then converted end), 0)::bigint as xc,
        count(case when "group" = 'treatment' then 1 end) as nt, coalesce(sum(case when "group" = 'treatment' then converted end), 0)::bigint as xt
      from {source} group by {keys})"""


def z_sql(keys: str, source: str = "totals") -> str:
    return f"""rates as (select *, xc::double / nullif(nc, 0) as pc, xt::double / nullif(nt, 0) as pt, (xc + xt)::double / nullif(nc + nt, 0) as pp from {source}),
      zed as (select *, pt - pc as diff, (pt - pc) / nullif(sqrt(pp * (1 - pp) * (1.0::double / nullif(nc, 0) + 1.0::double / nullif(nt, 0))), 0) as z,
        sqrt(pc * (1 - pc) / nc + pt * (1 - pt) / nt) as spread from rates)"""


def test_select(p: str, flag: str) -> str:
    return f"""nc as control_n, xc as control_conversions, nt as treatment_n, xt as treatment_conversions, 'Two-Proportion Z-Test' as test_type,
      round(pc, 6) as control_cvr, round(pt, 6) as treatment_cvr, round(diff, 6) as absolute_lift,
      round(case when pc > 0 then diff / pc when pc = 0 then 0 end, 4) as relative_lift, round(z, 4) as z_statistic, round({p}, 6) as p_value,
      0.05::double as alpha, coalesce({flag}, false) as significant,
      case when {flag} then '{experiments.SIGNIFICANT}' else '{experiments.NOT_SIGNIFICANT}' end as significance_label,
      round(diff - {CRIT} * spread, 6) as ci_lower, round(diff + {CRIT} * spread, 6) as ci_upper, '95%' as ci_level"""


@query(
    f"with {totals_sql('experiment_name')}, {z_sql('experiment_name')} select experiment_name, {test_select(p_normal('z'), f'abs(z) > {CRIT}')} from zed",
    "events clean_events",
)
def experiment_conversion_test(spark, d):
    return experiments.conversion_test(clean_events(spark, d))


@query(
    f"with {totals_sql('experiment_name, source')}, {z_sql('experiment_name')} select experiment_name, source, {test_select(p_normal_upper('z'), f'z > {Z(0.95)!r}')} from zed",
    "events clean_events",
)
def one_sided_test_by_source(spark, d):
    return experiments.conversion_test(clean_events(spark, d), ["experiment_name", "source"], two_sided=False)


@query(
    f"""with {totals_sql('experiment_name')}, n as (select *, xc::double / nc as p1, xc::double / nc + 0.03 as p2 from totals),
         h as (select *, ceil(2 * {(Z(0.975) + Z(0.8)) ** 2!r} / pow(2 * asin(sqrt(p2)) - 2 * asin(sqrt(p1)), 2))::bigint as need from n)
       select experiment_name, round(p1, 6) as baseline_rate, need as n_per_group, nc as control_n, nt as treatment_n, least(nc, nt) >= need as enough from h""",
    "events clean_events",
)
def sample_size_check(spark, d):
    out = experiments.sample_size_check(clean_events(spark, d))
    return out.withColumn("baseline_rate", F.round("baseline_rate", 6))


@query(
    f"""with p as (select l_linenumber, l_returnflag, avg(case when l_discount > 0.05 then 1.0::double else 0.0::double end) as b from lineitem group by all),
         h as (select *, ceil(2 * {(Z(0.975) + Z(0.8)) ** 2!r} / pow(2 * asin(sqrt(b + 0.02)) - 2 * asin(sqrt(b)), 2))::bigint as need from p)
       select l_linenumber, l_returnflag, round(b, 6) as baseline_rate, round(b + 0.02, 6) as treatment_rate, 0.02::double as mde_absolute,
         round(0.02::double / b, 4) as mde_relative, 0.05::double as alpha, 0.8::double as power, need as n_per_group, need * 2 as n_total from h"""
)
def sample_size_plan(spark, d):
    rates = table(spark, d, "lineitem").groupBy("l_linenumber", "l_returnflag").agg(
        F.avg(F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0)).alias("baseline_rate")
    )
    out = experiments.sample_size(rates.withColumn("mde", F.lit(0.02)))
    return out.withColumns({c: F.round(c, 6) for c in ("baseline_rate", "treatment_rate")})


def stats_sql(prefix: str, value: str, extra: str = "") -> str:
    out = []
    for arm, s in (("control", "c"), ("treatment", "t")):
        v = f"""case when "group" = '{arm}'{extra} then {value} end"""
        out.append(f"count({v})::double as {prefix}n{s}, avg({v}) as {prefix}m{s}, var_samp({v}) as {prefix}v{s}, stddev_pop({v}) as {prefix}s{s}")
    return ", ".join(out)


def welch_sql(p: str = "") -> str:
    """Columns t and v (degrees of freedom) and effect size over the columns of ``stats_sql``."""
    sc, st = f"{p}vc / {p}nc", f"{p}vt / {p}nt"
    return f"""({p}mt - {p}mc) / nullif(sqrt({sc} + {st}), 0) as {p}t,
      pow({sc} + {st}, 2) / nullif(pow({sc}, 2) / nullif({p}nc - 1, 0) + pow({st}, 2) / nullif({p}nt - 1, 0), 0) as {p}v,
      ({p}mt - {p}mc) / (sqrt(({p}sc * {p}sc + {p}st * {p}st) / 2) + 1e-9) as {p}d"""


@query(
    f"""with a as (select experiment_name, device, {stats_sql('', 'page_views::double')} from s_events group by all),
         b as (select *, {welch_sql()} from a), c as (select *, {p_t('t', 'v')} as p from b)
       select experiment_name, device, 'Welch''s t-Test' as test_type, 'page_views' as metric, round(mc, 4) as control_mean, round(mt, 4) as treatment_mean,
         round((mt - mc) / (mc + 1e-9), 4) as relative_lift, round(t, 4) as t_statistic, round(v, 4) as df, round(p, 6) as p_value, round(d, 4) as cohens_d,
         case when abs(d) < 0.2 then 'small' when abs(d) < 0.5 then 'medium' when d is not null then 'large' end as effect_size, coalesce(p < 0.05, false) as significant,
         case when p < 0.05 then '{experiments.SIGNIFICANT}' else '{experiments.NOT_SIGNIFICANT}' end as significance_label, 0.05::double as alpha from c""",
    "events clean_events",
)
def welch_page_views_by_device(spark, d):
    return experiments.continuous_test(clean_events(spark, d), "page_views", ["experiment_name", "device"])


REPORT_COLUMNS = [
    "experiment_name", "control_n", "treatment_n", "control_cvr", "treatment_cvr", "uplift", "p_value", "significant",
    "significance_label", "ci_lower", "ci_upper", "revenue_impact", "revenue_impact_aov",
]


def report_sql(source: str) -> str:
    return f"""a as (select experiment_name, count(case when "group" = 'control' then 1 end) as nc, sum(case when "group" = 'control' then converted end)::bigint as xc,
           count(case when "group" = 'treatment' then 1 end) as nt, sum(case when "group" = 'treatment' then converted end)::bigint as xt,
           {stats_sql('u', 'revenue_inr')}, {stats_sql('o', 'revenue_inr', ' and converted = 1')} from {source} group by experiment_name),
         {z_sql('experiment_name', 'a')}, b as (select *, {welch_sql('u')}, {welch_sql('o')} from zed),
         e as (select *, {p_normal('z')} as p, {p_t('ut', 'uv')} as up, {p_t('ot', 'ov')} as op, onc > 10 and ont > 10 as enough from b)
       select experiment_name, nc as control_n, nt as treatment_n, round(pc, 6) as control_cvr, round(pt, 6) as treatment_cvr, round(diff / pc, 4) as uplift,
         round(p, 6) as p_value, coalesce(abs(z) > {CRIT}, false) as significant, case when abs(z) > {CRIT} then '{experiments.SIGNIFICANT}' else '{experiments.NOT_SIGNIFICANT}' end as significance_label,
         round(diff - {CRIT} * spread, 6) as ci_lower, round(diff + {CRIT} * spread, 6) as ci_upper,
         round(round(diff, 6) * (nc / 60.0::double * 30.0::double) * round(umt, 4), 2) as revenue_impact,
         case when enough then round(round(diff, 6) * (nc / 60.0::double * 30.0::double) * round(omt, 4), 2) end as revenue_impact_aov,
         round(ut, 4) as revenue_t, round(up, 6) as revenue_p, round(ud, 4) as revenue_d, round(umc, 4) as revenue_control_mean, round(umt, 4) as revenue_treatment_mean,
         case when enough then round(ot, 4) end as order_t, case when enough then round(op, 6) end as order_p, case when enough then round(omt, 4) end as order_treatment_mean from e"""


def flat_report(report):
    r, o = "revenue_test.", "aov_test."
    return report.select(
        *REPORT_COLUMNS,
        F.col(r + "t_statistic").alias("revenue_t"),
        F.col(r + "p_value").alias("revenue_p"),
        F.col(r + "cohens_d").alias("revenue_d"),
        F.col(r + "control_mean").alias("revenue_control_mean"),
        F.col(r + "treatment_mean").alias("revenue_treatment_mean"),
        F.col(o + "t_statistic").alias("order_t"),
        F.col(o + "p_value").alias("order_p"),
        F.col(o + "treatment_mean").alias("order_treatment_mean"),
    )


@query("with " + report_sql("s_events"), "events clean_events")
def experiment_report(spark, d):
    return flat_report(experiments.experiment_report(clean_events(spark, d)))


@query(
    """with u as (select experiment_name, "group", customer_id, max(converted) as converted, sum(revenue_inr) as revenue_inr from s_events group by all), """
    + report_sql("u"),
    "events clean_events",
)
def experiment_report_by_customer(spark, d):
    return flat_report(experiments.experiment_report(clean_events(spark, d), unit="customer"))


@query(
    """with s as (select source, device, customer_id, max(case when "group" = 'control' then 1 else 0 end) as c, max(case when "group" = 'treatment' then 1 else 0 end) as t
         from (select * replace (case when event_id % 2 = 0 then 'control' else 'treatment' end as "group") from v_events) group by all)
       select source, device, count(*) as customers, count(case when c = 1 and t = 1 then 1 end) as in_both_arms from s group by all""",
    "events",
)
def arm_contamination(spark, d):
    events = ab_events_view(spark, d).withColumn("group", F.when(F.col("event_id") % 2 == 0, "control").otherwise("treatment"))
    return experiments.arm_contamination(events, ["source", "device"])


def bayes_sql(keys: str, interval: bool = False, outer: int = 240, inner: int = 400) -> str:
    """Treatment rates on an even grid of 12 deviations each way, the control's distribution by Simpson's rule up to each."""
    density = lambda y, a, b: f"(case when {y} <= 0 or {y} >= 1 then 0 else exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + ({a} - 1) * ln({y}) + ({b} - 1) * ln(1 - {y})) end)"

    def upto(x: str, factor: str = "1.0") -> str:
        """Integral of the control's density times ``factor`` (in y) up to ``x``."""
        y = f"(low + (least(greatest({x}, low), 1.0) - low) * k / {inner}.0)"
        weight = f"(case when k = 0 or k = {inner} then 1 when k % 2 = 1 then 4 else 2 end)"
        body = f"list_transform([{y}], lambda y: {factor} * {density('y', 'ac', 'bc')})[1]"
        return f"(list_sum(list_transform(range(0, {inner + 1}), lambda k: {weight} * {body})) * (least(greatest({x}, low), 1.0) - low) / {inner}.0 / 3.0)"

    lists = f"""list_transform(range(0, {outer + 1}), lambda i: mt + (i - {outer // 2}) * st * 24.0 / {outer}.0)"""
    share = f"list_sum(list_transform(range(1, {outer + 2}), lambda i: ws[i] * (1 - {upto('(xs[i] - (r[1] + r[2]) / 2)')})))"
    root = lambda q: f"""list_reduce(list_transform(range(0, 40), lambda h: [mt - mc - 12 * sqrt(sc * sc + st * st), mt - mc + 12 * sqrt(sc * sc + st * st)]),
        lambda r, e: case when {share} < {q} then [(r[1] + r[2]) / 2, r[2]] else [r[1], (r[1] + r[2]) / 2] end)"""  # noqa: E731
    bounds = f""", case when win is not null then list_transform([{root('0.025')}], lambda r: round((r[1] + r[2]) / 2, 6))[1] end as credible_lower,
      case when win is not null then list_transform([{root('0.975')}], lambda r: round((r[1] + r[2]) / 2, 6))[1] end as credible_upper"""
    return f"""ab as (select {keys}, 1.0::double + xc as ac, 1.0::double + nc - xc as bc, 1.0::double + xt as a_t, 1.0::double + nt - xt as b_t from totals),
      m as (select *, ac / (ac + bc) as mc, a_t / (a_t + b_t) as mt from ab),
      sd as (select *, sqrt(mc * (1 - mc) / (ac + bc + 1)) as sc, sqrt(mt * (1 - mt) / (a_t + b_t + 1)) as st from m),
      g as (select *, greatest(mc - 12 * sc, 0.0) as low, {lists} as xs from sd),
      w as (select *, list_transform(xs, lambda x: {density('x', 'a_t', 'b_t')} * st * 24.0 / {outer}.0) as ws from g),
      r as (select *, list_sum(list_transform(range(1, {outer + 2}), lambda i: ws[i] * {upto('xs[i]')})) as win,
              list_sum(list_transform(range(1, {outer + 2}), lambda i: ws[i] * (mc - xs[i] + {upto('xs[i]', '(xs[i] - y)')}))) as loss from w)
    select {keys}, round(win, 4) as prob_treatment_better, round(1 - win, 4) as prob_control_better, round(mt - mc, 6) as expected_lift,
      round(loss, 6) as expected_loss_if_treatment,
      case when win > 0.95 then 'Ship Treatment ✓' when win > 0.8 then 'Continue Testing' else 'Keep Control' end as recommendation{bounds if interval else ''} from r"""


BAYES = ["prob_treatment_better", "prob_control_better", "expected_lift", "expected_loss_if_treatment", "recommendation"]


@query(f"with {totals_sql('experiment_name')}, {bayes_sql('experiment_name')}", "events clean_events")
def bayes_test(spark, d):
    return bayes.bayes_test(experiments.arm_totals(clean_events(spark, d))).select("experiment_name", *BAYES)


@query(f"with {totals_sql('experiment_name, device, source')}, {bayes_sql('experiment_name, device, source')}", "events clean_events")
def bayes_test_by_segment(spark, d):
    keys = ["experiment_name", "device", "source"]
    return bayes.bayes_test(experiments.arm_totals(clean_events(spark, d), keys)).select(*keys, *BAYES)


@query(f"with {totals_sql('experiment_name')}, {bayes_sql('experiment_name', interval=True)}", "events clean_events")
def bayes_credible_interval(spark, d):
    totals = experiments.arm_totals(clean_events(spark, d))
    return bayes.bayes_report(totals).select("experiment_name", *BAYES, "credible_lower", "credible_upper")


def chi_sql(keys: str, source: str, row: str, col: str) -> str:
    """Dense-grid form with the continuity correction at one degree of freedom."""
    k = f"{keys}, " if keys else ""
    on = f"using ({keys})" if keys else "on true"
    by = f"group by {keys}" if keys else ""
    part = lambda extra: f"partition by {k}{extra}"
    return f"""with cells as (select {k}{row} as r, {col} as c, count(*) as o from {source} where {row} is not null and {col} is not null group by all),
      rs as (select distinct {k}r from cells), cs as (select distinct {k}c from cells),
      grid as (select {k}rs.r, cs.c, coalesce(o, 0)::double as o from rs join cs {on} left join cells using ({k}r, c)),
      marg as (select *, sum(o) over ({part('r')}) * sum(o) over ({part('c')}) / sum(o) over ({f'partition by {keys}' if keys else ''}) as e from grid),
      dof as (select {k}(count(distinct r) - 1) * (count(distinct c) - 1) as dof from grid {by}),
      chi as (select {k}dof, sum(case when dof = 1 then pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e else pow(o - e, 2) / e end) as chi from marg join dof {on} group by {k}dof),
      pv as (select *, case when dof = 0 then 1 else {p_chi2('chi', 'dof')} end as p from chi)
    select {k}'Chi-Square Independence Test' as test, round(chi, 4) as chi2_statistic, round(p, 6) as p_value, dof as degrees_of_freedom, p < 0.05 as significant,
      case when p < 0.05 then 'Variables are dependent' else 'Variables are independent' end as interpretation from pv"""


@query(chi_sql("", "labels", "quality", "toxic"))
def chi_square_quality_toxic(spark, d):
    return hypothesis.chi_square(table(spark, d, "labels"), "quality", "toxic")


@query(chi_sql("experiment_name", "v_events", "device", "source"), "events")
def chi_square_device_source(spark, d):
    return hypothesis.chi_square(ab_events_view(spark, d), "device", "source", ["experiment_name"])


@query(chi_sql("", "documents", "lang", "source"))
def chi_square_language_source(spark, d):
    return hypothesis.chi_square(table(spark, d, "documents"), "lang", "source")


def anova_sql(keys: str, source: str, factor: str, value: str) -> str:
    k = f"{keys}, " if keys else ""
    over = f"over (partition by {keys})" if keys else "over ()"
    by = f"group by {keys}" if keys else ""
    return f"""with lv as (select {k}{factor} as lvl, count({value}) as n, avg({value}) as m, var_samp({value}) as v from {source} group by {k}{factor} having count({value}) > 30),
      gm as (select *, sum(n * m) {over} / sum(n) {over} as grand from lv),
      s as (select {k}string_agg(lvl || ': ' || printf('%.4f', m), ', ' order by lvl) as group_means, count(*) as k, sum(n)::bigint as total, sum(n * pow(m - grand, 2)) as ssb, sum((n - 1) * v) as ssw from gm {by}),
      f as (select *, k - 1 as d1, total - k as d2, (ssb / (k - 1)) / (ssw / (total - k)) as f from s),
      pv as (select *, {p_f('f', 'd1', 'd2')} as p from f)
    select {k}'One-Way ANOVA' as test, k as n_groups, group_means, round(f, 4) as f_statistic, d1 as df_between, d2 as df_within, round(p, 6) as p_value, p < 0.05 as significant,
      case when p < 0.05 then 'At least one group mean differs significantly' else 'No significant difference between groups' end as interpretation from pv"""


@query(anova_sql("", "s_events", "device", "revenue_inr"), "events clean_events")
def anova_revenue_by_device(spark, d):
    return hypothesis.anova(clean_events(spark, d), "device", "revenue_inr")


@query(anova_sql("o_orderstatus", "orders", "o_orderpriority", "o_totalprice"))
def anova_price_by_priority(spark, d):
    return hypothesis.anova(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", ["o_orderstatus"])


def pearson_sql(keys: str, source: str, x: str, y: str) -> str:
    k = f"{keys}, " if keys else ""
    by = f"group by {keys}" if keys else ""
    return f"""with c as (select {k}corr({x}, {y}) as r, count(*) as n from {source} where {x} is not null and {y} is not null {by}),
      t as (select *, r * sqrt(n - 2) / sqrt(1 - r * r) as t, n - 2 as v from c), p as (select *, {p_t('t', 'v')} as p from t),
      s as (select *, case when abs(r) > 0.7 then 'strong' when abs(r) > 0.4 then 'moderate' else 'weak' end as strength, case when r > 0 then 'positive' else 'negative' end as direction from p)
    select {k}'Pearson Correlation' as test, '{x} vs {y}' as variables, round(r, 4) as r, round(r * r, 4) as r_squared, round(p, 6) as p_value, p < 0.05 as significant,
      strength, direction, upper(strength[1]) || strength[2:] || ' ' || direction || ' correlation between {x} and {y}' as interpretation from s"""


@query(pearson_sql("", "s_events", "page_views", "revenue_inr"), "events clean_events")
def correlation_views_revenue(spark, d):
    return hypothesis.pearson(clean_events(spark, d), "page_views", "revenue_inr")


@query(pearson_sql("l_returnflag", "lineitem", "l_quantity", "l_extendedprice"))
def correlation_quantity_price(spark, d):
    return hypothesis.pearson(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])


def quantile_sql(p: str) -> str:
    """Inverse normal distribution by bisection on its integral would be slow; the same rational approximation as text."""
    poly = lambda x, cs: "(" + str(cs[0]) + "".join(f") * {x} + ({c})" for c in cs[1:])
    nested = lambda x, cs: "(" * (len(cs) - 1) + poly(x, cs)[1:]
    h = hypothesis
    q2, far = f"(({p} - 0.5) * ({p} - 0.5))", f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    centre = f"({nested(q2, h._CENTRE_TOP)}) * ({p} - 0.5) / ({nested(q2, h._CENTRE_BOTTOM)})"
    tail = f"({nested(far, h._TAIL_TOP)}) / ({nested(far, h._TAIL_BOTTOM)})"
    return f"case when {p} < {h._TAIL} then {tail} when {p} > 1 - {h._TAIL} then -({tail}) else {centre} end"


@query(
    f"""with r as (select l_returnflag, l_extendedprice::double as x, (row_number() over (partition by l_returnflag order by l_extendedprice) - 0.375::double) / (count(*) over (partition by l_returnflag) + 0.25::double) as p from lineitem),
         m as (select *, {quantile_sql('p')} as m from r),
         c as (select l_returnflag, count(*) as n, pow(covar_pop(m, x), 2) / (var_pop(m) * var_pop(x)) as w from m group by all),
         z as (select *, (ln(greatest(1 - w, 1e-300)) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) as z from c),
         p as (select *, {p_normal_upper('z')} as p from z)
       select l_returnflag, 'Shapiro-Francia' as test, 'l_extendedprice' as variable, n, round(w, 4) as statistic, round(p, 6) as p_value, p > 0.05 as normal,
         case when p > 0.05 then 'Normally distributed' else 'Not normally distributed' end as interpretation from p"""
)
def shapiro_normality(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return hypothesis.shapiro(rows, "l_extendedprice", ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query(
    """with m as (select l_returnflag, count(*) as n, avg(l_extendedprice) as a from lineitem group by all),
         c as (select l.l_returnflag, any_value(n) as n, avg(pow(l_extendedprice - a, 2)) as m2, avg(pow(l_extendedprice - a, 3)) as m3, avg(pow(l_extendedprice - a, 4)) as m4
               from lineitem l join m on l.l_returnflag = m.l_returnflag group by all),
         s as (select *, m3 / pow(m2, 1.5) as sk, m4 / (m2 * m2) - 3 as ku from c), j as (select *, n / 6.0::double * (sk * sk + ku * ku / 4) as jb from s)
       select l_returnflag, n, round(sk, 6) as skewness, round(ku, 6) as kurtosis, round(jb, 4) as statistic, round(exp(-jb / 2), 6) as p_value, exp(-jb / 2) > 0.05 as normal from j"""
)
def jarque_bera_normality(spark, d):
    return hypothesis.jarque_bera(table(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query(
    """with p as (select l_partkey, l_returnflag, round((sum(l_partkey * 7919 + l_linenumber * 104729) % 1000)::double / 1000.0 * 0.2, 4) as p from lineitem group by all),
         r as (select *, count(*) over w as m, rank() over o + count(*) over (partition by l_returnflag, p) - 1 as rk from p
               window w as (partition by l_returnflag), o as (partition by l_returnflag order by p))
       select l_partkey, l_returnflag, p, round(least(p * m, 1.0), 6) as p_bonferroni,
         round(least(min(p * m / rk) over (partition by l_returnflag order by p desc range between unbounded preceding and current row), 1.0), 6) as p_bh from r"""
)
def multiple_testing_correction(spark, d):
    """p-values of many tests (derived from the part/flag cells) corrected within each flag."""
    k = F.sum(F.col("l_partkey") * 7919 + F.col("l_linenumber") * 104729)
    tests = table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.round((k % 1000).cast("double") / 1000.0 * 0.2, 4).alias("p")
    )
    out = experiments.adjust_p_values(tests, "p", ["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("p_bonferroni", "p_bh")})


#: The design of each experiment: conversion rate before it and the smallest difference worth finding.
DESIGNS = {"exp_a": (0.2, 0.03), "exp_b": (0.2, 0.05), "exp_c": (0.2, 0.1)}


def normal_tail_sql(z: str) -> str:
    """P(Z >= z) by Hart's rational form; ``z`` is bound to a name first."""
    poly = lambda cs: " + x * (".join(repr(c) for c in cs) + ")" * (len(cs) - 1)
    far = "(x + 1.0 / (x + 2.0 / (x + 3.0 / (x + 4.0 / (x + 0.65)))))"
    half = f"exp(-0.5 * x * x) * (case when x < 7.07106781186547 then ({poly(tails.HART_TOP)}) / ({poly(tails.HART_BOTTOM)}) else 1.0 / {far} / sqrt(2 * pi()) end)"
    return f"list_transform([({z})::double], lambda z: list_transform([abs(z)], lambda x: case when z >= 0 then {half} else 1 - {half} end)[1])[1]"


def recursive_views(sql: str) -> str:
    """The first ``with`` of a statement that refers to itself."""
    return "with recursive " + sql.strip()[5:]


def monitor_sql(nodes: int = 300) -> str:
    """Looks and boundaries by a recursive table: one row a day, with the density on its own even grid by Simpson's rule."""
    designs = ", ".join(f"('{k}', {p}::double, {d}::double)" for k, (p, d) in DESIGNS.items())
    beyond = lambda c: f"(2 * list_sum(list_transform(range(1, len(xs) + 1), lambda i: ws[i] * ({normal_tail_sql(f'({c} - xs[i]) / s')} + {normal_tail_sql(f'({c} + xs[i]) / s')}))))"
    halved = f"""list_reduce(list_transform(range(0, 48), lambda k: [0.0::double, 8.0::double]), lambda a, e:
        case when {beyond('(a[1] + a[2]) / 2 * root')} > target then [(a[1] + a[2]) / 2, a[2]] else [a[1], (a[1] + a[2]) / 2] end)[2]"""
    spend = f"4 * {normal_tail_sql(f'{Z(1 - 0.05 / 4)!r} / sqrt(t)')}"
    return recursive_views(f"""with {totals_sql('experiment_name, "timestamp"::date as day').replace('group by experiment_name, "timestamp"::date as day', 'group by experiment_name, "timestamp"::date')},
      run as (select experiment_name, day, sum(nc) over w as nc, sum(xc) over w as xc, sum(nt) over w as nt, sum(xt) over w as xt
              from totals window w as (partition by experiment_name order by day)),
      {z_sql('experiment_name', 'run')},
      plan as (select experiment_name, 2 * ceil(2 * pow({Z(0.975)!r} + {Z(0.8)!r}, 2) / pow(2 * asin(sqrt(p + d)) - 2 * asin(sqrt(p)), 2))::bigint as planned_n
               from (values {designs}) as v(experiment_name, p, d)),
      days as (select *, least((nc + nt) / planned_n::double, 1.0) as frac, row_number() over (partition by experiment_name order by day) as d from zed join plan using (experiment_name)),
      walk as (
        select experiment_name, 0::bigint as d, 0.0::double as t, 0.0::double as spent, [0.0::double] as xs, [0.5::double] as ws, null::double as boundary, null::double as alpha_spent
          from (select distinct experiment_name from days)
        union all
        select experiment_name, d, t, case when looked then spent + lost else spent end, case when looked then ys else xs end,
          case when looked then list_transform(range(1, len(ys) + 1), lambda j: (case when j = 1 or j = len(ys) then 1 when j % 2 = 0 then 4 else 2 end) * c / {nodes}.0 / 3.0 / (s * sqrt(2 * pi()))
            * list_sum(list_transform(range(1, len(xs) + 1), lambda i: ws[i] * (exp(-0.5 * pow((ys[j] - xs[i]) / s, 2)) + exp(-0.5 * pow((ys[j] + xs[i]) / s, 2)))))) else ws end,
          case when looked then b end, case when looked then spent + lost end
        from (select *, b * root as c, {beyond('b * root')} as lost, list_transform(range(0, {nodes + 1}), lambda k: b * root * k / {nodes}.0) as ys
              from (select *, case when looked then {halved} else 1.0 end as b
                    from (select experiment_name, d, looked, spent, xs, ws, case when looked then now else t end as t, case when looked then sqrt(now - t) else 1.0 end as s,
                            sqrt(now) as root, case when looked then greatest(spend - spent, 0.0) end as target
                          from (select w.experiment_name, n.d, w.t, w.spent, w.xs, w.ws, n.frac as now, (n.frac - w.t >= 0.002 or (n.frac >= 1 and w.t < 1)) as looked,
                                  list_transform([n.frac], lambda t: {spend})[1] as spend
                                from walk w join days n on n.experiment_name = w.experiment_name and n.d = w.d + 1)))))
      select experiment_name, day, nc::bigint as control_n, xc::bigint as control_conversions, nt::bigint as treatment_n, xt::bigint as treatment_conversions, round(z, 4) as z_statistic,
        planned_n, round(frac, 6) as information_fraction, round(boundary, 4) as boundary, round(alpha_spent, 6) as alpha_spent,
        coalesce(abs(round(z, 4)) >= round(boundary, 4), false) as crossed,
        max(coalesce(abs(round(z, 4)) >= round(boundary, 4), false)) over (partition by experiment_name order by day) as stopped
      from days join walk using (experiment_name, d)""")


MONITOR_SQL = monitor_sql()


def experiment_plans(spark):
    designs = spark.createDataFrame([(k, *v) for k, v in DESIGNS.items()], "experiment_name string, baseline_rate double, mde double")
    return experiments.planned_sizes(designs)


@query(MONITOR_SQL, "events clean_events")
def sequential_monitor(spark, d):
    return experiments.sequential_monitor(clean_events(spark, d), experiment_plans(spark))


@query(
    f"""with {totals_sql('experiment_name, device, source')}, {z_sql('')}, p as (select *, {p_normal('z')} as p from zed),
         r as (select *, count(p) over (partition by experiment_name) as m, rank() over (partition by experiment_name order by p) + count(*) over (partition by experiment_name, p) - 1 as rk from p)
       select experiment_name, device, source, nc as control_n, xc as control_conversions, nt as treatment_n, xt as treatment_conversions, round(diff, 6) as absolute_lift,
         round(z, 4) as z_statistic, round(p, 6) as p_value, round(least(p * m, 1.0), 6) as p_bonferroni,
         round(least(min(p * m / rk) over (partition by experiment_name order by p desc range between unbounded preceding and current row), 1.0), 6) as p_bh from r""",
    "events clean_events",
)
def segment_scorecard(spark, d):
    out = experiments.segment_scorecard(clean_events(spark, d), ["device", "source"])
    return out.select(
        "experiment_name", "device", "source", "control_n", "control_conversions", "treatment_n", "treatment_conversions",
        "absolute_lift", "z_statistic", "p_value", F.round("p_bonferroni", 6).alias("p_bonferroni"), F.round("p_bh", 6).alias("p_bh"),
    )
