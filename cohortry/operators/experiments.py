"""Experiment analysis: every test is one conditional aggregate plus closed-form columns.

An experiment, or an (experiment, segment) pair, is one row of the result, so thousands of
experiments are analysed by the same job as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.scalars import ratio
from cohortry.functions.tails import normal_two_sided, normal_upper, t_two_sided
from cohortry.operators.ordering import match, range_pieces
from cohortry.operators.sequential import running, with_boundaries
from cohortry.session import settle

SIGNIFICANT, NOT_SIGNIFICANT = "STATISTICALLY SIGNIFICANT ✓", "NOT SIGNIFICANT ✗"


def z_quantile(q: float) -> float:
    return NormalDist().inv_cdf(q)


def _label(flag: Column) -> Column:
    return F.when(flag, SIGNIFICANT).otherwise(NOT_SIGNIFICANT)


# ---------------------------------------------------------------- sample size


def required_per_arm(baseline: Column, mde: Column, alpha: float = 0.05, power: float = 0.80) -> Column:
    """Users per arm for a two-sided two-proportion test on the arcsine effect size."""
    p1, p2 = baseline.cast("double"), (baseline + mde).cast("double")
    h = 2.0 * F.asin(F.sqrt(p2)) - 2.0 * F.asin(F.sqrt(p1))
    z = z_quantile(1 - alpha / 2) + z_quantile(power)
    n = F.ceil(F.try_divide(F.lit(2.0 * z * z), h * h))
    return F.when((p1 >= 0) & (p2 <= 1), n).cast("bigint")


def sample_size(
    df: DataFrame, baseline: str = "baseline_rate", mde: str = "mde", alpha: float = 0.05, power: float = 0.80
) -> DataFrame:
    """Sample-size plan per row of (baseline rate, absolute minimum detectable effect)."""
    n = required_per_arm(F.col(baseline), F.col(mde), alpha, power)
    others = [c for c in df.columns if c not in (baseline, mde)]
    return df.select(
        *others,
        F.col(baseline).alias("baseline_rate"),
        (F.col(baseline) + F.col(mde)).alias("treatment_rate"),
        F.col(mde).alias("mde_absolute"),
        F.round(ratio(F.col(mde), F.col(baseline)), 4).alias("mde_relative"),
        F.lit(alpha).alias("alpha"),
        F.lit(power).alias("power"),
        n.alias("n_per_group"),
        (n * 2).alias("n_total"),
    )


def sample_size_check(
    events: DataFrame,
    keys: Sequence[str] = ("experiment_name",),
    baseline: float | None = None,
    mde: float = 0.03,
    alpha: float = 0.05,
    power: float = 0.80,
) -> DataFrame:
    """Users needed per arm against users seen; the baseline is the control rate unless given."""
    totals = arm_totals(events, keys)
    rate = F.lit(float(baseline)) if baseline is not None else ratio(F.col("control_conversions"), F.col("control_n"))
    need = required_per_arm(rate, F.lit(mde), alpha, power)
    return totals.select(
        *keys,
        rate.alias("baseline_rate"),
        need.alias("n_per_group"),
        "control_n",
        "treatment_n",
        F.coalesce(F.least("control_n", "treatment_n") >= need, F.lit(False)).alias("enough"),
    )


# ---------------------------------------------------------------- arm statistics


def _arm(name: str) -> Column:
    return F.col("group") == name


def arm_totals(events: DataFrame, keys: Sequence[str] = ("experiment_name",)) -> DataFrame:
    """One row per key: users and conversions of both arms."""
    cols = []
    for a in ("control", "treatment"):
        cols.append(F.count_if(_arm(a)).alias(f"{a}_n"))
        cols.append(F.coalesce(F.sum(F.when(_arm(a), F.col("converted"))), F.lit(0)).alias(f"{a}_conversions"))
    return events.groupBy(*keys).agg(*cols)


def metric_aggregates(prefix: str, value: Column, condition: Column | None = None) -> list[Column]:
    """n, mean, sample variance and population deviation of a metric in each arm."""
    out = []
    for a in ("control", "treatment"):
        v = F.when(_arm(a) if condition is None else _arm(a) & condition, value)
        out += [
            F.count(v).alias(f"{prefix}_{a}_n"),
            F.avg(v).alias(f"{prefix}_{a}_mean"),
            F.var_samp(v).alias(f"{prefix}_{a}_var"),
            F.stddev_pop(v).alias(f"{prefix}_{a}_std"),
        ]
    return out


# ---------------------------------------------------------------- two proportions


def two_proportion_test(totals: DataFrame, alpha: float = 0.05, two_sided: bool = True, exact: str | None = None) -> DataFrame:
    """z-test on rows holding ``control_n``, ``control_conversions``, ``treatment_n``, ``treatment_conversions``.

    ``exact`` names a further column for the p-value before rounding. No conversions at all, or a missing arm, gives nulls and no flag. Shared terms become columns of
    their own before they are reused, so the expression tree stays small.
    """
    number = lambda c: F.col(c).cast("double")
    nc, nt, xc, xt = (number(c) for c in ("control_n", "treatment_n", "control_conversions", "treatment_conversions"))
    rates = totals.withColumns(
        {"_pc": F.try_divide(xc, nc), "_pt": F.try_divide(xt, nt), "_pp": F.try_divide(xc + xt, nc + nt)}
    )
    pc, pt, pp = F.col("_pc"), F.col("_pt"), F.col("_pp")
    se = F.sqrt(pp * (1.0 - pp) * (F.try_divide(F.lit(1.0), nc) + F.try_divide(F.lit(1.0), nt)))
    spread = F.sqrt(F.try_divide(pc * (1.0 - pc), nc) + F.try_divide(pt * (1.0 - pt), nt))
    staged = rates.withColumns({"_z": F.try_divide(pt - pc, se), "_d": pt - pc, "_w": spread})
    z, diff = F.col("_z"), F.col("_d")
    margin = z_quantile(1 - alpha / 2)
    flag = F.abs(z) > margin if two_sided else z > z_quantile(1 - alpha)
    flag = F.coalesce(flag, F.lit(False))
    return staged.select(
        *totals.columns,
        F.lit("Two-Proportion Z-Test").alias("test_type"),
        F.round(pc, 6).alias("control_cvr"),
        F.round(pt, 6).alias("treatment_cvr"),
        F.round(diff, 6).alias("absolute_lift"),
        F.round(F.when(pc > 0, diff / pc).when(pc == 0, 0.0), 4).alias("relative_lift"),
        F.round(z, 4).alias("z_statistic"),
        F.round(normal_two_sided(z) if two_sided else normal_upper(z), 6).alias("p_value"),
        F.lit(alpha).alias("alpha"),
        flag.alias("significant"),
        _label(flag).alias("significance_label"),
        F.round(diff - margin * F.col("_w"), 6).alias("ci_lower"),
        F.round(diff + margin * F.col("_w"), 6).alias("ci_upper"),
        F.lit(f"{(1 - alpha) * 100:.6g}%").alias("ci_level"),
        *([(normal_two_sided(z) if two_sided else normal_upper(z)).alias(exact)] if exact else []),
    )


def conversion_test(
    events: DataFrame, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05, two_sided: bool = True, exact: str | None = None
) -> DataFrame:
    return two_proportion_test(arm_totals(events, keys), alpha, two_sided, exact)


# ---------------------------------------------------------------- means


WELCH_FIELDS = (
    "test_type", "metric", "control_mean", "treatment_mean", "relative_lift", "t_statistic", "df", "p_value",
    "cohens_d", "effect_size", "significant", "significance_label", "alpha",
)


def add_welch_test(stats: DataFrame, prefix: str, out: str, alpha: float = 0.05) -> DataFrame:
    """Add Welch's t-test as struct ``out``, from the columns of ``metric_aggregates``.

    Cohen's d uses the population deviations. Statistic, degrees of freedom and p-value are staged as
    columns so that none is expanded inside the next.
    """
    g = lambda a, s: F.col(f"{prefix}_{a}_{s}").cast("double")
    mc, mt = g("control", "mean"), g("treatment", "mean")
    staged = stats.withColumns({f"_e{a[0]}": F.try_divide(g(a, "var"), g(a, "n")) for a in ("control", "treatment")})
    ec, et = F.col("_ec"), F.col("_et")
    df = F.try_divide(
        (ec + et) * (ec + et),
        F.try_divide(ec * ec, g("control", "n") - 1.0) + F.try_divide(et * et, g("treatment", "n") - 1.0),
    )
    pooled = F.sqrt((g("control", "std") * g("control", "std") + g("treatment", "std") * g("treatment", "std")) / 2.0)
    staged = staged.withColumns(
        {"_t": F.try_divide(mt - mc, F.sqrt(ec + et)), "_v": df, "_d": (mt - mc) / (pooled + 1e-9)}
    ).withColumn("_p", t_two_sided(F.col("_t"), F.col("_v")))
    flag = F.coalesce(F.col("_p") < alpha, F.lit(False))
    size = F.abs("_d")
    values = (
        F.lit("Welch's t-Test"),
        F.lit(prefix),
        F.round(mc, 4),
        F.round(mt, 4),
        F.round(F.try_divide(mt - mc, mc + 1e-9), 4),
        F.round("_t", 4),
        F.round("_v", 4),
        F.round("_p", 6),
        F.round("_d", 4),
        F.when(size < 0.2, "small").when(size < 0.5, "medium").when(size.isNotNull(), "large"),
        flag,
        _label(flag),
        F.lit(alpha),
    )
    result = F.struct(*[v.alias(n) for n, v in zip(WELCH_FIELDS, values)])
    return staged.withColumn(out, result).drop("_ec", "_et", "_t", "_v", "_d", "_p")


def continuous_test(
    events: DataFrame, value: str, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05
) -> DataFrame:
    """Welch's t-test of a metric, one row per key."""
    stats = events.groupBy(*keys).agg(*metric_aggregates(value, F.col(value).cast("double")))
    return add_welch_test(stats, value, "_test", alpha).select(*keys, "_test.*")


# ---------------------------------------------------------------- full report


def per_customer(events: DataFrame, keys: Sequence[str] = ("experiment_name",), customer: str = "customer_id") -> DataFrame:
    """One row per (key, arm, customer): converted at least once, total revenue."""
    return events.groupBy(*keys, "group", customer).agg(
        F.max("converted").alias("converted"), F.sum("revenue_inr").alias("revenue_inr")
    )


def arm_contamination(
    events: DataFrame, keys: Sequence[str] = ("experiment_name",), customer: str = "customer_id"
) -> DataFrame:
    """Customers seen in both arms of an experiment."""
    seen = events.groupBy(*keys, customer).agg(
        F.max(_arm("control")).alias("c"), F.max(_arm("treatment")).alias("t")
    )
    return seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c") & F.col("t")).alias("in_both_arms")
    )


def experiment_report(
    events: DataFrame,
    keys: Sequence[str] = ("experiment_name",),
    alpha: float = 0.05,
    days: int = 60,
    unit: str = "event",
    min_converters: int = 10,
) -> DataFrame:
    """Conversion, revenue-per-user and order-value tests plus monthly impact, from one aggregate exchange.

    ``revenue_impact`` multiplies the lift in conversions by revenue per *user*; ``revenue_impact_aov``
    uses the order value instead.
    """
    rows = per_customer(events, keys) if unit == "customer" else events
    revenue = F.col("revenue_inr").cast("double")
    user, order = "revenue_per_user_inr", "avg_order_value_inr"
    totals = []
    for a in ("control", "treatment"):
        totals.append(F.count_if(_arm(a)).alias(f"{a}_n"))
        totals.append(F.coalesce(F.sum(F.when(_arm(a), F.col("converted"))), F.lit(0)).alias(f"{a}_conversions"))
    wide = rows.groupBy(*keys).agg(
        *totals, *metric_aggregates(user, revenue), *metric_aggregates(order, revenue, F.col("converted") == 1)
    )
    enough = (F.col(f"{order}_control_n") > min_converters) & (F.col(f"{order}_treatment_n") > min_converters)
    tested = two_proportion_test(wide, alpha)
    tested = tested.withColumn("conversion_test", F.struct(*tested.columns[len(wide.columns):]))
    tested = add_welch_test(add_welch_test(tested, user, "revenue_test", alpha), order, "aov_test", alpha).withColumns(
        {
            "aov_test": F.when(enough, F.col("aov_test")),
            "aov_note": F.when(~enough, "Insufficient converters for AOV test"),
        }
    )
    monthly = F.col("control_n") / float(days) * 30.0
    lift = F.col("conversion_test.absolute_lift")
    top = ("control_cvr", "treatment_cvr", "p_value", "significant", "significance_label", "ci_lower", "ci_upper")
    return tested.select(
        *keys,
        "control_n",
        "treatment_n",
        *[F.col(f"conversion_test.{c}").alias(c) for c in top],
        F.col("conversion_test.relative_lift").alias("uplift"),
        F.round(lift * monthly * F.col("revenue_test.treatment_mean"), 2).alias("revenue_impact"),
        F.round(lift * monthly * F.col("aov_test.treatment_mean"), 2).alias("revenue_impact_aov"),
        "conversion_test",
        "revenue_test",
        "aov_test",
        "aov_note",
    )


# ---------------------------------------------------------------- many tests at once


def adjust_p_values(df: DataFrame, p: str = "p_value", family: Sequence[str] = ()) -> DataFrame:
    """Bonferroni and Benjamini-Hochberg within each family of tests.

    Equal p-values are combined first and the distinct ones are range-partitioned, so no task ranks a
    whole family: ranks and running minima are taken inside a piece and corrected by piece totals.
    """
    fam = list(family)
    key = fam or ["_all"]
    rows = df if fam else df.withColumn("_all", F.lit(1))
    distinct = rows.filter(F.col(p).isNotNull()).groupBy(*key, F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    pieces = settle(range_pieces(distinct, *key, "_p"), "p-values")
    by_piece = Window.partitionBy(*key).orderBy("_piece")
    up_to_here = Window.partitionBy(*key, "_piece").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy(*key, "_piece").orderBy("_p").rowsBetween(0, Window.unboundedFollowing)
    totals = (
        pieces.groupBy(*key, "_piece")
        .agg(F.sum("_n").alias("_pn"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_pn").over(by_piece.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                "_m": F.sum("_pn").over(Window.partitionBy(*key)),
            }
        )
    )
    ranked = (
        match(pieces, totals, [*key, "_piece"])
        .withColumn("_rank", F.col("_before") + F.sum("_n").over(up_to_here))
        .withColumn("_step", F.col("_p") * F.col("_m") / F.col("_rank"))
        .withColumn("_inside", F.min("_step").over(from_here))
    )
    later = (
        ranked.groupBy(*key, "_piece")
        .agg(F.min("_step").alias("_low"))
        .withColumn("_later", F.min("_low").over(by_piece.rowsBetween(1, Window.unboundedFollowing)))
        .drop("_low")
    )
    adjusted = match(ranked, later, [*key, "_piece"]).select(
        *key,
        "_p",
        F.least(F.col("_p") * F.col("_m"), F.lit(1.0)).alias("p_bonferroni"),
        F.least("_inside", "_later", F.lit(1.0)).alias("p_bh"),
    )
    out = match(rows.withColumn("_p", F.col(p)), adjusted, [*key, "_p"], "left")
    return out.select(*df.columns, "p_bonferroni", "p_bh")


def segment_scorecard(
    events: DataFrame,
    segments: Sequence[str],
    keys: Sequence[str] = ("experiment_name",),
    alpha: float = 0.05,
) -> DataFrame:
    """The conversion test per (experiment, segment), corrected for the number of segments."""
    tested = conversion_test(events, [*keys, *segments], alpha, exact="_exact")
    # Rounded p-values would make all strong results equal, and one hot key of the join.
    adjusted = adjust_p_values(tested, "_exact", keys).drop("_exact")
    return adjusted.withColumn("significant_bh", F.coalesce(F.col("p_bh") < alpha, F.lit(False)))


def planned_sizes(designs: DataFrame, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05, power: float = 0.80) -> DataFrame:
    """``planned_n``, users of both arms together, for each experiment's ``baseline_rate`` and ``mde``."""
    return sample_size(designs, alpha=alpha, power=power).select(*keys, F.col("n_total").alias("planned_n"))


def sequential_monitor(
    events: DataFrame, planned: DataFrame, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05, time: str = "timestamp"
) -> DataFrame:
    """Cumulative z per day against the boundary of a group-sequential test with alpha spending.

    ``planned`` holds ``planned_n`` for each key (``planned_sizes``). Events are combined to days first; windows and arrays
    hold at most one row per day and experiment.
    """
    daily = arm_totals(events.withColumn("day", F.to_date(time)), [*keys, "day"])
    return monitor_columns(daily, planned, keys, alpha)


def monitor_columns(daily: DataFrame, planned: DataFrame, keys: Sequence[str] = ("experiment_name",), alpha: float = 0.05) -> DataFrame:
    """``crossed`` says that a look's z reached its boundary, ``stopped`` that this or an earlier look's did."""
    counts = ("control_n", "control_conversions", "treatment_n", "treatment_conversions")
    tested = two_proportion_test(running(daily, keys), alpha).select(*keys, "day", *counts, "z_statistic")
    bounded = with_boundaries(tested, keys, planned, alpha)
    upto = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return bounded.select(
        *keys,
        "day",
        *counts,
        "z_statistic",
        "planned_n",
        F.round("information", 6).alias("information_fraction"),
        F.round("boundary", 4).alias("boundary"),
        F.round("alpha_spent", 6).alias("alpha_spent"),
        F.coalesce(F.abs("z_statistic") >= F.round("boundary", 4), F.lit(False)).alias("crossed"),
    ).withColumn("stopped", F.max("crossed").over(upto))
