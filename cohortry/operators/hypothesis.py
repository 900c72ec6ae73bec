"""General hypothesis tests, keyed by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.tails import chi2_sf, f_sf, normal_upper, t_two_sided
from cohortry.operators.ordering import key_hash, match, range_pieces
from cohortry.session import settle

ONE = "_all"


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Give keyless input a constant key so that one code path serves both."""
    return (df, list(keys)) if keys else (df.withColumn(ONE, F.lit(1)), [ONE])


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of per-key rows; without keys the single row comes as a scalar subquery, not a join."""
    if keys:
        return match(left, right, list(keys))
    added = [c for c in right.columns if c != ONE]
    return left.withColumn("_s", right.select(F.struct(*added)).scalar()).select(*left.columns, "_s.*")


def chi_square(
    df: DataFrame, row: str, col: str, keys: Sequence[str] = (), alpha: float = 0.05, yates: bool = True, n: str | None = None
) -> DataFrame:
    """Chi-square independence test per key; ``n`` names a count column if the input is already a table.

    sum((o-e)^2/e) equals N * sum(o^2 / (row * column)) - N, so empty cells need no dense grid and the
    margins are plain aggregates of the small cell table. With one degree of freedom every cell has the
    same |o-e| and the continuity correction follows from the margins alone.
    """
    data, key = _keyed(df, keys)
    cells = (
        data.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(*key, F.col(row).alias("_r"), F.col(col).alias("_c"))
        .agg((F.sum(n) if n else F.count(F.lit(1))).cast("double").alias("_o"))
        .filter("_o > 0")
    )
    by_row = cells.groupBy(*key, "_r").agg(F.sum("_o").alias("_rt"))
    by_col = cells.groupBy(*key, "_c").agg(F.sum("_o").alias("_ct"))
    size = lambda t, m: t.groupBy(*key).agg(
        F.count(F.lit(1)).alias(f"_n{m}"), F.sum(1.0 / F.col(m)).alias(f"_inv{m}")
    )
    fit = (
        match(match(cells, by_row, [*key, "_r"]), by_col, [*key, "_c"])
        .groupBy(*key)
        .agg(
            F.sum("_o").alias("_total"),
            F.sum(F.col("_o") * F.col("_o") / (F.col("_rt") * F.col("_ct"))).alias("_share"),
            F.max(F.struct("_o", "_rt", "_ct")).alias("_cell"),
        )
    )
    fit = _attach(_attach(fit, size(by_row, "_rt"), keys), size(by_col, "_ct"), keys)
    dof = (F.col("_n_rt") - 1) * (F.col("_n_ct") - 1)
    plain = F.greatest(F.col("_total") * F.col("_share") - F.col("_total"), F.lit(0.0))
    gap = F.abs(F.col("_cell._o") - F.col("_cell._rt") * F.col("_cell._ct") / F.col("_total"))
    pulled = gap - F.least(gap, F.lit(0.5))
    corrected = pulled * pulled * F.col("_total") * F.col("_inv_rt") * F.col("_inv_ct")
    chi2 = F.when((dof == 1) & F.lit(yates), corrected).otherwise(plain)
    tested = fit.withColumns({"_chi": chi2, "_dof": dof}).withColumn(
        "_p", F.when(F.col("_dof") == 0, 1.0).otherwise(chi2_sf(F.col("_chi"), F.col("_dof")))
    )
    flag = F.col("_p") < alpha
    return tested.select(
        *keys,
        F.lit("Chi-Square Independence Test").alias("test"),
        F.round("_chi", 4).alias("chi2_statistic"),
        F.round("_p", 6).alias("p_value"),
        F.col("_dof").cast("bigint").alias("degrees_of_freedom"),
        flag.alias("significant"),
        F.when(flag, "Variables are dependent").otherwise("Variables are independent").alias("interpretation"),
    )


def _levels(df: DataFrame, factor: str, value: str, keys: Sequence[str], min_size: int) -> DataFrame:
    moments = F.count(value).alias("_n"), F.avg(value).alias("_m"), F.var_samp(value).alias("_v")
    return df.groupBy(*keys, factor).agg(*moments).filter(F.col("_n") > min_size)


def level_means(df: DataFrame, factor: str, value: str, keys: Sequence[str] = (), min_size: int = 30) -> DataFrame:
    """Size, mean and sample variance of each level with more than ``min_size`` values."""
    levels = _levels(df, factor, value, keys, min_size)
    return levels.select(*keys, factor, F.col("_n").alias("n"), F.col("_m").alias("mean"), F.col("_v").alias("var"))


def anova(
    df: DataFrame, factor: str, value: str, keys: Sequence[str] = (), min_size: int = 30, alpha: float = 0.05
) -> DataFrame:
    """One-way ANOVA per key, from the sufficient statistics of each level."""
    data, key = _keyed(df, keys)
    levels = _levels(data, factor, value, key, min_size)
    # One row a level, read several times: written once, so that the data are scanned once.
    levels = settle(levels.select(*key, F.col(factor).cast("string").alias("_level"), "_n", F.col("_m").alias("_mean"), F.col("_v").alias("_var")), "levels")
    grand = levels.groupBy(*key).agg((F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("_grand"))
    off = F.col("_mean") - F.col("_grand")
    sums = (
        _attach(levels, grand, keys)
        .groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("_k"),
            F.sum("_n").alias("_total"),
            F.sum(F.col("_n") * off * off).alias("_between"),
            F.sum((F.col("_n") - 1) * F.coalesce("_var", F.lit(0.0))).alias("_within"),
            F.sort_array(F.collect_list(F.struct("_level", "_mean"))).alias("_means"),
        )
    )
    d1, d2 = F.col("_k") - 1, F.col("_total") - F.col("_k")
    f = F.try_divide(F.try_divide(F.col("_between"), d1.cast("double")), F.try_divide(F.col("_within"), d2.cast("double")))
    tested = sums.withColumns({"_f": f, "_d1": d1, "_d2": d2}).withColumn("_p", f_sf(F.col("_f"), F.col("_d1"), F.col("_d2")))
    flag = F.coalesce(F.col("_p") < alpha, F.lit(False))
    shown = F.transform("_means", lambda m: F.concat(F.coalesce(m["_level"], F.lit("(none)")), F.lit(": "), F.format_string("%.4f", m["_mean"])))
    return tested.select(
        *keys,
        F.lit("One-Way ANOVA").alias("test"),
        F.col("_k").alias("n_groups"),
        F.array_join(shown, ", ").alias("group_means"),
        F.round("_f", 4).alias("f_statistic"),
        F.col("_d1").alias("df_between"),
        F.col("_d2").alias("df_within"),
        F.round("_p", 6).alias("p_value"),
        flag.alias("significant"),
        F.when(flag, "At least one group mean differs significantly")
        .otherwise("No significant difference between groups")
        .alias("interpretation"),
    )


def pearson(df: DataFrame, x: str, y: str, keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Pearson correlation per key; a constant column gives null."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    # corr() raises on a constant column under ANSI mode; its parts do not.
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    stats = both.groupBy(*keys).agg(r.alias("_r"), F.count(F.lit(1)).alias("n"))
    r, free = F.col("_r"), (F.col("n") - 2).cast("double")
    t = F.try_divide(r * F.sqrt(free), F.sqrt(1.0 - r * r))
    stats = stats.withColumn("_v", F.when(free > 0, free)).withColumn("_t", F.when(F.abs(r) < 1, t))
    p = F.when((F.abs(r) >= 1) & (free > 0), 0.0).otherwise(t_two_sided(F.col("_t"), F.col("_v")))
    flag = F.coalesce(F.col("_p") < alpha, F.lit(False))
    size = F.abs(F.col("_r"))
    strength = F.when(size > 0.7, "strong").when(size > 0.4, "moderate").when(size.isNotNull(), "weak")
    direction = F.when(F.col("_r") > 0, "positive").when(F.col("_r").isNotNull(), "negative")
    return stats.withColumn("_p", p).select(
        *keys,
        F.lit("Pearson Correlation").alias("test"),
        F.lit(f"{x} vs {y}").alias("variables"),
        F.round("_r", 4).alias("r"),
        F.round(F.col("_r") * F.col("_r"), 4).alias("r_squared"),
        F.round("_p", 6).alias("p_value"),
        flag.alias("significant"),
        strength.alias("strength"),
        direction.alias("direction"),
        F.concat(F.initcap(strength), F.lit(" "), direction, F.lit(f" correlation between {x} and {y}")).alias("interpretation"),
    )


def jarque_bera(df: DataFrame, value: str, keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Normality over all rows of a group: n/6 (S^2 + K^2/4), p = exp(-JB/2)."""
    stats = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis")
    )
    jb = F.col("n") / 6.0 * (F.col("skewness") * F.col("skewness") + F.col("kurtosis") * F.col("kurtosis") / 4.0)
    return stats.withColumn("_jb", jb).select(
        *keys,
        "n",
        F.round("skewness", 6).alias("skewness"),
        F.round("kurtosis", 6).alias("kurtosis"),
        F.round("_jb", 4).alias("statistic"),
        F.round(F.exp(-F.col("_jb") / 2.0), 6).alias("p_value"),
        F.coalesce(F.exp(-F.col("_jb") / 2.0) > alpha, F.lit(False)).alias("normal"),
    )


# Acklam's rational approximation of the normal quantile (central part and tails), relative error 1.2e-9.
_CENTRE_TOP = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_CENTRE_BOTTOM = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
_TAIL_TOP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
_TAIL = 0.02425


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution function for 0 < p < 1."""
    q = p - 0.5
    centre = _polynomial(q * q, _CENTRE_TOP) * q / _polynomial(q * q, _CENTRE_BOTTOM)
    far = F.sqrt(-2.0 * F.ln(F.least(p, 1.0 - p)))
    tail = _polynomial(far, _TAIL_TOP) / _polynomial(far, _TAIL_BOTTOM)
    return F.when(p < _TAIL, tail).when(p > 1.0 - _TAIL, -tail).otherwise(centre)


def shapiro(df: DataFrame, value: str, ids: Sequence[str], keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Shapiro-Francia W' per key over all rows: the squared correlation of the sorted values with normal scores.

    Rows are range-partitioned by key, value and a hash of ``ids`` (equal values are dealt too) and ranked by piece;
    p by Royston's normal approximation of ln(1 - W'), made for samples of 5 and more. Fewer than three values, or
    equal ones, give nulls.
    """
    data, key = _keyed(df.filter(F.col(value).isNotNull()), keys)
    rows = data.select(*key, F.col(value).cast("double").alias("_x"), key_hash(*ids).alias("_h"))
    pieces = settle(range_pieces(rows, *key, "_x", "_h").drop("_h"), "ranks")
    earlier = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy(*key, "_piece").agg(F.count(F.lit(1)).alias("_pn"))
    counts = counts.withColumns({"_before": F.coalesce(F.sum("_pn").over(earlier), F.lit(0)), "_n": F.sum("_pn").over(Window.partitionBy(*key))})
    inside = F.row_number().over(Window.partitionBy(*key, "_piece").orderBy("_x"))
    ranked = match(pieces.withColumn("_rank", inside), counts, [*key, "_piece"])
    score = normal_quantile((F.col("_before") + F.col("_rank") - 0.375) / (F.col("_n") + 0.25))
    sums = ranked.withColumn("_m", score).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.covar_pop("_m", "_x").alias("_mx"), F.var_pop("_m").alias("_mm"), F.var_pop("_x").alias("_xx")
    )
    w = F.when(F.col("_n") >= 3, F.try_divide(F.col("_mx") * F.col("_mx"), F.col("_mm") * F.col("_xx")))
    tested = sums.withColumn("_w", F.least(w, F.lit(1.0)))
    log_n = F.ln(F.col("_n").cast("double"))
    mean = -1.2725 + 1.0521 * (F.ln(log_n) - log_n)
    sd = 1.0308 - 0.26758 * (F.ln(log_n) + 2.0 / log_n)
    z = (F.ln(F.greatest(1.0 - F.col("_w"), F.lit(1e-300))) - mean) / sd
    tested = tested.withColumn("_z", F.when(F.col("_w").isNotNull(), z)).withColumn("_p", normal_upper(F.col("_z")))
    normal = F.col("_p") > alpha
    return tested.select(
        *keys,
        F.lit("Shapiro-Francia").alias("test"),
        F.lit(value).alias("variable"),
        F.col("_n").alias("n"),
        F.round("_w", 4).alias("statistic"),
        F.round("_p", 6).alias("p_value"),
        normal.alias("normal"),
        F.when(normal, "Normally distributed").when(~normal, "Not normally distributed").alias("interpretation"),
    )
