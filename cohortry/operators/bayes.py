"""Beta-Binomial comparison of two arms, by quadrature in column expressions.

A posterior is integrated over its log-odds, from its mean, in units of its own spread. There the density is analytic
and dies away on both sides, so even steps of half a deviation, a quarter of a unit at most, are exact to double precision, for five users as for 1e13;
it is normalised by its own sum, without gamma functions. A distribution function is the sum of whole steps below a point
and one five-point rule up to it. The outer integral runs over the narrower posterior, along which the other one's
distribution function is smooth; shifted by a difference it ends where the other one's range does. All of it is arrays of the experiment's own row: no rows, no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.tails import let
from cohortry.operators.sequential import NODES, WEIGHTS

HALVINGS = 44


def _posterior(arm: str, prior_alpha: float, prior_beta: float) -> tuple[Column, Column]:
    n, x = F.col(f"{arm}_n").cast("double"), F.col(f"{arm}_conversions").cast("double")
    return x + prior_alpha, n - x + prior_beta


def _density(p: Column, d: Column) -> Column:
    """Density of the log-odds at distance ``d`` from those of the mean, relative to the density there."""
    return F.exp(-(p["a"] + p["b"]) * F.log1p((1.0 - p["m"]) * F.expm1(-d)) - p["b"] * d)


def _above_mean(p: Column, d: Column) -> Column:
    """The probability at log-odds distance ``d`` less the mean, without cancellation."""
    e = F.expm1(-d)
    return -p["m"] * (1.0 - p["m"]) * e / (1.0 + (1.0 - p["m"]) * e)


def _shape(a: Column, b: Column) -> Column:
    """Parameters, mean, deviation, and the grid: its first distance, its step and the number of steps."""
    m = a / (a + b)
    spread = 1.0 / F.sqrt((a + b) * m * (1.0 - m))
    # The tails fall off like exp(a d) and exp(-b d) beyond some deviations.
    left, right, step = 8.5 * spread + 34.0 / a, 8.5 * spread + 34.0 / b, F.least(spread / 2.0, F.lit(0.25))
    return F.struct(
        a.alias("a"), b.alias("b"), m.alias("m"), F.sqrt(m * (1.0 - m) / (a + b + 1.0)).alias("sd"),
        left.alias("left"), step.alias("step"), F.ceil((left + right) / step).cast("int").alias("steps"),
    )


def _rule(p: Column, first: Column, width: Column) -> Column:
    """Integrals of the density, and of it times the distance from the mean, over ``width`` from ``first``."""
    points = [first + (x + 1) / 2 * width for x in NODES]
    f = [w / 2 * _density(p, d) for d, w in zip(points, WEIGHTS, strict=True)]
    mass, moment = f[0], f[0] * _above_mean(p, points[0])
    for value, d in zip(f[1:], points[1:], strict=True):
        mass, moment = mass + value, moment + value * _above_mean(p, d)
    return F.struct((mass * width).alias("f"), (moment * width).alias("k"))


def _sums(p: Column) -> Column:
    """Mass and moment below the end of each step of a posterior's grid."""
    start = F.array(F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("k")))

    def add(acc: Column, i: Column) -> Column:
        step = let(lambda first, width: _rule(p, first, width), i * p["step"] - p["left"], p["step"])
        both = F.struct(F.element_at(acc, -1).alias("last"), step.alias("step"))
        total = F.transform(F.array(both), lambda s: F.struct((s["last"]["f"] + s["step"]["f"]).alias("f"), (s["last"]["k"] + s["step"]["k"]).alias("k")))[0]
        return F.array_append(acc, total)

    return F.aggregate(F.sequence(F.lit(0), p["steps"] - 1), start, add)


def _below(p: Column, sums: Column, x: Column) -> Column:
    """``f``: P(X <= x), and ``k``: E[(X - mean); X <= x]."""
    zero, one = (F.struct(F.lit(v).alias("f"), F.lit(0.0).alias("k")) for v in (0.0, 1.0))

    def at(d: Column) -> Column:
        def inside(d: Column, i: Column, total: Column) -> Column:
            first = i * p["step"] - p["left"]
            part = let(lambda first, width: _rule(p, first, width), first, d - first)
            sum_ = F.get(sums, i.cast("int"))
            joined = F.array(F.struct(sum_.alias("s"), part.alias("p")))
            return F.transform(joined, lambda j: F.struct(((j["s"]["f"] + j["p"]["f"]) / total).alias("f"), ((j["s"]["k"] + j["p"]["k"]) / total).alias("k")))[0]

        i = F.floor((d + p["left"]) / p["step"])
        end = p["steps"] * p["step"] - p["left"]
        return F.when(d <= -p["left"], zero).when(d >= end, one).otherwise(let(inside, d, i, F.element_at(sums, -1)["f"]))

    return F.when(x <= 0, zero).when(x >= 1, one).otherwise(let(at, _distance(p, x)))


def _distance(p: Column, x: Column) -> Column:
    return F.ln(x / (1.0 - x)) - F.ln(p["a"] / p["b"])


def _outer(p: Column) -> Column:
    """Points of a posterior with their share of its mass: ``x``, its distance ``v`` from the mean, ``w``."""
    raw = F.transform(F.sequence(F.lit(0), p["steps"]), lambda i: let(lambda d: F.struct(_above_mean(p, d).alias("v"), _density(p, d).alias("w")), i * p["step"] - p["left"]))

    def share(points: Column) -> Column:
        total = F.aggregate(points, F.lit(0.0), lambda acc, c: acc + c["w"])
        return let(lambda t: F.transform(points, lambda c: F.struct((p["m"] + c["v"]).alias("x"), (c["w"] / t).alias("w"))), total)

    return F.transform(F.array(F.struct(raw.alias("r"))), lambda h: share(h["r"]))[0]


def _with_posteriors(totals: DataFrame, prior_alpha: float, prior_beta: float) -> DataFrame:
    """``_o`` and ``_i``, the narrower and the wider posterior, ``_t`` whether the narrower is the treatment's, and their grids.

    The columns are arrays of a few dozen points; they pass a generator once, so that Catalyst does not evaluate them anew
    wherever they are read.
    """
    shapes = totals.withColumns({f"_{arm}": _shape(*_posterior(arm, prior_alpha, prior_beta)) for arm in ("control", "treatment")})
    narrow = F.col("_treatment.sd") <= F.col("_control.sd")
    known = F.col("_control.m").isNotNull() & F.col("_treatment.m").isNotNull()
    o, i = F.when(narrow, F.col("_treatment")).otherwise(F.col("_control")), F.when(narrow, F.col("_control")).otherwise(F.col("_treatment"))
    ordered = shapes.withColumns({"_h": F.struct(o.alias("o"), i.alias("i"), narrow.alias("t"))})
    grids = F.transform(F.array("_h"), lambda h: F.struct(h["o"].alias("o"), h["i"].alias("i"), h["t"].alias("t"), _outer(h["o"]).alias("points"), _sums(h["i"]).alias("sums"), _sums(h["o"]).alias("own")))
    return ordered.select(*totals.columns, F.explode_outer(F.when(known, grids)).alias("_g"))


def _win_and_loss(g: Column) -> Column:
    """P(treatment > control) and E[max(control - treatment, 0)]."""
    start = F.struct(F.lit(0.0).alias("win"), F.lit(0.0).alias("loss"))

    def add(acc: Column, c: Column) -> Column:
        below = F.array(F.struct(_below(g["i"], g["sums"], c["x"]).alias("b")))

        def both(h: Column) -> Column:
            f, k, over = h["b"]["f"], h["b"]["k"], c["x"] - g["i"]["m"]
            win = F.when(g["t"], f).otherwise(1.0 - f)
            loss = F.when(g["t"], -k - over * (1.0 - f)).otherwise(over * f - k)
            return F.struct((acc["win"] + c["w"] * win).alias("win"), (acc["loss"] + c["w"] * loss).alias("loss"))

        return F.transform(below, both)[0]

    return F.aggregate(g["points"], start, add)


def _quantile(g: Column, q: float) -> Column:
    """The difference treatment - control below which ``q`` of the probability lies, by halving a range of 20 deviations each way."""

    p, rule = g["o"], F.array(*[F.struct(F.lit((x + 1) / 2).alias("x"), F.lit(w / 2).alias("w")) for x, w in zip(NODES, WEIGHTS, strict=True)])

    def share(d: Column) -> Column:
        """P(difference <= d): over the outer values whose partner lies strictly between 0 and 1, and all those beyond."""
        low, high = F.greatest(F.when(g["t"], d).otherwise(-d), F.lit(0.0)), F.least(1.0 + F.when(g["t"], d).otherwise(-d), F.lit(1.0))
        end = p["steps"] * p["step"] - p["left"]
        first = F.when(low <= 0, -p["left"]).otherwise(F.greatest(_distance(p, low), -p["left"]))
        last = F.when(high >= 1, end).otherwise(F.least(_distance(p, high), end))
        beyond = F.when(g["t"], F.when(low > 0, _below(p, g["own"], low)["f"]).otherwise(0.0)).otherwise(F.when(high < 1, 1.0 - _below(p, g["own"], high)["f"]).otherwise(0.0))

        def inside(first: Column, width: Column, panels: Column) -> Column:
            def add(acc: Column, i: Column) -> Column:
                def value(u: Column, w: Column) -> Column:
                    other = let(lambda x: F.when(g["t"], 1.0 - _below(g["i"], g["sums"], x - d)["f"]).otherwise(_below(g["i"], g["sums"], x + d)["f"]), p["m"] + _above_mean(p, u))
                    return w * _density(p, u) * other

                node = F.get(rule, (i % 5).cast("int"))
                return acc + width * let(value, first + (F.floor(i / 5) + node["x"]) * width, node["w"])

            return F.aggregate(F.sequence(F.lit(0), (panels * 5 - 1).cast("int")), F.lit(0.0), add)

        def panelled(first: Column, last: Column) -> Column:
            panels = F.ceil((last - first) / (2.0 * p["step"]))
            return let(inside, first, (last - first) / panels, panels)

        return beyond + F.when(last > first, let(panelled, first, last)).otherwise(0.0) / F.element_at(g["own"], -1)["f"]

    lift = F.when(g["t"], g["o"]["m"] - g["i"]["m"]).otherwise(g["i"]["m"] - g["o"]["m"])
    reach = 20.0 * F.sqrt(g["o"]["sd"] * g["o"]["sd"] + g["i"]["sd"] * g["i"]["sd"])
    whole = F.struct(F.greatest(lift - reach, F.lit(-1.0)).alias("low"), F.least(lift + reach, F.lit(1.0)).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        def choose(low: Column, high: Column) -> Column:
            middle = (low + high) / 2.0
            return F.when(share(middle) < q, F.struct(middle.alias("low"), high.alias("high"))).otherwise(F.struct(low.alias("low"), middle.alias("high")))

        return let(choose, acc["low"], acc["high"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), whole, halve, lambda acc: (acc["low"] + acc["high"]) / 2.0)


def bayes_test(totals: DataFrame, prior_alpha: float = 1.0, prior_beta: float = 1.0) -> DataFrame:
    """P(treatment > control), expected lift and expected loss of shipping the treatment. A missing count gives nulls."""
    made = _with_posteriors(totals, prior_alpha, prior_beta)
    g = F.col("_g")
    swept = made.select(*totals.columns, "_g", F.explode_outer(F.array(F.when(g.isNotNull(), _win_and_loss(g)))).alias("_r"))
    win = F.col("_r.win")
    return swept.select(
        *totals.columns,
        F.lit("Bayesian Beta-Binomial").alias("method"),
        F.round(win, 4).alias("prob_treatment_better"),
        F.round(1.0 - win, 4).alias("prob_control_better"),
        F.round(F.when(g["t"], g["o"]["m"] - g["i"]["m"]).otherwise(g["i"]["m"] - g["o"]["m"]), 6).alias("expected_lift"),
        F.round("_r.loss", 6).alias("expected_loss_if_treatment"),
        F.when(win > 0.95, "Ship Treatment ✓").when(win > 0.80, "Continue Testing").when(win.isNotNull(), "Keep Control").alias("recommendation"),
    )


def credible_interval(totals: DataFrame, prior_alpha: float = 1.0, prior_beta: float = 1.0, level: float = 0.95, digits: int | None = 6) -> DataFrame:
    """Equal-tailed credible interval of the lift, the roots of the difference's distribution function."""
    made, tail = _with_posteriors(totals, prior_alpha, prior_beta), (1 - level) / 2
    rounded = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return made.select(
        *totals.columns,
        rounded(F.when(F.col("_g").isNotNull(), _quantile(F.col("_g"), tail))).alias("credible_lower"),
        rounded(F.when(F.col("_g").isNotNull(), _quantile(F.col("_g"), 1 - tail))).alias("credible_upper"),
    )


def bayes_report(totals: DataFrame, **priors: float) -> DataFrame:
    """``bayes_test`` plus the credible interval."""
    return credible_interval(bayes_test(totals, **priors), **priors)
