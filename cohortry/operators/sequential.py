"""Boundaries of group-sequential tests by alpha spending, computed inside column expressions.

Under the null the statistic at information t is B(t) / sqrt(t) for a Brownian motion B. A look at t_k may spend
alpha(t_k) less what earlier looks spent; its boundary is where the paths that had not crossed before leave exactly that
probability outside (Lan & DeMets 1983). The density of these paths is carried from look to look by numerical
integration (Armitage, McPherson & Rowe 1969), on panels of Gauss-Legendre nodes no wider than the step of the motion,
so accuracy does not depend on how looks are spaced. The density is even, so only its right half is kept.

An experiment's looks are one array of its row, so thousands of experiments are one job without a Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.tails import let, normal_tail
from cohortry.operators.ordering import match

#: A day whose information grew by less than this share of the plan is not a look of its own.
LEAST_STEP = 0.002
#: No boundary is larger: the probability beyond is below 2e-15.
HIGHEST = 8.0
HALVINGS, NEWTON_STEPS = 16, 3
#: Nodes and weights of the five-point Gauss-Legendre rule on -1..1.
NODES = (-0.906179845938664, -0.5384693101056831, 0.0, 0.5384693101056831, 0.906179845938664)
WEIGHTS = (0.23692688505618908, 0.47862867049936647, 0.5688888888888889, 0.47862867049936647, 0.23692688505618908)

Spending = Callable[[Column, float], Column]


def obrien_fleming(t: Column, alpha: float) -> Column:
    """Two-sided alpha spent up to information ``t``: very little early, all of it at 1."""
    return 4.0 * normal_tail(F.lit(NormalDist().inv_cdf(1 - alpha / 4)) / F.sqrt(t))


def pocock(t: Column, alpha: float) -> Column:
    """Two-sided alpha spent up to information ``t``, almost evenly."""
    return alpha * F.log1p((math.e - 1.0) * t)


def _looks(fractions: Column) -> Column:
    """The fractions, at most 1, with null where a day is no look of its own."""
    start = F.struct(F.lit(0.0).alias("t"), F.array().cast("array<double>").alias("looks"))

    def step(acc: Column, fraction: Column) -> Column:
        t = F.least(fraction, F.lit(1.0))
        new = (t - acc["t"] >= LEAST_STEP) | ((t >= 1.0) & (acc["t"] < 1.0))
        return F.struct(
            F.when(new, t).otherwise(acc["t"]).alias("t"),
            F.array_append(acc["looks"], F.when(new, t)).alias("looks"),
        )

    return F.aggregate(fractions, start, step)["looks"]


def _total(nodes: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(nodes, F.lit(0.0), lambda acc, n: acc + n["w"] * value(n["x"]))


def _beyond(nodes: Column, c: Column, s: Column) -> Column:
    """Probability that a path at ``nodes`` is outside -c..c after a step of standard deviation ``s``."""
    return 2.0 * _total(nodes, lambda x: normal_tail((c - x) / s) + normal_tail((c + x) / s))


def _boundary(nodes: Column, s: Column, root: Column, target: Column) -> Column:
    """The z-value beyond which ``target`` lies: some halvings, then Newton steps."""
    whole = F.struct(F.lit(0.0).alias("low"), F.lit(HIGHEST).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        def choose(low: Column, high: Column) -> Column:
            middle = (low + high) / 2.0
            return F.when(_beyond(nodes, middle * root, s) > target, F.struct(middle.alias("low"), high.alias("high"))).otherwise(
                F.struct(low.alias("low"), middle.alias("high"))
            )

        return let(choose, acc["low"], acc["high"])

    def newton(z: Column, _: Column) -> Column:
        near = lambda x, y: F.exp(-0.5 * ((y - x) / s) * ((y - x) / s)) + F.exp(-0.5 * ((y + x) / s) * ((y + x) / s))
        slope = lambda c: 2.0 * root * _total(nodes, lambda x: near(x, c)) / (s * math.sqrt(2 * math.pi))
        step = let(lambda c: F.try_divide(_beyond(nodes, c, s) - target, slope(c)), z * root)
        return F.least(F.coalesce(z + step, z), F.lit(HIGHEST))

    bracket = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), whole, halve)["high"]
    exact = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), bracket, newton)
    return F.when(_beyond(nodes, HIGHEST * root, s) >= target, F.lit(HIGHEST)).otherwise(exact)


def _density(nodes: Column, c: Column, s: Column, width: Column) -> Column:
    """Nodes on 0..c, in panels of at most ``width``, with the density after the step times the rule's weight."""

    def made(panels: Column) -> Column:
        rule = F.array(*[F.struct(F.lit((x + 1) / 2).alias("x"), F.lit(w / 2).alias("w")) for x, w in zip(NODES, WEIGHTS, strict=True)])

        def at(y: Column) -> Column:
            near = lambda x: F.exp(-0.5 * ((y - x) / s) * ((y - x) / s)) + F.exp(-0.5 * ((y + x) / s) * ((y + x) / s))
            return _total(nodes, near) / (s * math.sqrt(2 * math.pi))

        def panel(p: Column) -> Column:
            return F.transform(rule, lambda g: let(lambda y, w: F.struct(y.alias("x"), (w * at(y)).alias("w")), (p + g["x"]) * c / panels, g["w"] * c / panels))

        return F.flatten(F.transform(F.sequence(F.lit(0), (panels - 1.0).cast("int")), panel))

    return let(made, F.ceil(c / width))


def boundaries(fractions: Column, alpha: float = 0.05, spending: Spending = obrien_fleming) -> Column:
    """An array beside ``fractions``, the information (share of the plan, ascending) at each day, of
    ``struct<boundary, spent>``: the two-sided z-boundary of the look and all alpha spent up to it.

    Null fields where a day is no look: its information grew by less than ``LEAST_STEP``, or the plan is complete already.
    """
    looks = _looks(fractions)
    # Each look with the information before it and at the look after it.
    start = F.struct(
        F.lit(0.0).alias("t"),
        F.lit(0.0).alias("spent"),
        F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.5).alias("w"))).alias("nodes"),
        F.array().cast("array<struct<boundary:double,spent:double>>").alias("out"),
    )

    def step(all_looks: Column):
        def run(acc: Column, i: Column) -> Column:
            def look(t: Column, before: Column, after: Column) -> Column:
                s, root = F.sqrt(t - before), F.sqrt(t)
                target = F.greatest(spending(t, alpha) - acc["spent"], F.lit(0.0))
                width = F.sqrt(F.least(t - before, F.coalesce(after - t, t - before)))

                def found(b: Column, s: Column, root: Column, width: Column, t: Column) -> Column:
                    spent = acc["spent"] + _beyond(acc["nodes"], b * root, s)
                    return F.struct(
                        t.alias("t"),
                        spent.alias("spent"),
                        _density(acc["nodes"], b * root, s, width).alias("nodes"),
                        F.array_append(acc["out"], F.struct(b.alias("boundary"), spent.alias("spent"))).alias("out"),
                    )

                return let(found, let(lambda s, root, target: _boundary(acc["nodes"], s, root, target), s, root, target), s, root, width, t)

            following = F.filter(F.slice(all_looks, i + 2, F.size(all_looks)), lambda x: x.isNotNull())
            nothing = F.struct(F.lit(None).cast("double").alias("boundary"), F.lit(None).cast("double").alias("spent"))
            skipped = F.struct(acc["t"].alias("t"), acc["spent"].alias("spent"), acc["nodes"].alias("nodes"), F.array_append(acc["out"], nothing).alias("out"))
            t = F.get(all_looks, i)
            return F.when(t.isNull(), skipped).otherwise(let(look, t, acc["t"], F.get(following, F.lit(0))))

        return run

    indexes = lambda a: F.filter(F.sequence(F.lit(0), F.size(a)), lambda i: i < F.size(a))
    return F.transform(F.array(F.struct(looks.alias("a"))), lambda h: F.aggregate(indexes(h["a"]), start, step(h["a"]))["out"])[0]


def with_boundaries(
    cumulative: DataFrame, keys: Sequence[str], planned: DataFrame, alpha: float = 0.05, spending: Spending = obrien_fleming, order: str = "day"
) -> DataFrame:
    """Rows of ``cumulative`` counts (``control_n``, ``treatment_n`` so far, one row a day) with their information and boundary.

    ``planned`` holds the planned number of users of both arms for each key (``planned_n``). Information is what was seen,
    as a share of the plan, at most 1; without a plan, or with one of no users, it is null and so is the boundary. What a
    day's row says never changes on later days. An experiment's days are one array of its row: as many as days, not events.
    """
    rows = match(cumulative, planned.select(*keys, F.col("planned_n")), list(keys), "left")
    fraction = F.when(F.col("planned_n") > 0, F.least((F.col("control_n") + F.col("treatment_n")) / F.col("planned_n"), F.lit(1.0)))
    own = [c for c in cumulative.columns if c not in keys]
    whole = rows.withColumn("information", fraction.cast("double")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(order, *[c for c in own if c != order], "planned_n", "information"))).alias("_days")
    )
    made = whole.withColumn("_looks", F.when(F.get("_days", F.lit(0))["information"].isNotNull(), boundaries(F.transform("_days", lambda x: x["information"]), alpha, spending)))
    # The generator keeps the boundaries from being evaluated again for each column that reads them.
    zipped = made.select(*keys, F.posexplode("_days").alias("_i", "_day"), F.col("_looks"))
    return zipped.select(*keys, "_day.*", F.get("_looks", F.col("_i")).alias("_look")).select(
        *keys, *own, "planned_n", "information", F.col("_look.boundary").alias("boundary"), F.col("_look.spent").alias("alpha_spent")
    )


def running(daily: DataFrame, keys: Sequence[str], order: str = "day") -> DataFrame:
    """Counts of both arms up to each day."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counts = ("control_n", "control_conversions", "treatment_n", "treatment_conversions")
    return daily.withColumns({c: F.sum(c).over(upto) for c in counts})
