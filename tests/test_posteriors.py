"""Posterior comparison against closed forms, limits and sums of exact terms."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.operators import bayes

N = NormalDist()


def totals(spark, *rows):
    columns = "id int, control_conversions bigint, control_n bigint, treatment_conversions bigint, treatment_n bigint"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], columns)


def log_beta(a, b):
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def win_closed(ac, bc, at, bt):
    """P(treatment > control) for whole parameters, a finite sum."""
    return sum(math.exp(log_beta(ac + i, bt + bc) - math.log(bt + i) - log_beta(1 + i, bt) - log_beta(ac, bc)) for i in range(at))


def loss_closed(ac, bc, at, bt):
    """E[max(control - treatment, 0)], by the same sum with one success more on a side."""
    return ac / (ac + bc) * (1 - win_closed(ac + 1, bc, at, bt)) - at / (at + bt) * (1 - win_closed(ac, bc, at + 1, bt))


def cdf_grid(ac, bc, at, bt, d, n=200_000):
    """P(treatment - control <= d) on a fine grid of midpoints."""
    x = (np.arange(n) + 0.5) / n
    density = lambda a, b: np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x) - log_beta(a, b)) / n
    below = np.concatenate([[0.0], np.cumsum(density(at, bt))])
    return float(np.sum(density(ac, bc) * np.interp(x + d, np.arange(n + 1) / n, below)))


SMALL = [(0, 5, 0, 5), (0, 5, 5, 5), (2, 5, 3, 7), (0, 100, 5, 100), (3, 400, 150, 400), (100, 1000, 110, 1000), (0, 5, 40, 5_000), (900, 1000, 4, 6)]


@pytest.fixture(scope="module")
def small(spark):
    made = bayes._with_posteriors(totals(spark, *SMALL), 1.0, 1.0)
    g = F.col("_g")
    exact = made.select("id", bayes._win_and_loss(g).alias("r"), bayes._quantile(g, 0.025).alias("low"), bayes._quantile(g, 0.975).alias("high"))
    return sorted(exact.collect())


def test_small_samples_by_closed_form(small):
    for r, (xc, nc, xt, nt) in zip(small, SMALL, strict=True):
        args = (xc + 1, nc - xc + 1, xt + 1, nt - xt + 1)
        assert r.r.win == pytest.approx(win_closed(*args), abs=1e-9)
        assert r.r.loss == pytest.approx(loss_closed(*args), abs=1e-9)
        assert cdf_grid(*args, r.low) == pytest.approx(0.025, abs=1e-6)
        assert cdf_grid(*args, r.high) == pytest.approx(0.975, abs=1e-6)
    assert small[0].low == pytest.approx(-small[0].high, abs=1e-8)


def test_large_and_unequal_samples(spark):
    """Beyond some size the difference is normal; the limit's own error falls off like 1 / sqrt(n)."""
    rows = []
    for nc, nt in ((10**8, 10**8), (10**10, 10**13), (10**13, 10**10), (10**13, 10**13)):
        sd = math.sqrt(0.21 / nc + 0.24 / nt)
        rows.append((round(0.3 * nc), nc, round((0.4 if nc != nt else 0.3 + 1.2 * sd) * nt), nt))
    made = bayes._with_posteriors(totals(spark, *rows), 1.0, 1.0)
    g = F.col("_g")
    got = sorted(made.select("id", bayes._win_and_loss(g).alias("r"), bayes._quantile(g, 0.025).alias("low"), bayes._quantile(g, 0.975).alias("high")).collect())
    for r, (xc, nc, xt, nt) in zip(got, rows, strict=True):
        (mc, vc), (mt, vt) = ((a / (a + b), a * b / (a + b) ** 2 / (a + b + 1)) for a, b in ((xc + 1, nc - xc + 1), (xt + 1, nt - xt + 1)))
        sd = math.sqrt(vc + vt)
        z = (mt - mc) / sd
        assert r.r.win == pytest.approx(N.cdf(z), abs=1e-4)
        assert r.r.loss / sd == pytest.approx(N.pdf(z) - z * N.cdf(-z), abs=1e-4)
        assert ((r.low - (mt - mc)) / sd, (r.high - (mt - mc)) / sd) == pytest.approx((-1.959964, 1.959964), abs=5e-4)
        if nc == nt == 10**13:
            assert (r.r.win, (r.low - (mt - mc)) / sd) == pytest.approx((N.cdf(z), -1.9599640), abs=1e-6)


def test_report_rows(spark):
    rows = bayes.bayes_report(totals(spark, (100, 1000, 110, 1000), (None, 10, 1, 10))).orderBy("id").collect()
    assert rows[0].prob_treatment_better == pytest.approx(win_closed(101, 901, 111, 891), abs=5e-5)
    assert rows[1].prob_treatment_better is None and rows[1].credible_lower is None and rows[1].recommendation is None
    assert bayes.bayes_report(totals(spark, (1, 2, 1, 2)).where("false")).count() == 0
    plan = bayes.bayes_report(totals(spark, (1, 2, 1, 2)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
