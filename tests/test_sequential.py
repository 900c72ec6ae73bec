"""Group-sequential boundaries against published tables and simulated Brownian motion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.operators import experiments, sequential

#: Published boundaries of O'Brien-Fleming-type and Pocock-type spending, two-sided 0.05, five equal looks.
TABLE = {"obrien_fleming": [4.8769, 3.3569, 2.6803, 2.2898, 2.0310], "pocock": [2.4380, 2.4268, 2.4101, 2.3966, 2.3859]}


def bounds(spark, fractions, alpha=0.05, spending=sequential.obrien_fleming):
    df = spark.createDataFrame([(fractions,)], "f array<double>")
    return df.select(sequential.boundaries(F.col("f"), alpha, spending).alias("b")).first().b


@pytest.mark.parametrize("name", TABLE)
def test_published_tables(spark, name):
    got = bounds(spark, [0.2, 0.4, 0.6, 0.8, 1.0], spending=getattr(sequential, name))
    assert [x.boundary for x in got] == pytest.approx(TABLE[name], abs=3e-4)
    assert got[-1].spent == pytest.approx(0.05, abs=1e-10)


def test_three_looks_and_one(spark):
    assert [x.boundary for x in bounds(spark, [1 / 3, 2 / 3, 1.0])] == pytest.approx([3.7103, 2.5114, 1.9930], abs=3e-4)
    assert [x.boundary for x in bounds(spark, [1.0], alpha=0.01)] == pytest.approx([2.575829], abs=1e-5)


def test_days_that_are_no_looks(spark):
    got = bounds(spark, [0.0, 0.3, 0.3005, 0.5, 0.9999, 1.0, 1.0])
    assert [x.boundary is None for x in got] == [True, False, True, False, False, False, True]
    plain = bounds(spark, [0.3, 0.5, 0.9999, 1.0])
    assert [x for x in got if x.boundary is not None] == plain
    # What is spent at a look depends on that look and earlier ones alone.
    assert bounds(spark, [0.3, 0.5])[1].spent == pytest.approx(plain[1].spent, abs=1e-9)


@pytest.mark.parametrize("looks", [[i / 10 for i in range(1, 11)], [0.01, 0.02, 0.05, 0.5, 0.51, 0.52, 0.9, 1.0]])
def test_type_one_error_of_daily_peeking(spark, looks):
    at = [x.boundary for x in bounds(spark, looks)]
    rng, runs = np.random.default_rng(11), 400_000
    path, crossed = np.zeros(runs), np.zeros(runs, bool)
    for before, t, b in zip([0.0, *looks], looks, at, strict=False):
        path += rng.normal(0, np.sqrt(t - before), runs)
        crossed |= np.abs(path) / np.sqrt(t) >= b
    assert crossed.mean() == pytest.approx(0.05, abs=0.0012)


def test_monitor_of_simulated_experiments(spark):
    """Two hundred experiments without an effect, looked at daily: few are stopped. With a fixed 1.96 a fifth would be."""
    rng, rows = np.random.default_rng(5), []
    for e in range(200):
        for day in range(1, 11):
            c, t = rng.binomial(500, 0.2, 2)
            rows.append((e, f"2024-01-{day:02d}", 500, int(c), 500, int(t)))
    daily = spark.createDataFrame(rows, "experiment_name int, day string, control_n bigint, control_conversions bigint, treatment_n bigint, treatment_conversions bigint")
    designs = spark.createDataFrame([(e, 0.2, 0.022) for e in range(200)], "experiment_name int, baseline_rate double, mde double")
    planned = experiments.planned_sizes(designs)
    assert 10_000 < planned.first().planned_n < 11_000
    out = experiments.monitor_columns(daily, planned).cache()
    assert out.count() == 2_000 and out.where("boundary is null").count() == 0
    stopped = out.groupBy("experiment_name").agg(F.max("stopped").alias("s"), F.max(F.abs("z_statistic") >= 1.96).alias("fixed")).agg(F.sum(F.col("s").cast("int")), F.sum(F.col("fixed").cast("int"))).first()
    assert stopped[0] <= 20 < 25 <= stopped[1]
    # An effect of the planned size is found, mostly before the end.
    effect = daily.withColumn("treatment_conversions", F.col("treatment_conversions") + 20)
    found = experiments.monitor_columns(effect, planned).groupBy("experiment_name").agg(F.max("stopped").alias("s"))
    assert found.where("s").count() > 180
