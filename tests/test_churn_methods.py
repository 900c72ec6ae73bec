"""Category dictionaries, radix thresholds, training history and Shapley values."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.operators import churn, metrics, ordering
from cohortry.session import scratch_path


def test_codes_of_a_value_a_row(spark):
    rows = spark.range(5_000).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("kind"))
    out = churn.encode_categories(rows, ["name", "kind", "absent"]).collect()
    names, kinds = sorted(f"n{i}" for i in range(5_000)), sorted([*map(str, range(7)), "nan"])
    assert all(r.name == names.index(f"n{r.id}") for r in out[:300]) and sorted(r.name for r in out) == list(range(5_000))
    assert all(r.kind == kinds.index("nan" if r.id % 3 == 0 else str(r.id % 7)) for r in out)
    plan = churn.category_dictionary(rows, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_unseen_values_share_a_code(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a"), (3, "new"), (4, None), (5, "newer")], "id int, kind string")
    out = {r.id: r.kind for r in churn.encode_categories(rows, ["kind"], fit_on=rows.where("id <= 2")).collect()}
    assert out == {1: 1, 2: 0, 3: 2, 4: 2, 5: 2}


@pytest.mark.parametrize("ranked", [100_000, 20, 1])
def test_radix_thresholds(spark, monkeypatch, ranked):
    """The same cuts whatever a task may rank; equal hashes stay together."""
    monkeypatch.setattr(ordering, "RANKED", ranked)
    monkeypatch.setattr(ordering, "HEX_DIGITS", 1)
    rng = random.Random(3)
    rows = [(g, "%032x" % rng.getrandbits(128)) for g in ("a", "b", None) for _ in range(400)] + [("same", "ab" * 16)] * 300 + [("one", "cd" * 16)]
    hashed = spark.createDataFrame(rows, "g string, _h string")
    got = {r.g: (r.x, r.y) for r in ordering.hash_thresholds(hashed, ["g"], {"x": 0.2, "y": 0.3}).collect()}
    for g in ("a", "b", None):
        own = sorted(h for k, h in rows if k == g)
        assert got[g] == (own[79], own[119])
    assert got["same"] == ("ab" * 16, "ab" * 16) and "one" not in got


def test_null_class_is_split(spark):
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).alias("label"))
    counts = {(r.label, r.fold): r.n for r in churn.stratified_split(rows, "label", ["id"]).groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    assert counts == {(k, f): n for k in (None, 1, 2) for f, n in (("test", 200), ("validation", 100), ("train", 700))}


@pytest.fixture(scope="module")
def planted(spark):
    """A label that two of four features decide, with noise."""
    x = [F.rand(seed).alias(f"x{i}") for i, seed in enumerate((1, 2, 3, 4))]
    rows = spark.range(1_500, numPartitions=2).select("id", *x).withColumn("churned", ((F.col("x0") * 4 - F.col("x1") * 3 + F.rand(9) * 0.5) > 0.8).cast("int"))
    return rows.withColumn("fold", F.when(F.col("id") % 5 == 0, "validation").otherwise("train")).cache()


def test_history_and_best_epoch(spark, planted):
    path, names = scratch_path(spark, "t-epochs"), ["x0", "x1", "x2", "x3"]
    held = planted.where("fold = 'validation'")
    model, history = churn.train_epochs(planted.where("fold = 'train'"), names, path, held, run_id="r", epochs=6, iterations=8, patience=2, layers=(8,))
    rows = sorted(history.collect(), key=lambda r: r.epoch)
    assert [r.epoch for r in rows] == list(range(1, len(rows) + 1)) and rows[-1].train_loss < rows[0].train_loss
    best = churn.best_of_epochs(history).first()
    top = max(r.val_auc for r in rows)
    assert best.val_auc == top > 0.8 and best.epoch == min(r.epoch for r in rows if r.val_auc == top)
    assert len(rows) == 6 or len(rows) - best.epoch == 2
    # The returned network is that of the best epoch, and the run table's best run agrees.
    scored = churn.score(model, held)
    assert churn.auc(scored).first().auc_roc == pytest.approx(top, abs=1e-12)
    assert scored.agg(churn.log_loss("churn_probability", "churned")).first()[0] == pytest.approx(rows[best.epoch - 1].val_loss, abs=1e-9)
    runs = history.select(F.col("epoch").cast("string").alias("run_id"), "val_auc")
    assert metrics.best_run(runs, "val_auc").first().run_id == str(best.epoch)


def slow_shapley(f, x, background):
    n, out = len(x), np.zeros(len(x))
    orders = list(itertools.permutations(range(n)))
    for b in background:
        for order in orders:
            mixed = list(b)
            for i in order:
                before = f(mixed)
                mixed[i] = x[i]
                out[i] += f(mixed) - before
    return out / len(orders) / len(background), np.mean([f(b) for b in background])


def test_shapley_by_enumeration(spark, planted):
    names = ["x0", "x1", "x2", "x3"]
    model = churn.train(planted.where("fold = 'train'"), names, kind="logistic")
    weights, bias = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    f = lambda v: 1 / (1 + np.exp(-(np.dot(weights, v) + bias)))
    rows, background = planted.where("id < 6"), planted.where("id between 100 and 104")
    got = churn.shapley_values(churn.model_predictor(model), rows, names, background, ids=["id"], orders=None).collect()
    values = {(r.id, r.feature): r.attribution for r in got}
    others = [[r[c] for c in names] for r in background.collect()]
    for r in rows.collect():
        want, base = slow_shapley(f, [r[c] for c in names], others)
        assert [values[r.id, c] for c in names] == pytest.approx(list(want), abs=1e-9)
        assert values[r.id, "(base)"] == pytest.approx(base, abs=1e-9)
    sampled = churn.shapley_values(churn.model_predictor(model), rows, names, background, ids=["id"], orders=3)
    sums = {r.id: r.s for r in sampled.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    for r in churn.score(model, rows).collect():
        assert sums[r.id] == pytest.approx(r.churn_probability, abs=1e-9)
    top = [r.feature for r in churn.shapley_importance(sampled).orderBy(F.desc("importance")).limit(2).collect()]
    assert set(top) == {"x0", "x1"}


def test_background_is_bounded(spark, planted):
    with pytest.raises(ValueError):
        churn.shapley_values(lambda df: df, planted, ["x0"], planted, ids=["id"])


def test_preparation_reads_its_input_once(spark):
    """The input is a plan of joins: the split, the codes and the scaling read what was written of it."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(400).selectExpr("id as customer_id", "int(id % 3 = 0) as churned", "double(id % 7) as a", "if(id % 5 = 0, null, double(id)) as b", "string(id % 4) as state")
    prepared, features = churn.prepare(rows.mapInPandas(counted, rows.schema))
    assert (prepared.count(), sorted(features)) == (400, ["a", "b", "state"])
    assert prepared.filter("a is null or b is null").count() == 0
    assert read.value == 400


def test_medians_of_columns_with_gaps_only(spark):
    rows = spark.createDataFrame([(1, 1.0, float("nan")), (2, 4.0, 3.0), (None, 2.0, 5.0)], "a int, b double, c double")
    got = churn.impute_medians(rows, ["a", "b", "c"])
    assert [t for _, t in got.dtypes] == ["double"] * 3
    assert sorted(map(tuple, got.collect())) == [(1.0, 1.0, 4.0), (1.5, 2.0, 5.0), (2.0, 4.0, 3.0)]
