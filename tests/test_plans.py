"""Plan shape, invariants, files, streams and the full runs."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortry import scratch_path, streaming
from cohortry.operators import churn, cleaning, experiments, features, ordering, sentiment
from cohortry.plans import insights, run_insights, run_medallion
from cohortry.sources import files
from cohortry.sources.tables import ab_events_view, customers_view, experiment_columns, reviews_view, table
from cohortry.workload.files import CSV_SCHEMAS, export_sources

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_expressions(spark):
    events = cleaning.clean_ab_events(ab_events_view(spark, FOLDER))
    gold = features.build_gold(cleaning.clean_customers(customers_view(spark, FOLDER)), events)
    for df in (sentiment.add_sentiment(reviews_view(spark, FOLDER)), experiments.conversion_test(events), gold):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_report_uses_one_exchange(spark):
    shape = plan(experiments.experiment_report(ab_events_view(spark, FOLDER)))
    assert shape.count("Exchange") == 1


def test_scans_are_pruned(spark):
    shape = plan(experiments.conversion_test(ab_events_view(spark, FOLDER)))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in shape


def test_dedup_limits_groups_before_shuffle(spark):
    shape = plan(cleaning.keep_first(table(spark, FOLDER, "events"), ["user_id"], ["ts"]))
    assert shape.index("Final") < shape.index("Exchange") < shape.index("Partial")


def test_keep_first_with_hot_key(spark):
    rows = [(1, i) for i in range(5000)] + [(i, 0) for i in range(2, 50)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    got = {r.k: r.v for r in cleaning.keep_first(df, ["k"], ["v"]).collect()}
    assert len(got) == 49 and set(got.values()) == {0}


def test_split_is_exact_and_stable(spark):
    df = spark.range(10_007).withColumn("churned", F.when(F.col("id") % 3 == 0, 1).otherwise(0))
    a = churn.stratified_split(df, "churned", ["id"])
    counts = {(r.churned, r.fold): r["count"] for r in a.groupBy("churned", "fold").count().collect()}
    for label, n in ((1, 3336), (0, 6671)):
        assert counts[(label, "test")] == int(n * 0.2)
        assert counts[(label, "test")] + counts[(label, "validation")] == int(n * 0.3 + 1e-9)
    b = churn.stratified_split(df.repartition(13), "churned", ["id"])
    assert a.select("id", "fold").exceptAll(b.select("id", "fold")).count() == 0


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None)], "id int, churned int")
    folds = churn.stratified_split(df, "churned", ["id"]).collect()
    assert len(folds) == 4 and {r.fold for r in folds} == {"train"}


def test_sample_by_hash_ignores_partitioning(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2)
    a = ordering.first_by_hash(df, ["g"], ["id"], 100)
    b = ordering.first_by_hash(df.repartition(7), ["g"], ["id"], 100)
    assert a.count() == 200 and a.exceptAll(b).count() == 0
    assert ordering.first_by_hash(df, [], ["id"], 50).count() == 50


def test_empty_inputs(spark):
    none = ab_events_view(spark, FOLDER).limit(0)
    assert experiments.conversion_test(none).count() == 0
    assert experiments.experiment_report(none).count() == 0
    assert sentiment.add_sentiment(reviews_view(spark, FOLDER).limit(0)).count() == 0
    assert churn.auc(spark.createDataFrame([], "churn_probability double, churned int")).count() == 0


def test_adjusted_p_values_invariants(spark):
    rng = np.random.default_rng(9)
    p = np.where(rng.random(2000) < 0.33, 0.05, rng.random(2000) ** 2)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(p)], "i int, p_value double")
    got = {r.i: r for r in experiments.adjust_p_values(df).collect()}
    order = np.argsort(p, kind="stable")
    raw = p[order] * len(p) / np.arange(1, len(p) + 1)
    want = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1)
    assert np.allclose([got[int(i)].p_bh for i in order], want, atol=1e-12)
    assert all(r.p_bh <= r.p_bonferroni + 1e-12 for r in got.values())


def test_bronze_and_optional_files(spark):
    base = scratch_path(spark, "t-files")
    files.write_csv(reviews_view(spark, FOLDER), f"{base}/reviews.csv")
    bronze, rows = files.ingest_bronze(spark, f"{base}/reviews.csv", base, "reviews", as_of="2024-01-01 00:00:00")
    assert rows == bronze.count() == reviews_view(spark, FOLDER).count()
    assert dict(bronze.dtypes)["verified_purchase"] == "boolean" and dict(bronze.dtypes)["rating"] == "int"
    found = files.load_optional(spark, {"a": f"{base}/reviews.csv", "b": f"{base}/none.json", "c": "no_such_table"})
    assert found["a"].count() == rows and found["b"] is None and found["c"] is None
    report = features.quality_report(spark, [("bronze", "reviews", f"{base}/reviews"), ("gold", "x", f"{base}/none")])
    assert {r.table_name: (r.status, r.n_columns) for r in report.collect()} == {"reviews": ("ok", 10), "x": ("unreadable", None)}


def test_json_sink_has_no_nan(spark):
    path = scratch_path(spark, "t-json")
    df = spark.createDataFrame([(1.0, float("nan")), (float("inf"), 2.0)], "a double, b double").select("a", F.struct("b").alias("s"))
    files.write_json_results(df, path)
    lines = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in spark.read.text(path).collect())
    assert lines == ['{"a": 1.0, "s": {"b": null}}', '{"a": null, "s": {"b": 2.0}}']


def test_model_round_trip_and_json_scoring(spark):
    rows, names = churn.prepare(features.build_gold(customers_view(spark, FOLDER), ab_events_view(spark, FOLDER)).drop("_feature_timestamp"))
    model = churn.train(rows.filter("fold = 'train'"), names, kind="logistic", max_iter=5)
    path = scratch_path(spark, "t-model")
    churn.save_model(model, path)
    again = churn.score(churn.load_model(path), rows)
    assert again.count() == rows.count() and again.filter("churn_probability < 0 or churn_probability > 1").count() == 0
    body = rows.limit(1).select(F.to_json(F.struct(F.array(*names).alias("features"))).alias("body"))
    nested = body.select(F.regexp_replace(F.regexp_replace("body", r"\[", "[["), r"\]", "]]").alias("body"))
    twice = body.select(F.regexp_replace(F.regexp_replace("body", r"\[(.*)\]", "[[$1],[$1]]"), "nothing", "").alias("body"))
    bodies = body.union(nested).union(twice).union(spark.createDataFrame([("{}",)], "body string"))
    replies = churn.score_json(model, bodies, "body", names).collect()
    first = json.loads(replies[0].response)
    assert set(first) == {"churn_probability", "predicted_class", "risk_level"}
    assert all(json.loads(r.response) == first for r in replies[:4]) and [r.row for r in replies[:4]] == [0, 0, 0, 1]
    assert replies[4].response is None


def test_medallion_and_insights(spark):
    out = scratch_path(spark, "t-run")
    layers = run_medallion(spark, export_sources(spark, FOLDER), f"{out}/layers", CSV_SCHEMAS)
    assert layers.rows["silver/customers"] == layers.gold.count() == layers.customers.count()
    assert layers.rows["bronze/ab_events"] > layers.rows["silver/ab_events"]
    gold = layers.gold.drop("dq_valid", "_processed_at", "_feature_timestamp")
    tables = run_insights(spark, gold, layers.reviews, layers.ab_events, f"{out}/results", kind="logistic", max_iter=5)
    assert {r.metric for r in tables.summary.collect()} >= {"NLP Accuracy", "A/B Test Result", "Churn Model AUC-ROC", "Revenue at Risk"}
    written = spark.read.text(f"{out}/results/executive_report.md", wholetext=True)
    assert "Review summary" in " ".join(r.value for r in written.collect())
    assert tables.confusion.agg(F.sum("n")).first()[0] <= layers.reviews.count()


def test_stream_equals_batch_over_micro_batches(spark):
    base = scratch_path(spark, "t-stream")
    events = table(spark, FOLDER, "events").orderBy("ts")
    doubled = events.unionByName(events.limit(200)).orderBy("ts").coalesce(1).repartitionByRange(4, "ts")
    doubled.write.parquet(f"{base}/in")
    source = streaming.read_event_stream(spark, f"{base}/in", events.schema, max_files=1)
    cleaned = streaming.clean_event_stream(experiment_columns(source), watermark="60 days")
    got = streaming.run_to_table(cleaned, f"{base}/out", f"{base}/ck").select("event_id", "group", "revenue_inr", "converted")
    want = cleaning.clean_ab_events(experiment_columns(events)).select("event_id", "group", "revenue_inr", "converted")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


PLANS = [("exp_a", 5_882), ("exp_b", 500), ("exp_c", None)]


def days_of_micro_batches(spark, path):
    """The events in 20 files by time; copies of a tenth of the events arrive three days and more late, some twice in a file."""
    events = table(spark, FOLDER, "events").toPandas().sort_values("ts").reset_index(drop=True)
    arrival = events.copy()
    arrival["at"] = arrival["ts"]
    late = events.iloc[::10].copy()
    late["at"] = late["ts"] + pd.Timedelta(days=3)
    # An event itself that is five days late, and a copy within the hour.
    arrival.loc[arrival.index % 97 == 0, "at"] += pd.Timedelta(days=5)
    soon = events.iloc[::25].copy()
    soon["at"] = soon["ts"] + pd.Timedelta(minutes=40)
    everything = pd.concat([arrival, late, soon, late.iloc[::2]]).sort_values("at").reset_index(drop=True)
    schema = table(spark, FOLDER, "events").schema
    size = -(-len(everything) // 20)
    for i in range(20):
        spark.createDataFrame(everything.iloc[i * size : (i + 1) * size].drop(columns="at"), schema).coalesce(1).write.mode("append").parquet(path)
    return events, schema


def test_live_monitor_over_micro_batches(spark):
    base = scratch_path(spark, "t-live")
    _, schema = days_of_micro_batches(spark, f"{base}/in")
    planned = spark.createDataFrame(PLANS, "experiment_name string, planned_n bigint")
    source = experiment_columns(streaming.read_event_stream(spark, f"{base}/in", schema, max_files=1))
    live = streaming.live_monitor(source, f"{base}/live", f"{base}/ck", planned)
    events = cleaning.clean_ab_events(experiment_columns(spark.read.schema(schema).parquet(f"{base}/in")))
    batch = experiments.sequential_monitor(events, planned)
    assert live.count() == batch.count() > 0 and live.select(batch.columns).exceptAll(batch).count() == 0
    silver = streaming.merged_events(source, f"{base}/live")
    assert silver.exceptAll(events.select(silver.columns)).count() == 0 and silver.count() == events.count()
    # A batch that runs again, as after a failure, changes nothing; one that comes once more under a new number neither.
    again = experiment_columns(spark.read.schema(schema).parquet(f"{base}/in").where("event_id < 400"))
    streaming.merge_events(again, f"{base}/live", 100)
    streaming.merge_events(again, f"{base}/live", 100)
    totals = spark.read.parquet(f"{base}/live/totals")
    counted = totals.agg(F.sum(F.col("control_n") + F.col("treatment_n"))).first()[0]
    assert counted == events.count()
    # Without a plan there is no boundary; before the plan is complete a day's row is final.
    assert batch.where("experiment_name = 'exp_c' and (boundary is not null or crossed)").count() == 0
    early = experiments.sequential_monitor(events.where("timestamp < '2024-01-11'"), planned)
    assert early.exceptAll(batch).count() == 0 and early.where("boundary is not null").count() > 5


def test_closed_days_of_a_stream(spark):
    base = scratch_path(spark, "t-closed")
    events, schema = days_of_micro_batches(spark, f"{base}/in")
    source = experiment_columns(streaming.read_event_stream(spark, f"{base}/in", schema, max_files=1))
    counts = streaming.windowed_arm_counts(streaming.clean_event_stream(source, watermark="6 days"))
    got = streaming.closed_windows(counts, f"{base}/out", f"{base}/ck").select("window_start", "experiment_name", "group", "n", "conversions")
    clean = cleaning.clean_ab_events(experiment_columns(spark.createDataFrame(events, schema)))
    last = clean.agg(F.max("timestamp") - F.expr("interval 6 days")).first()[0]
    want = streaming.windowed_arm_counts(clean).where(F.col("window_end") <= F.lit(last)).select(got.columns)
    assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0


def test_insights_read_their_inputs_once(spark):
    """Features and events are plans of joins and windows: each is computed once for all analyses."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    events = cleaning.clean_ab_events(ab_events_view(spark, FOLDER)).drop("_processed_at")
    tables = insights.analyse_experiments(events.mapInPandas(counted, events.schema))
    assert all(t.count() > 0 for t in tables.values())
    assert read.value == events.count()
    rows = spark.range(400).selectExpr("id as customer_id", "int(id % 3 = 0) as churned", "double(id % 7) as a", "double(id % 11) as monthly_spend_inr", "string(id % 4) as state")
    before = read.value
    tables = insights.model_churn(rows.mapInPandas(counted, rows.schema), "logistic", 3)
    assert all(t.count() > 0 for t in tables.values())
    assert read.value - before == 400
