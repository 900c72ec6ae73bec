"""Churn preparation, evaluation and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.operators import churn
from cohortry.operators.metrics import best_run
from cohortry.operators.ordering import first_by_hash
from cohortry.session import scratch_path, settle
from cohortry.sources.tables import customers_view, table
from cohortry.workload.base import query
from cohortry.workload.cleaning import clean_customers, gold
from cohortry.workload.metrics import scored_customers

SPLIT = """split as (select *, row_number() over (partition by churned order by md5('42:' || customer_id))::double / count(*) over (partition by churned) as part from v_customers),
      folds as (select *, case when part <= 0.2 then 'test' when part <= 0.3 then 'validation' else 'train' end as fold from split)"""


@query(
    """select customer_id, cast(dense_rank() over (order by state) - 1 as int) as state, cast(dense_rank() over (order by preferred_category) - 1 as int) as preferred_category,
         cast(dense_rank() over (order by seg) - 1 as int) as tenure_segment from
         (select *, case when tenure_days <= 0 then 'nan' when tenure_days <= 90 then 'new' when tenure_days <= 180 then 'growing' when tenure_days <= 365 then 'established'
             when tenure_days <= 730 then 'loyal' when tenure_days > 730 then 'champion' else 'nan' end as seg from v_customers)""",
    "customers",
)
def category_codes(spark, d):
    from cohortry.functions import cut
    from cohortry.operators.features import TENURE_EDGES, TENURE_LABELS

    view = customers_view(spark, d).withColumn("tenure_segment", cut(F.col("tenure_days"), TENURE_EDGES, TENURE_LABELS))
    rows = settle(view.select("customer_id", "state", "preferred_category", "tenure_segment"))
    return churn.encode_categories(rows)


@query(
    """select c_custkey as customer_id, cast(dense_rank() over (order by c_name) - 1 as int) as c_name,
         cast(dense_rank() over (order by alias) - 1 as int) as alias, cast(dense_rank() over (order by c_mktsegment) - 1 as int) as c_mktsegment
       from (select *, case when c_custkey % 3 = 0 then 'nan' else md5(c_name) end as alias from customer)"""
)
def category_codes_of_names(spark, d):
    """Columns with a value a row, one of them null in a third of the rows."""
    rows = table(spark, d, "customer").withColumn("alias", F.when(F.col("c_custkey") % 3 != 0, F.md5("c_name")))
    named = rows.select(F.col("c_custkey").alias("customer_id"), "c_name", "alias", "c_mktsegment")
    return churn.encode_categories(named, ["c_name", "alias", "c_mktsegment"])


@query(
    """select customer_id, coalesce(tenure_days, (select median(tenure_days) from v_customers))::double as tenure_days,
         coalesce(email_open_rate, (select median(email_open_rate) from v_customers)) as email_open_rate,
         coalesce(last_login_days_ago, (select median(last_login_days_ago) from v_customers))::double as last_login_days_ago from v_customers""",
    "customers",
)
def median_imputation(spark, d):
    columns = ["tenure_days", "email_open_rate", "last_login_days_ago"]
    return churn.impute_medians(customers_view(spark, d).select("customer_id", *columns), columns)


@query(f"with {SPLIT} select customer_id, churned, fold from folds", "customers")
def stratified_split(spark, d):
    return churn.stratified_split(customers_view(spark, d).select("customer_id", "churned"), "churned", ["customer_id"])


@query(
    """with s as (select *, row_number() over (partition by l_returnflag order by md5('7:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey))::double / count(*) over (partition by l_returnflag) as part from lineitem)
       select l_returnflag, case when part <= 0.2 then 'test' when part <= 0.3 then 'validation' else 'train' end as fold, count(*) as n, round(sum(l_extendedprice), 2) as total from s group by all"""
)
def stratified_split_lineitem(spark, d):
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", *ids)
    folded = churn.stratified_split(rows, "l_returnflag", ids, seed=7)
    return folded.groupBy("l_returnflag", "fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


SCALED = ("monthly_spend_inr", "total_orders", "support_tickets")


@query(
    f"""with {SPLIT}, f as (select {", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(SCALED))} from folds where fold = 'train')
       select customer_id, fold, {", ".join(f"round(({c} - m{i}) / case when s{i} > 0 then s{i} else 1 end, 6) as {c}" for i, c in enumerate(SCALED))} from folds, f""",
    "customers",
)
def standardised_features(spark, d):
    folded = churn.stratified_split(customers_view(spark, d).select("customer_id", "churned", *SCALED), "churned", ["customer_id"])
    out = churn.standardise(folded, SCALED, F.col("fold") == "train")
    return out.select("customer_id", "fold", *[F.round(c, 6).alias(c) for c in SCALED])


@query(f"with {SPLIT} select fold, count(*) as n, round(avg(churned), 6) as positive_rate from folds group by fold", "customers")
def class_balance_by_fold(spark, d):
    folded = churn.stratified_split(customers_view(spark, d).select("customer_id", "churned"), "churned", ["customer_id"])
    out = churn.class_balance(folded, "churned", ["fold"])
    return out.withColumn("positive_rate", F.round("positive_rate", 6))


@query("select customer_id, " + ", ".join(f"coalesce({c}::double, 0) as {c}" for c in SCALED) + " from s_customers", "customers clean_customers")
def assembled_vectors(spark, d):
    """Vectors of the scaled columns, taken apart again."""
    from pyspark.ml.functions import vector_to_array

    view = clean_customers(spark, d).na.fill(0, list(SCALED))
    parts = churn.assemble(view.select("customer_id", *SCALED), SCALED).withColumn("_v", vector_to_array("features"))
    return parts.select("customer_id", *[F.col("_v")[i].alias(c) for i, c in enumerate(SCALED)])


AUC_SQL = """r as (select {k} p, churned, rank() over ({o} order by p) + (count(*) over ({t} p) - 1) / 2.0 as rk from v_scored),
      a as (select {k} (sum(case when churned = 1 then rk end) - count(case when churned = 1 then 1 end) * (count(case when churned = 1 then 1 end) + 1) / 2.0)
        / nullif(count(case when churned = 1 then 1 end) * count(case when churned = 0 then 1 end), 0) as auc,
        count(case when churned = 1 and p >= 0.5 then 1 end)::double as tp, count(case when p >= 0.5 then 1 end) as pp, count(case when churned = 1 then 1 end) as ap from r {g})
    select {k} round(auc, 4)::double as auc_roc, round(case when pp > 0 then tp / pp else 0 end, 4) as "precision", round(case when ap > 0 then tp / ap else 0 end, 4) as recall,
      round(case when pp + ap > 0 then 2 * tp / (pp + ap) else 0 end, 4) as f1 from a"""


@query("with " + AUC_SQL.format(k="", o="", t="partition by", g=""), "customers scored")
def churn_test_metrics(spark, d):
    return churn.test_metrics(scored_customers(spark, d), "p")


@query(
    "with " + AUC_SQL.format(k="preferred_category,", o="partition by preferred_category", t="partition by preferred_category,", g="group by preferred_category"),
    "customers scored",
)
def churn_metrics_by_category(spark, d):
    return churn.test_metrics(scored_customers(spark, d), "p", keys=["preferred_category"])


@query(
    """with s as (select l_returnflag, l_extendedprice as p, case when l_discount > 0.05 then 1 else 0 end as y from lineitem),
         r as (select *, rank() over (partition by l_returnflag order by p) + (count(*) over (partition by l_returnflag, p) - 1) / 2.0 as rk from s)
       select l_returnflag, round((sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6)::double as auc_roc from r group by l_returnflag"""
)
def auc_price_discount(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("y"))
    return churn.auc(rows, "l_extendedprice", "y", ["l_returnflag"]).withColumn("auc_roc", F.round("auc_roc", 6))


@query(
    """select customer_id, p as churn_probability, case when p >= 0.5 then 1 else 0 end as predicted_class,
         case when p >= 0.7 then 'High' when p >= 0.4 then 'Medium' else 'Low' end as risk_level, churned as true_label from v_scored""",
    "customers scored",
)
def prediction_table(spark, d):
    return churn.prediction_table(scored_customers(spark, d), "p", keep=["customer_id"])


@query(
    """select preferred_category, count(case when p >= 0.7 then 1 end) as high_risk_count,
         round(coalesce(sum(case when p >= 0.7 then monthly_spend_inr end), 0), 2) as spend_at_risk from v_scored group by preferred_category""",
    "customers scored",
)
def spend_at_risk_by_category(spark, d):
    return churn.spend_at_risk(scored_customers(spark, d), "p", keys=["preferred_category"])


# ---------------------------------------------------------------- models


def prepared(spark, d):
    return churn.prepare(gold(spark, d))


def fold(df, name):
    return df.filter(F.col("fold") == name)


@query()
def churn_model_predictions(spark, d):
    """Neural network trained on the training fold, every customer of the test fold scored."""
    rows, features = prepared(spark, d)
    model = churn.train(fold(rows, "train"), features, kind="mlp", max_iter=25)
    scored = churn.score(model, fold(rows, "test"))
    return churn.prediction_table(scored, keep=["customer_id"])


@query()
def churn_model_selection(spark, d):
    """Candidates compared on the validation fold, runs logged, the best read back and tested."""
    rows, features = prepared(spark, d)
    train_rows, path = fold(rows, "train"), scratch_path(spark, "runs")
    models = {
        "logistic": churn.train(train_rows, features, kind="logistic"),
        "gbt": churn.train(train_rows, features, kind="gbt", max_iter=5),
        "mlp": churn.train(train_rows, features, kind="mlp", max_iter=10),
    }
    name, model, aucs = churn.select_model(models, fold(rows, "validation"))
    for kind, value in aucs.items():
        churn.log_run(spark, path, kind, {"model": kind, "features": len(features)}, {"val_auc": value})
    best = best_run(churn.run_metrics(spark.read.parquet(path), "val_auc"), "val_auc")
    churn.save_model(model, scratch_path(spark, "model"))
    tested = churn.test_metrics(churn.score(model, fold(rows, "test")))
    return tested.withColumn("run_id", best.select("run_id").scalar()).withColumn("selected", F.lit(name))


@query()
def churn_training_history(spark, d):
    """Losses and validation AUC of each epoch of a small network, and which epoch's weights were kept."""
    rows, features = prepared(spark, d)
    path = scratch_path(spark, "epochs")
    _, history = churn.train_epochs(
        fold(rows, "train"), features, path, fold(rows, "validation"), run_id="churn", epochs=8, iterations=6, patience=3, layers=(32, 16)
    )
    best = churn.best_of_epochs(history).select("epoch").scalar()
    return history.withColumn("kept", F.col("epoch") == best)


LINEAR = {"monthly_spend_inr": 0.002, "total_orders": -0.7, "support_tickets": 1.5, "tenure_days": -0.01}


@query(
    f"""with rows as (select customer_id, {", ".join(f"coalesce({c}::double, 0) as {c}" for c in LINEAR)} from v_customers),
         background as (select * from rows order by md5('42:' || customer_id), customer_id limit 16),
         means as (select {", ".join(f"avg({c}) as {c}" for c in LINEAR)} from background)
       select customer_id, feature, round(attribution, 6) as attribution from (
         {" union all ".join(f"select r.customer_id, '{c}' as feature, {w} * (r.{c} - m.{c}) as attribution from rows r, means m" for c, w in LINEAR.items())}
         union all select customer_id, '(base)', {" + ".join(f"{w} * m.{c}" for c, w in LINEAR.items())} from rows, means m)""",
    "customers",
)
def shapley_values_linear(spark, d):
    """A linear score: the sampled Shapley values are the weights times the distances from the background's means."""
    rows = customers_view(spark, d).select("customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in LINEAR])
    background = first_by_hash(rows, [], ["customer_id"], 16)
    linear = lambda df: df.withColumn("_p", sum((F.col("_x")[i] * w for i, w in enumerate(LINEAR.values())), F.lit(0.0)))
    out = churn.shapley_values(linear, rows, list(LINEAR), background, orders=2)
    return out.withColumn("attribution", F.round("attribution", 6) + 0.0)


@query()
def shapley_importance(spark, d):
    """Mean absolute Shapley value of the logistic churn model's features over the test fold."""
    rows, features = prepared(spark, d)
    model = churn.train(fold(rows, "train"), features, kind="logistic")
    background = first_by_hash(fold(rows, "train").select("customer_id", *features), [], ["customer_id"], 8)
    values = churn.shapley_values(churn.model_predictor(model), fold(rows, "test"), features, settle(background), orders=1)
    return churn.top_importance(churn.shapley_importance(values), 8)


@query()
def permutation_importance(spark, d):
    rows, features = prepared(spark, d)
    model = churn.train(fold(rows, "train"), features, kind="logistic")
    return churn.top_importance(churn.permutation_importance(model, fold(rows, "test"), features), 8)


@query()
def gradient_importance(spark, d):
    rows, features = prepared(spark, d)
    model = churn.train(fold(rows, "train"), features, kind="logistic")
    return churn.top_importance(churn.gradient_importance(model, fold(rows, "test"), features), 8)


@query()
def json_scoring(spark, d):
    rows, features = prepared(spark, d)
    model = churn.train(fold(rows, "train"), features, kind="logistic")
    bodies = rows.select("customer_id", F.to_json(F.struct(F.array(*features).alias("features"))).alias("body"))
    return churn.score_json(model, bodies, "body", features).drop("body")
