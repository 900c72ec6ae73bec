"""Churn modelling: preparation, training, scoring, evaluation, importance."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import permutations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.functions.scalars import risk_level
from cohortry.operators.ordering import exact_medians, hash_thresholds, key_hash, match, range_pieces
from cohortry.session import one_row, scratch_path, settle

CATEGORICAL = ("city", "state", "preferred_category", "payment_method", "tenure_segment")
HIDDEN_LAYERS = (256, 128, 64, 32)


# ---------------------------------------------------------------- preparation


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_column _value _code``: the distinct values of each column numbered from 0 in the order of their bytes.

    Distinct values are range-partitioned and numbered within their piece; the counts of earlier pieces come before. No
    task holds more than a piece of a column's values and none of them pass through the driver.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("_column"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("_value")) for c in columns])
    distinct = df.select(F.inline(pairs)).distinct()
    pieces = settle(range_pieces(distinct, "_column", "_value"), "categories")
    earlier = Window.partitionBy("_column").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("_column", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_column", "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_column", "_piece").orderBy("_value"))
    numbered = pieces.withColumn("_place", place).join(offsets, ["_column", "_piece"])
    return settle(numbered.select("_column", "_value", (F.col("_before") + F.col("_place") - 1).cast("int").alias("_code")), "category-codes")


def encode_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL, fit_on: DataFrame | None = None) -> DataFrame:
    """Integer codes in alphabetical order; null is the category ``nan``.

    Fitting on the training rows (``fit_on``) gives values unseen there one extra code per column. The dictionary is joined
    by value: it is broadcast only if its measured size allows.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    codes = category_dictionary(fit_on if fit_on is not None else df, present)
    sizes = one_row(codes, *[F.count_if(F.col("_column") == c).cast("int").alias(c) for c in present])
    out = df.withColumn("_sizes", sizes)
    for c in present:
        own = codes.filter(F.col("_column") == c).select(F.col("_value").alias(f"_{c}_value"), F.col("_code").alias(f"_{c}_code"))
        out = out.join(own, F.coalesce(F.col(c).cast("string"), F.lit("nan")) == F.col(f"_{c}_value"), "left")
    coded = {c: F.coalesce(F.col(f"_{c}_code"), F.col("_sizes")[c]) for c in present}
    return out.withColumns(coded).select(*df.columns)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [n for n, t in df.dtypes if n not in exclude and (t in kinds or t.startswith("decimal"))]


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and NaN become the exact column median; only columns that hold any are ranked."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    gaps = df.agg(*[F.count_if(value(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if gaps[c]]
    cast = df.withColumns({c: F.col(c).cast("double") for c in columns})
    if not missing:
        return cast
    filled = cast.withColumn("_m", exact_medians(df, missing).select(F.struct(*missing)).scalar())
    return filled.withColumns({c: F.coalesce(value(c), F.col("_m")[c]) for c in missing}).drop("_m")


def stratified_split(
    df: DataFrame, label: str, ids: Sequence[str], test: float = 0.2, validation: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add ``fold``: the first rows of each class in hash order are test, the next validation, the rest train.

    Exact to the row per class and independent of partitioning. Only the two thresholds per class are
    searched for; assigning the fold is a map-side comparison, so no class is ever shuffled.
    """
    hashed = df.withColumn("_h", key_hash(*ids, seed=seed))
    cuts = hash_thresholds(
        hashed.select(label, "_h"), [label], {"_test": test, "_validation": round(test + validation, 12)}
    )
    # Thresholds per class; a class without any cut has no row and is training data.
    fold = F.when(F.col("_h") <= F.col("_test"), "test").when(F.col("_h") <= F.col("_validation"), "validation")
    return match(hashed, cuts, [label], "left").withColumn("fold", fold.otherwise("train")).drop("_h", "_test", "_validation")


def standardise(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation of the fitting rows; constant columns stay centred."""
    rows = df.filter(fit_on) if fit_on is not None else df
    stats = one_row(rows, *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    scaled = {
        c: (F.col(c) - F.col("_f")[c]["m"]) / F.when(F.col("_f")[c]["s"] > 0, F.col("_f")[c]["s"]).otherwise(1.0)
        for c in columns
    }
    return df.withColumn("_f", stats).withColumns(scaled).drop("_f")


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(df)


def class_balance(df: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("positive_rate"))


def prepare(
    df: DataFrame, ids: Sequence[str] = ("customer_id",), label: str = "churned", drop: Sequence[str] = ("name", "email", "signup_date")
) -> tuple[DataFrame, list[str]]:
    """Split, code, impute, scale and assemble; the prepared table is written once and read back.

    Category codes and scaling are fitted on the training fold.
    """
    # Settled first: the split reads its input three times, coding and scaling theirs as often.
    base = settle(df.drop(*[c for c in drop if c not in ids]).filter(F.col(label).isNotNull()), "labelled")
    folded = settle(stratified_split(base, label, ids), "folded")
    coded = settle(encode_categories(folded, fit_on=folded.filter("fold = 'train'")), "coded")
    features = [c for c in numeric_columns(coded, [*ids, label])]
    scaled = standardise(impute_medians(coded, features), features, F.col("fold") == "train")
    return settle(scaled.select(*ids, label, "fold", *features), "prepared"), features


# ---------------------------------------------------------------- training and scoring


def classifier(kind: str, n_features: int, label: str, max_iter: int = 25, seed: int = 42):
    if kind == "mlp":
        layers = [n_features, *HIDDEN_LAYERS, 2]
        return MultilayerPerceptronClassifier(layers=layers, labelCol=label, maxIter=max_iter, seed=seed)
    if kind == "gbt":
        return GBTClassifier(labelCol=label, maxIter=max_iter, seed=seed)
    if kind == "logistic":
        return LogisticRegression(labelCol=label, maxIter=max_iter, standardization=False)
    raise ValueError(f"unknown model kind {kind!r}; use mlp, gbt or logistic")


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def train(df: DataFrame, features: Sequence[str], label: str = "churned", kind: str = "mlp", **params) -> PipelineModel:
    """Fit on the rows given (normally the training fold); every round reads the assembled vectors from the shared folder."""
    assembler = _assembler(features)
    rows = settle(assembler.transform(df).select("features", label), "training-rows")
    fitted = classifier(kind, len(features), label, **params).fit(rows)
    return detached(PipelineModel(stages=[assembler, fitted]), df.sparkSession)


HISTORY = "run_id string, epoch int, train_loss double, val_loss double, val_auc double"


def log_loss(p: str | Column, label: str | Column) -> Column:
    """Mean cross-entropy; a probability of 0 or 1 counts as 1e-15 from it."""
    clipped = F.least(F.greatest(F.col(p) if isinstance(p, str) else p, F.lit(1e-15)), F.lit(1.0 - 1e-15))
    truth = F.col(label) if isinstance(label, str) else label
    return -F.avg(F.when(truth == 1, F.ln(clipped)).otherwise(F.ln(1.0 - clipped)))


def train_epochs(
    df: DataFrame,
    features: Sequence[str],
    path: str,
    validation: DataFrame,
    label: str = "churned",
    run_id: str = "run",
    epochs: int = 20,
    iterations: int = 5,
    patience: int = 4,
    layers: Sequence[int] = HIDDEN_LAYERS,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """The network of the best epoch and the history, a row for each epoch, in ``path/history``.

    An epoch is some L-BFGS iterations that start from the weights of the last one. After each its losses and its
    validation AUC are measured and written, and its weights kept if the AUC is the highest so far (the first of equals).
    Training stops after ``patience`` epochs without a better one. Vectors are assembled and written once.
    """
    spark, assembler = df.sparkSession, _assembler(features)
    rows = settle(assembler.transform(df).select("features", label), "training-rows")
    held = settle(assembler.transform(validation).select("features", label), "validation-rows")
    network = MultilayerPerceptronClassifier(layers=[len(features), *layers, 2], labelCol=label, maxIter=iterations, seed=seed)
    best, best_epoch, weights = None, 0, None
    for epoch in range(1, epochs + 1):
        if weights is not None:
            network.setInitialWeights(weights)
        model = network.fit(rows)
        weights = model.weights
        on = lambda d, m=model: m.transform(d).select(label, vector_to_array("probability")[1].alias("_p"))
        scored = settle(on(held), "validation-scores")
        loss = scored.agg(log_loss("_p", label).alias("val_loss")).withColumn("val_auc", auc(scored, "_p", label).scalar())
        row = on(rows).agg(log_loss("_p", label).alias("train_loss")).withColumn("_v", loss.select(F.struct("val_loss", "val_auc")).scalar())
        row = row.select(F.lit(run_id).alias("run_id"), F.lit(epoch).alias("epoch"), "train_loss", "_v.val_loss", "_v.val_auc")
        row.write.mode("append").parquet(f"{path}/history")
        history = spark.read.schema(HISTORY).parquet(f"{path}/history").filter(F.col("run_id") == run_id)
        at = best_of_epochs(history).first().epoch
        if at == epoch:
            best, best_epoch = model, epoch
        elif epoch - best_epoch >= patience:
            break
    if best is None:
        raise ValueError("no epoch could be judged: the validation rows need both classes")
    return detached(PipelineModel(stages=[assembler, best]), spark), history


def best_of_epochs(history: DataFrame) -> DataFrame:
    """One row a run: the epoch of the highest validation AUC, the first of equals, and the number of epochs run."""
    order = F.struct("val_auc", -F.col("epoch"))
    known = F.when(F.col("val_auc").isNotNull(), order)
    return history.groupBy("run_id").agg(
        F.max_by("epoch", known).alias("epoch"), F.max("val_auc").alias("val_auc"), F.count(F.lit(1)).alias("epochs")
    )


def detached(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model written to the shared folder and read back.

    A freshly fitted model drags its training summary, and with it the session, into every scoring task;
    the stored one holds the parameters only.
    """
    path = scratch_path(spark, "model")
    save_model(model, path)
    return load_model(path)


def score(model: Model, df: DataFrame, out: str = "churn_probability") -> DataFrame:
    """Probability of the positive class; nothing but the input columns is kept besides."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(*[c for c in df.columns if c != out], F.col("_p").alias(out))


def select_model(
    candidates: dict[str, Model], validation: DataFrame, label: str = "churned"
) -> tuple[str, Model, dict[str, float]]:
    """The candidate with the highest validation AUC (one distributed job each)."""
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    aucs = {name: judge.evaluate(model.transform(validation)) for name, model in candidates.items()}
    best = max(sorted(aucs), key=aucs.get)
    return best, candidates[best], aucs


def score_json(model: PipelineModel, df: DataFrame, body: str, features: Sequence[str], out: str = "response") -> DataFrame:
    """Scoring of JSON bodies ``{"features": [...]}`` or of lists of lists: one reply per row of features.

    ``row`` numbers the rows of a body from 0. A row of another length, and a body without features, gets a null reply.
    """
    flat = F.from_json(body, "features array<double>")["features"]
    nested = F.from_json(body, "features array<array<double>>")["features"]
    rows = F.when(F.get(nested, F.lit(0)).isNotNull(), nested).otherwise(F.array(flat))
    parsed = df.select("*", F.posexplode_outer(rows).alias("row", "_x"))
    parsed = parsed.withColumn("_x", F.when(F.size("_x") == len(features), F.col("_x")))
    spread = parsed.withColumns({c: F.col("_x")[i] for i, c in enumerate(features)})
    scored = model.transform(spread).withColumn("_p", F.when(F.col("_x").isNotNull(), vector_to_array("probability")[1]))
    reply = F.to_json(
        F.struct(
            F.col("_p").alias("churn_probability"),
            (F.col("_p") >= 0.5).cast("int").alias("predicted_class"),
            risk_level(F.col("_p")).alias("risk_level"),
        )
    )
    return scored.select(*df.columns, "row", F.when(F.col("_p").isNotNull(), reply).alias(out))


def prediction_table(df: DataFrame, p: str = "churn_probability", label: str = "churned", keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *keep,
        F.col(p).alias("churn_probability"),
        (F.col(p) >= 0.5).cast("int").alias("predicted_class"),
        risk_level(F.col(p)).alias("risk_level"),
        F.col(label).alias("true_label"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- evaluation


def auc(df: DataFrame, p: str = "churn_probability", label: str = "churned", keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per key; ties count half.

    Rows are combined to one per distinct score. Distinct scores are range-partitioned and each piece
    contributes its own pairs plus the pairs with all negatives of earlier pieces, so no task ranks more
    than its piece.
    """
    key = list(keys) or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(1))
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    scores = (
        rows.filter(F.col(p).isNotNull())
        .groupBy(*key, F.col(p).alias("_s"))
        .agg(pos.cast("double").alias("_pos"), neg.cast("double").alias("_neg"))
    )
    inside = Window.partitionBy("_piece", *key).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        range_pieces(scores, *key, "_s")
        .withColumn("_below", F.coalesce(F.sum("_neg").over(inside), F.lit(0.0)))
        .groupBy("_piece", *key)
        .agg(
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)).alias("_won"),
        )
    )
    earlier = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    ranked = pieces.withColumn("_before", F.coalesce(F.sum("_neg").over(earlier), F.lit(0.0)))
    won = F.sum(F.col("_won") + F.col("_pos") * F.col("_before"))
    return ranked.groupBy(*key).agg(F.try_divide(won, F.sum("_pos") * F.sum("_neg")).alias("auc_roc")).drop("_all")


def threshold_metrics(
    df: DataFrame, p: str = "churn_probability", label: str = "churned", threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 of the positive class; undefined values are 0."""
    hit, truth = F.col(p) >= threshold, F.col(label) == 1
    counts = df.groupBy(*keys).agg(
        F.count_if(hit & truth).alias("tp"), F.count_if(hit).alias("predicted"), F.count_if(truth).alias("actual")
    )
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return counts.select(
        *keys,
        safe(F.col("tp"), F.col("predicted")).alias("precision"),
        safe(F.col("tp"), F.col("actual")).alias("recall"),
        safe(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"),
    )


def test_metrics(df: DataFrame, p: str = "churn_probability", label: str = "churned", keys: Sequence[str] = ()) -> DataFrame:
    """AUC, precision, recall and F1, rounded to four places."""
    cut, area = threshold_metrics(df, p, label, 0.5, keys), auc(df, p, label, keys)
    if keys:
        both = match(area, cut, list(keys))
    else:
        both = cut.withColumn("auc_roc", area.scalar())
    return both.select(*keys, *[F.round(c, 4).alias(c) for c in ("auc_roc", "precision", "recall", "f1")])


def risk_summary(predictions: DataFrame, customers: DataFrame, p: str = "churn_probability", spend: str = "monthly_spend_inr") -> DataFrame:
    from cohortry.operators.metrics import revenue_at_risk

    return revenue_at_risk(customers, predictions, p, spend)


def spend_at_risk(customers: DataFrame, p: str = "churn_probability", spend: str = "monthly_spend_inr", keys: Sequence[str] = ()) -> DataFrame:
    """Per-customer variant: high-risk customers and the spend they actually have."""
    risky = F.col(p) >= 0.7
    return customers.groupBy(*keys).agg(
        F.count_if(risky).alias("high_risk_count"),
        F.round(F.coalesce(F.sum(F.when(risky, F.col(spend))), F.lit(0.0)), 2).alias("spend_at_risk"),
    )


# ---------------------------------------------------------------- importance


def gradient_importance(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute gradient of a logistic model: mean(p (1 - p)) * |w|; one aggregate over the rows."""
    weights = [abs(float(w)) for w in model.stages[-1].coefficients]
    p = F.col("churn_probability")
    slope = score(model, df).agg(F.avg(p * (1.0 - p)).alias("s"))
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).alias("w")) for f, w in zip(features, weights)])
    return slope.select("s", F.inline(rows)).select("feature", (F.col("s") * F.col("w")).alias("importance"))


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    ids: Sequence[str] = ("customer_id",),
    label: str = "churned",
    seed: int = 42,
) -> DataFrame:
    """Drop in AUC when one feature takes the values of other rows; one job for all features.

    Every row takes the value of its successor in hash order over the whole table, cyclically. The order is cut into
    range pieces; the last row of a piece takes the value of the first row of the next one. Each row then becomes one
    row per feature on the map side, is scored, and one keyed AUC compares them.
    """
    staged = df.select(label, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), key_hash(*ids, seed=seed).alias("_h"))
    pieces = settle(range_pieces(staged, "_h"), "hash-order")
    # One row for each piece.
    heads = pieces.groupBy("_piece").agg(F.min_by("_x", "_h").alias("_head"))
    along = Window.orderBy("_piece")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_piece", F.coalesce(F.lead("_head").over(along), F.first("_head").over(whole)).alias("_next"))
    order = Window.partitionBy("_piece").orderBy("_h")
    donors = pieces.withColumn("_y", F.lead("_x").over(order)).join(heads, "_piece").withColumn("_y", F.coalesce("_y", "_next"))
    variants = donors.select(
        label, "_x", "_y", F.posexplode(F.array(F.lit("(none)"), *[F.lit(f) for f in features])).alias("_i", "feature")
    )
    mixed = F.zip_with("_x", "_y", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    swapped = F.transform(mixed, lambda s, i: F.when(i == F.col("_i") - 1, s["y"]).otherwise(s["x"]))
    model_rows = variants.select(label, "feature", array_to_vector(swapped).alias("features"))
    scored = model.stages[-1].transform(model_rows).select(label, "feature", vector_to_array("probability")[1].alias("_p"))
    areas = settle(auc(scored, "_p", label, ["feature"]), "auc-by-feature")
    base = areas.filter("feature = '(none)'").select("auc_roc").scalar()
    return areas.filter("feature <> '(none)'").select("feature", (base - F.col("auc_roc")).alias("importance"))


Predictor = Callable[[DataFrame], DataFrame]


def model_predictor(model: PipelineModel) -> Predictor:
    """Adds ``_p``, the positive probability of the values in the array ``_x``."""

    def predict(rows: DataFrame) -> DataFrame:
        scored = model.stages[-1].transform(rows.withColumn("features", array_to_vector("_x")))
        return scored.select(*rows.columns, vector_to_array("probability")[1].alias("_p"))

    return predict


#: More background rows than this would multiply the scoring for little: the attribution is a mean over them.
BACKGROUND = 100


def shapley_values(
    predict: Predictor,
    df: DataFrame,
    features: Sequence[str],
    background: DataFrame,
    ids: Sequence[str] = ("customer_id",),
    orders: int | None = 4,
    seed: int = 42,
) -> DataFrame:
    """Shapley values of each row's features against background rows: ``ids feature attribution``.

    For each background row and each of ``orders`` random orders of the features (None: all orders), the features take the
    row's values one by one; a feature's share is the change it makes. They are the mean over background rows and orders.
    The feature ``(base)`` has the mean prediction of the background, so a row's attributions add up to its prediction.

    ``background`` holds ``BACKGROUND`` rows at most, a bounded sample by definition; its rows are one array in the plan.
    Every row is scored in one job, 1 + number of features times for each pair; contributions are combined on the map side.
    """
    n = len(features)
    held = one_row(background.limit(BACKGROUND + 1), F.collect_list(F.array(*[F.col(f).cast("double") for f in features])).alias("rows"))["rows"]
    size = background.limit(BACKGROUND + 1).count()
    if not 0 < size <= BACKGROUND:
        raise ValueError(f"the background has {size} rows; give 1 to {BACKGROUND}")
    if orders is None:
        every = F.array(*[F.array(*[F.lit(i) for i in o]) for o in permutations(range(n))])
        order = F.explode(every)
    else:
        drawn = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(F.xxhash64(*[F.col(i_) for i_ in ids], F.col("_b"), F.col("_r"), i, F.lit(seed)).alias("h"), i.alias("i")))
        order = F.transform(F.array_sort(drawn), lambda s: s["i"])
    rows = df.select(*ids, F.array(*[F.col(f).cast("double") for f in features]).alias("_own")).withColumn("_rows", held)
    pairs = rows.select(*ids, "_own", F.posexplode("_rows").alias("_b", "_other"))
    if orders is not None:
        pairs = pairs.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(orders))))
    steps = pairs.withColumn("_order", order).withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(n))))
    own = F.slice("_order", 1, F.col("_step"))
    mixed = F.transform(F.zip_with("_own", "_other", lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda s, i: F.when(F.array_contains(own, i), s["x"]).otherwise(s["y"]))
    scored = predict(steps.select(*ids, "_order", "_step", mixed.alias("_x")))
    names = F.array(*[F.lit(f) for f in features])
    share = lambda name, value: F.struct(name.alias("feature"), value.alias("_v"))
    parts = F.array(
        F.when(F.col("_step") == 0, share(F.lit("(base)"), F.col("_p"))).otherwise(share(F.get(names, F.get("_order", F.col("_step") - 1)), F.col("_p"))),
        F.when(F.col("_step") < n, share(F.get(names, F.get("_order", F.col("_step"))), -F.col("_p"))),
    )
    count = size * (math.factorial(n) if orders is None else orders)
    shares = scored.select(*ids, F.inline(F.array_compact(parts)))
    return shares.groupBy(*ids, "feature").agg((F.sum("_v") / count).alias("attribution"))


def shapley_importance(values: DataFrame) -> DataFrame:
    """Mean absolute attribution of each feature over the explained rows."""
    return values.filter("feature <> '(base)'").groupBy("feature").agg(F.avg(F.abs("attribution")).alias("importance"))


def top_importance(importance: DataFrame, k: int = 5) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


# ---------------------------------------------------------------- run log


def log_run(spark: SparkSession, path: str, run_id: str, params: dict[str, object], metrics: dict[str, float]) -> None:
    """Append one training run to a Parquet run table (run_id, kind, name, value, number, logged_at)."""
    rows = [(run_id, "param", k, str(v), None) for k, v in params.items()]
    rows += [(run_id, "metric", k, None, float(v)) for k, v in metrics.items()]
    entries = F.array(
        *[F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(r, ("string",) * 4 + ("double",), ("run_id", "kind", "name", "value", "number"))]) for r in rows]
    )
    spark.range(1).select(F.inline(entries)).withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def run_metrics(runs: DataFrame, metric: str) -> DataFrame:
    """One row per run with the named metric, ready for ``best_run``."""
    picked = runs.filter((F.col("kind") == "metric") & (F.col("name") == metric))
    return picked.groupBy("run_id").agg(F.max("number").alias(metric))
