"""The full run over cleaned tables: review analysis, churn model, experiments, reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import bayes, churn, experiments, hypothesis, keywords, metrics, reports, sentiment
from cohortry.session import settle
from cohortry.sources import files


@dataclass
class InsightTables:
    reviews: DataFrame
    review_stats: DataFrame
    review_scores: DataFrame
    confusion: DataFrame
    keywords: DataFrame
    predictions: DataFrame
    churn: DataFrame
    importance: DataFrame
    experiments: DataFrame
    bayes: DataFrame
    anova: DataFrame
    correlation: DataFrame
    summary: DataFrame


def analyse_reviews(reviews: DataFrame) -> dict[str, DataFrame]:
    """Scored reviews are written once; statistics, evaluation and keywords read that table."""
    scored = settle(sentiment.add_sentiment(reviews), "reviews")
    counts = sentiment.confusion_counts(scored, "sentiment_label", "predicted_sentiment")
    return {
        "reviews": scored,
        "review_stats": metrics.sentiment_stats(scored),
        "review_scores": sentiment.classification_summary(counts),
        "confusion": sentiment.confusion_matrix(counts),
        "keywords": settle(keywords.keywords_by_sentiment(scored), "keywords"),
    }


def model_churn(features: DataFrame, kind: str = "mlp", max_iter: int = 25) -> dict[str, DataFrame]:
    # A plan of joins that the preparation and the risk summary read.
    features = settle(features, "features")
    rows, names = churn.prepare(features)
    train_rows = rows.filter("fold = 'train'")
    held_out = rows.filter("fold = 'test'")
    model = churn.train(train_rows, names, kind=kind, max_iter=max_iter)
    predictions = settle(churn.prediction_table(churn.score(model, held_out), keep=["customer_id"]), "predictions")
    importance = settle(churn.permutation_importance(model, held_out, names), "importance")
    quality = churn.test_metrics(predictions, "churn_probability", "true_label")
    risk = churn.risk_summary(predictions, features)
    report = settle(reports.churn_report(quality, risk, importance), "churn-report")
    return {"predictions": predictions, "importance": importance, "churn": report}


def analyse_experiments(events: DataFrame) -> dict[str, DataFrame]:
    """Events are cleaned and written once; every test reads that table."""
    events = settle(events, "events")
    return {
        "experiments": settle(experiments.experiment_report(events), "experiments"),
        "bayes": bayes.bayes_report(experiments.arm_totals(events)),
        "anova": hypothesis.anova(events, "device", "revenue_inr", ["experiment_name"]),
        "correlation": hypothesis.pearson(events, "page_views", "revenue_inr", ["experiment_name"]),
    }


def run_insights(
    spark: SparkSession, features: DataFrame, reviews: DataFrame, events: DataFrame, out: str | None = None, kind: str = "mlp", max_iter: int = 25
) -> InsightTables:
    """All three analyses and the executive summary; written under ``out`` when given."""
    tables = {**analyse_reviews(reviews), **model_churn(features, kind, max_iter), **analyse_experiments(events)}
    tables["summary"] = reports.executive_summary(tables["review_scores"], tables["experiments"], tables["churn"])
    result = InsightTables(**tables)
    if out:
        files.write_csv(result.reviews, f"{out}/reviews_with_sentiment.csv")
        files.write_csv(result.predictions, f"{out}/churn_predictions.csv")
        files.write_json_results(result.experiments, f"{out}/ab_test_results.json")
        for name in ("bayes", "anova", "correlation"):
            files.write_json_results(getattr(result, name), f"{out}/{name}.json")
        files.write_text(report_lines(result), f"{out}/executive_report.md", "line")
    return result


def report_lines(tables: InsightTables) -> DataFrame:
    """The executive report as ordered text blocks: reviews, experiments, churn, key metrics."""
    kw = reports.review_summary(tables.review_stats, tables.keywords).select(F.lit(1).alias("part"), F.col("summary").alias("line"))
    ab = reports.experiment_verdict(tables.experiments).select(
        F.lit(2).alias("part"), F.concat(F.lit("# "), F.col("experiment_name"), F.lit("\n"), F.col("interpretation")).alias("line")
    )
    risk = tables.churn.select(F.lit(3).alias("part"), F.col("report").alias("line"))
    facts = tables.summary.select(F.lit(4).alias("part"), F.concat_ws(" | ", F.lit(""), "scope", "metric", "value", F.lit("")).alias("line"))
    return kw.unionByName(ab).unionByName(risk).unionByName(facts).orderBy("part", "line")
