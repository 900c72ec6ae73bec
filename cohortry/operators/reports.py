"""Report tables: one text row per entity, built from the statistics tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scalars import as_percent, fixed, format_money


def satisfaction_band(positive_pct: Column) -> Column:
    return F.when(positive_pct > 60, "strong").when(positive_pct > 45, "moderate").when(positive_pct.isNotNull(), "poor")


def _top_terms(keywords: DataFrame, keys: Sequence[str], sentiment: str, k: int, sentiment_col: str) -> DataFrame:
    """First ``k`` keywords of one sentiment as a comma-separated text, one row per key."""
    few = keywords.filter((F.col(sentiment_col) == sentiment) & (F.col("rank") <= k))
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return few.groupBy(*keys).agg(F.array_join(ordered["term"], ", ").alias(f"{sentiment}_terms"))


def attach_terms(
    stats: DataFrame, keywords: DataFrame | None, keys: Sequence[str] = (), k: int = 5, sentiment_col: str = "predicted_sentiment"
) -> DataFrame:
    """Add ``positive_terms`` and ``negative_terms``; null where a group has no keyword."""
    out = stats
    for s in ("positive", "negative"):
        if keywords is None:
            out = out.withColumn(f"{s}_terms", F.lit(None).cast("string"))
            continue
        terms = _top_terms(keywords, keys, s, k, sentiment_col)
        out = out.join(terms, list(keys), "left") if keys else out.withColumn(f"{s}_terms", terms.scalar())
    return out


def review_summary(
    stats: DataFrame, keywords: DataFrame | None = None, keys: Sequence[str] = (), sentiment_col: str = "predicted_sentiment"
) -> DataFrame:
    """Executive review summary per group from ``sentiment_stats`` and keywords of the same groups."""
    rows = attach_terms(stats, keywords, keys, 5, sentiment_col).withColumn("band", satisfaction_band(F.col("positive_pct")))
    # A list of words is shown only if there are any.
    listed = lambda c, title: F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.concat(F.lit(title), F.col(c), F.lit("\n\n"))).otherwise("")
    text = F.format_string(
        "## Review summary\n\n"
        "%s reviews: %.0f%% positive, %.0f%% negative. Satisfaction is %s.\n\n%s%s"
        "For every positive review there are %.2f negative ones.\n",
        F.format_number("total_reviews", 0),
        F.col("positive_pct"),
        F.col("negative_pct"),
        F.col("band"),
        listed("positive_terms", "Words of praise: "),
        listed("negative_terms", "Words of complaint: "),
        F.coalesce(F.try_divide(F.col("negative_pct"), F.col("positive_pct")), F.lit(0.0)),
    )
    return rows.withColumn("summary", text)


def experiment_verdict(report: DataFrame) -> DataFrame:
    """Verdict per experiment. Shipping needs a significant result *and* a positive lift."""
    ship = F.col("significant") & (F.col("uplift") > 0)
    verdict = F.when(ship, "ship").when(F.col("significant"), "stop").otherwise("continue")
    advice = (
        F.when(ship, "Ship the treatment.")
        .when(F.col("significant"), "Keep the control; the treatment converts worse.")
        .otherwise("Keep testing or change the treatment.")
    )
    text = F.concat(
        F.lit("## Experiment result\n\nRelative change in conversion: "),
        F.coalesce(as_percent(F.col("uplift")), F.lit("n/a")),
        F.lit(". At the 95% level the result is "),
        F.col("significance_label"),
        F.lit(". "),
        advice,
        F.lit("\n"),
    )
    return report.withColumn("verdict", verdict).withColumn("interpretation", text)


def top_factors(importance: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` strongest features as one text row."""
    best = importance.orderBy(F.desc("importance"), "feature").limit(k)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature")))
    return best.agg(F.array_join(ordered["feature"], ", ").alias("factors"))


def churn_report(metrics: DataFrame, risk: DataFrame, importance: DataFrame, k: int = 3) -> DataFrame:
    """One row: model metrics, customers and revenue at risk, strongest factors, and the text."""
    high, money = (risk.select(c).scalar() for c in ("high_risk_count", "revenue_at_risk"))
    rows = metrics.select(
        "auc_roc", "precision", "recall", "f1", high.alias("high_risk_count"), money.alias("revenue_at_risk"),
        top_factors(importance, k).scalar().alias("factors"),
    )
    text = F.concat(
        F.lit("## Churn report\n\n"),
        F.format_string("Model AUC: %s\n\n", F.col("auc_roc").cast("string")),
        F.format_string("Customers at high risk: %s\n\n", F.format_number("high_risk_count", 0)),
        F.format_string("Revenue at risk: %s per month\n\n", format_money(F.col("revenue_at_risk"))),
        F.format_string("Strongest factors: %s\n", F.col("factors")),
    )
    return rows.withColumn("report", text)


def executive_summary(nlp: DataFrame, experiments: DataFrame, churn: DataFrame) -> DataFrame:
    """The key-metric table as (scope, metric, value) rows; one block per experiment."""
    rows = lambda scope, pairs: F.inline(
        F.array(*[F.struct(scope.alias("scope"), F.lit(n).alias("metric"), v.cast("string").alias("value")) for n, v in pairs])
    )
    four = lambda c: F.format_string("%.4f", F.col(c))
    text = nlp.select(rows(F.lit("reviews"), [("NLP Accuracy", four("accuracy")), ("NLP Macro F1", four("macro_f1"))]))
    tests = experiments.select(
        rows(
            F.col("experiment_name"),
            [
                ("A/B Test Result", F.col("significance_label")),
                ("Revenue Impact (est.)", F.concat(format_money(F.col("revenue_impact")), F.lit("/month"))),
            ],
        )
    )
    risk = churn.select(
        rows(
            F.lit("churn"),
            [
                ("Churn Model AUC-ROC", F.col("auc_roc")),
                ("High-Risk Customers", F.format_number("high_risk_count", 0)),
                ("Revenue at Risk", F.concat(format_money(F.col("revenue_at_risk")), F.lit("/month"))),
            ],
        )
    )
    return text.unionByName(tests).unionByName(risk)


# ---------------------------------------------------------------- prompt tables


def review_prompts(stats: DataFrame, keywords: DataFrame | None, keys: Sequence[str] = ()) -> DataFrame:
    """One prompt per group: its statistics as JSON, top-8 keywords, and the task."""
    rows = attach_terms(stats, keywords, keys, 8)
    facts = F.to_json(F.struct("total_reviews", "positive_pct", "negative_pct", "neutral_pct", "avg_rating"))
    prompt = F.concat(
        F.lit("Act as a senior e-commerce data analyst. Review statistics: "),
        facts,
        F.lit("\nWords in praise: "),
        F.coalesce("positive_terms", F.lit("")),
        F.lit("\nWords in complaints: "),
        F.coalesce("negative_terms", F.lit("")),
        F.lit("\nGive a three-sentence summary, two strengths, two critical issues and three concrete recommendations, under headings."),
    )
    return rows.select(*keys, prompt.alias("prompt"))


def experiment_prompts(report: DataFrame, keys: Sequence[str] = ("experiment_name",)) -> DataFrame:
    prompt = F.concat(
        F.lit("Act as a growth analyst. Experiment "),
        F.concat_ws(" / ", *keys),
        F.format_string(
            ": control %d users, %s converting; treatment %d users, %s converting; relative change ",
            "control_n", as_percent(F.col("control_cvr")), "treatment_n", as_percent(F.col("treatment_cvr")),
        ),
        F.coalesce(as_percent(F.col("uplift")), F.lit("n/a")),
        F.format_string("; p-value %s (alpha 0.05): ", fixed(F.col("p_value"), 4)),
        F.col("significance_label"),
        F.lit("; estimated monthly revenue impact "),
        F.coalesce(format_money(F.col("revenue_impact")), F.lit("n/a")),
        F.lit(".\nWrite two paragraphs without jargon: what it means for the business, and whether to ship and what to do next."),
    )
    return report.select(*keys, prompt.alias("prompt"))


def churn_prompts(churn: DataFrame, importance: DataFrame, k: int = 6) -> DataFrame:
    best = importance.orderBy(F.desc("importance"), "feature").limit(k)
    lines = F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature")))
    factors = best.agg(
        F.array_join(F.transform(lines, lambda s: F.format_string("%s (%.4f)", s["feature"], -s["i"])), "; ").alias("f")
    ).scalar()
    prompt = F.concat(
        F.lit("Act as a customer-success manager. Churn model quality: "),
        F.to_json(F.struct("auc_roc", "precision", "recall", "f1")),
        F.lit("\nRisk factors: "),
        factors,
        F.format_string("\nHigh-risk customers: %d; revenue at risk ", "high_risk_count"),
        format_money(F.col("revenue_at_risk")),
        F.lit(" per month.\nWrite three paragraphs: how good the model is in plain words, what drives churn, and how to retain these customers."),
    )
    return churn.select(prompt.alias("prompt"))


def question_prompts(questions: DataFrame, context: DataFrame, question: str = "question") -> DataFrame:
    """A question per row answered from a one-row context table (for example ``overview``)."""
    facts = context.select(F.to_json(F.struct("*"))).scalar()
    prompt = F.concat(
        F.lit("Act as a data analyst and answer from this context only.\nContext: "), facts,
        F.lit("\nQuestion: "), F.col(question), F.lit("\nAnswer:"),
    )
    return questions.withColumn("prompt", prompt)


def explanation(label: Column, rating_mode: Column) -> Column:
    """Sentence shown with a prediction, by label and by rating or text mode."""
    pick = lambda texts: F.try_element_at(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]), F.lower(label))
    rating = {
        "positive": "A satisfied customer, likely to buy again.",
        "neutral": "An undecided customer who could still be won.",
        "negative": "A dissatisfied customer at risk of leaving; follow up.",
    }
    text = {
        "positive": "The wording is positive.",
        "neutral": "The wording is mixed or neutral.",
        "negative": "The wording is negative.",
    }
    return F.when(rating_mode, pick(rating)).otherwise(pick(text))
