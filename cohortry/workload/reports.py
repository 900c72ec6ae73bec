"""Report, prompt and explanation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.operators import churn, experiments, keywords, metrics, reports, sentiment
from cohortry.operators.metrics import revenue_at_risk
from cohortry.session import settle
from cohortry.sources.tables import ab_events_view, customers_view, reviews_view, table
from cohortry.workload.base import query
from cohortry.workload.cleaning import clean_events, gold
from cohortry.workload.experiments import CRIT, report_sql, totals_sql, z_sql
from cohortry.workload.text import KEYWORD_TAIL, gram_ctes, sentiment_ctes


def scored_reviews(spark, d):
    return sentiment.add_sentiment(reviews_view(spark, d))


@query(
    f"""with {sentiment_ctes('review_id, category', 'review_text', 'v_reviews')},
         s as (select category, count(*) as total_reviews, round(count(case when predicted_sentiment = 'positive' then 1 end) * 100.0::double / count(*), 1) as pct from scored group by category)
       select category, total_reviews, pct as positive_pct, case when pct > 60 then 'strong' when pct > 45 then 'moderate' else 'poor' end as band from s""",
    "reviews",
)
def review_summary_bands(spark, d):
    stats = metrics.sentiment_stats(scored_reviews(spark, d), ["category"])
    return reports.review_summary(stats, None, ["category"]).select("category", "total_reviews", "positive_pct", "band")


def stats_ctes(key: str, ids: str, text: str, source: str, rating: str = "rating") -> str:
    """``stats``: shares of the sentiments by ``key``; ``ranked``: keywords by key and sentiment (in ``g``)."""
    return (
        sentiment_ctes(f"{ids}, {key}, {rating}", text, source)
        + f""",
         stats as (select {key}, count(*) as total_reviews,
           round(count(case when predicted_sentiment = 'positive' then 1 end) * 100.0::double / count(*), 1) as positive_pct,
           round(count(case when predicted_sentiment = 'negative' then 1 end) * 100.0::double / count(*), 1) as negative_pct,
           round(count(case when predicted_sentiment = 'neutral' then 1 end) * 100.0::double / count(*), 1) as neutral_pct, round(avg({rating}), 2) as avg_rating from scored group by {key}),
         keep as (select v.{ids}, v.{text}, s.{key} || '|' || predicted_sentiment as g0 from {source} v join scored s using ({ids})), """
        + gram_ctes("g0", ids, text, "keep").replace("src as", "ksrc as").replace("from src", "from ksrc")
        + KEYWORD_TAIL.split("select g as {name}")[0].replace("from src", "from ksrc").replace("rank <= 10", "rank <= 8")
    )


def terms_sql(key: str, sentiment: str, k: int) -> str:
    return f"""(select string_agg(term, ', ' order by rank) from ranked where g = stats.{key} || '|{sentiment}' and rank <= {k})"""


def summary_sql(key: str) -> str:
    listed = lambda s, title: f"coalesce('{title}' || nullif({terms_sql(key, s, 5)}, '') || chr(10) || chr(10), '')"
    return f"""select {key}, case when positive_pct > 60 then 'strong' when positive_pct > 45 then 'moderate' else 'poor' end as band,
         '## Review summary' || chr(10) || chr(10) || format('{{:,}}', total_reviews) || ' reviews: ' || round(positive_pct)::int || '% positive, ' || round(negative_pct)::int
         || '% negative. Satisfaction is ' || case when positive_pct > 60 then 'strong' when positive_pct > 45 then 'moderate' else 'poor' end || '.' || chr(10) || chr(10)
         || {listed('positive', 'Words of praise: ')} || {listed('negative', 'Words of complaint: ')}
         || 'For every positive review there are ' || printf('%.2f', coalesce(negative_pct / nullif(positive_pct, 0), 0)) || ' negative ones.' || chr(10) as summary from stats"""


@query(f"with {stats_ctes('category', 'review_id', 'review_text', 'v_reviews')} {summary_sql('category')}", "reviews")
def review_summaries_by_category(spark, d):
    scored = settle(scored_reviews(spark, d), "reviews")
    stats = metrics.sentiment_stats(scored, ["category"])
    found = keywords.tfidf_keywords(scored, ["category", "predicted_sentiment"], "review_text", 8)
    return reports.review_summary(stats, found, ["category"]).select("category", "band", "summary")


def scored_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text", "n_chars")
    return settle(sentiment.add_sentiment(docs, "text").withColumn("rating", F.col("n_chars")), "documents")


@query(f"with {stats_ctes('lang', 'doc_id', 'text', 'documents', 'n_chars')} {summary_sql('lang')}")
def document_summaries_by_language(spark, d):
    """The review summary over whole documents, their languages taken as the categories."""
    scored = scored_documents(spark, d)
    found = keywords.tfidf_keywords(scored, ["lang", "predicted_sentiment"], "text", 8)
    return reports.review_summary(metrics.sentiment_stats(scored, ["lang"]), found, ["lang"]).select("lang", "band", "summary")


@query(
    f"""with {totals_sql("experiment_name")}, {z_sql("experiment_name")}
       select experiment_name, case when abs(z) > {CRIT} and diff > 0 then 'ship' when abs(z) > {CRIT} then 'stop' else 'continue' end as verdict,
         case when pc > 0 then round(diff / pc, 4) else 0 end as uplift from zed""",
    "events clean_events",
)
def experiment_verdicts(spark, d):
    out = reports.experiment_verdict(experiments.experiment_report(clean_events(spark, d)))
    return out.select("experiment_name", "verdict", "uplift")


@query()
def churn_report_row(spark, d):
    """Metrics of the trained model on the test fold, customers and revenue at risk, and the features that drive its scores."""
    rows, features = churn.prepare(gold(spark, d).drop("dq_valid", "_feature_timestamp"))
    model = churn.train(rows.filter("fold = 'train'"), features, kind="logistic")
    tested = settle(churn.score(model, rows.filter("fold = 'test'")), "scored")
    weights = churn.gradient_importance(model, rows.filter("fold = 'test'"), features)
    return reports.churn_report(churn.test_metrics(tested), revenue_at_risk(customers_view(spark, d), tested, "churn_probability"), weights)


@query()
def executive_summary(spark, d):
    counts = sentiment.confusion_counts(scored_reviews(spark, d), "sentiment_label", "predicted_sentiment")
    return reports.executive_summary(
        sentiment.classification_summary(counts),
        experiments.experiment_report(clean_events(spark, d)),
        churn_report_row(spark, d),
    )


@query(
    f"""with {stats_ctes('category', 'review_id', 'review_text', 'v_reviews')}
       select category, 'Act as a senior e-commerce data analyst. Review statistics: {{"total_reviews":' || total_reviews || ',"positive_pct":' || positive_pct || ',"negative_pct":' || negative_pct
         || ',"neutral_pct":' || neutral_pct || ',"avg_rating":' || avg_rating || '}}' || chr(10) || 'Words in praise: ' || coalesce({terms_sql('category', 'positive', 8)}, '')
         || chr(10) || 'Words in complaints: ' || coalesce({terms_sql('category', 'negative', 8)}, '') || chr(10)
         || 'Give a three-sentence summary, two strengths, two critical issues and three concrete recommendations, under headings.' as prompt from stats""",
    "reviews",
)
def review_prompts(spark, d):
    scored = settle(scored_reviews(spark, d), "reviews")
    found = keywords.tfidf_keywords(scored, ["category", "predicted_sentiment"], "review_text", 8)
    return reports.review_prompts(metrics.sentiment_stats(scored, ["category"]), found, ["category"])


@query(
    f"""with report as (with {report_sql('s_events')})
       select experiment_name, 'Act as a growth analyst. Experiment ' || experiment_name || ': control ' || control_n || ' users, ' || printf('%.1f%%', control_cvr * 100) || ' converting; treatment '
         || treatment_n || ' users, ' || printf('%.1f%%', treatment_cvr * 100) || ' converting; relative change ' || coalesce(printf('%.1f%%', uplift * 100), 'n/a')
         || printf('; p-value %.4f (alpha 0.05): ', p_value) || significance_label || '; estimated monthly revenue impact '
         || coalesce('₹' || replace(format('{{:,.0f}}', round_even(revenue_impact, 0)), '-0', '-0'), 'n/a')
         || '.' || chr(10) || 'Write two paragraphs without jargon: what it means for the business, and whether to ship and what to do next.' as prompt from report""",
    "events clean_events",
)
def experiment_prompts(spark, d):
    return reports.experiment_prompts(experiments.experiment_report(clean_events(spark, d)))


@query(
    """with facts as (select '{"total_customers":' || count(*) || ',"churn_rate":' || avg(churned) || ',"total_reviews":' || (select count(*) from v_reviews) || ',"total_events":'
           || (select count(*) from v_events) || '}' as f from v_customers)
       select question, 'Act as a data analyst and answer from this context only.' || chr(10) || 'Context: ' || f || chr(10) || 'Question: ' || question || chr(10) || 'Answer:' as prompt
       from (select distinct 'How large is the churn risk in ' || preferred_category || '?' as question from v_customers), facts""",
    "events customers reviews",
)
def question_prompts(spark, d):
    asked = customers_view(spark, d).groupBy("preferred_category").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("How large is the churn risk in "), "preferred_category", F.lit("?")).alias("question")
    )
    facts = metrics.overview(customers_view(spark, d), reviews_view(spark, d), ab_events_view(spark, d))
    return reports.question_prompts(asked, facts)


@query()
def churn_prompts(spark, d):
    """The prompt about a churn report, with the trained model's strongest features."""
    rows, features = churn.prepare(gold(spark, d).drop("dq_valid", "_feature_timestamp"))
    model = churn.train(rows.filter("fold = 'train'"), features, kind="logistic")
    return reports.churn_prompts(churn_report_row(spark, d), churn.gradient_importance(model, rows.filter("fold = 'test'"), features))


@query(
    f"""with {sentiment_ctes('review_id', 'review_text', 'v_reviews')}
       select review_id, case when r is not null then case predicted_sentiment when 'positive' then 'A satisfied customer, likely to buy again.'
           when 'neutral' then 'An undecided customer who could still be won.' when 'negative' then 'A dissatisfied customer at risk of leaving; follow up.' end
         else case predicted_sentiment when 'positive' then 'The wording is positive.' when 'neutral' then 'The wording is mixed or neutral.'
           when 'negative' then 'The wording is negative.' end end as explanation from scored""",
    "reviews",
)
def prediction_explanations(spark, d):
    from cohortry.functions import parse_number, strip_ws

    rated = parse_number(strip_ws(F.col("review_text"))).isNotNull()
    return scored_reviews(spark, d).select("review_id", reports.explanation(F.col("predicted_sentiment"), rated).alias("explanation"))
