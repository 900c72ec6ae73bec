"""Sentiment, its evaluation, and keywords."""

from __future__ import annotations

import json
import math

from pyspark.sql import functions as F

from cohortry.operators import keywords, lexicons, sentiment, textmodel
from cohortry.operators.metrics import sentiment_stats
from cohortry.session import scratch_path, settle
from cohortry.sources import files
from cohortry.sources.tables import reviews_view, table
from cohortry.workload.base import query, text_list
from cohortry.workload.cleaning import NUM, WS


def sentiment_ctes(ids: str, text: str, source: str) -> str:
    """SQL for lexicon sentiment: one row per token, look-back by ``lag``. Ends with CTE ``scored``."""
    pos, neg = text_list(lexicons.POSITIVE), text_list(lexicons.NEGATIVE)
    nots, very = text_list(lexicons.NEGATORS), text_list(lexicons.INTENSIFIERS)
    back = lambda words: " or ".join(f"coalesce(b{k} in ({words}), false)" for k in (1, 2, 3))
    return f"""src as (select {ids}, regexp_replace(coalesce({text}, ''), '^{WS}+|{WS}+$', '', 'g') as t from {source}),
      numbered as (select *, row_number() over (order by {ids}) as rid, case when regexp_matches(t, '{NUM}') then cast(t as double) end as r from src),
      words as (select rid, list_filter(regexp_split_to_array(lower(t), '{WS}+'), lambda x: x <> '') as w from numbered),
      tokens as (select rid, unnest(w) as x, generate_subscripts(w, 1) as i from words),
      lagged as (select rid, x, lag(x, 1) over q as b1, lag(x, 2) over q as b2, lag(x, 3) over q as b3 from tokens window q as (partition by rid order by i)),
      weighed as (select rid, x, ({back(nots)}) as negated, case when {back(very)} then 1.5 else 1.0 end::double as wt from lagged where x in ({pos}, {neg})),
      sums as (select rid,
          sum(case when x in ({pos}) and not negated then wt when x in ({neg}) and negated then wt * 0.5 else 0 end)::double as pos,
          sum(case when x in ({neg}) and not negated then wt when x in ({pos}) and negated then wt else 0 end)::double as neg from weighed group by rid),
      joined as (select n.*, coalesce(s.pos, 0) as pos, coalesce(s.neg, 0) as neg, s.pos / nullif(s.pos + s.neg, 0) as share from numbered n left join sums s on n.rid = s.rid),
      scored as (select *,
        case when t = '' then 'neutral' when r < 1 or r > 5 then 'out_of_range' when r >= 4 then 'positive' when r = 3 then 'neutral' when r is not null then 'negative'
             when not regexp_matches(lower(t), '[a-z]') then 'invalid_input' when pos + neg = 0 then 'neutral'
             when share >= 0.65 then 'positive' when share <= 0.35 then 'negative' else 'neutral' end as predicted_sentiment,
        case when t = '' then 0.5 when r < 1 or r > 5 then 0 when r >= 4 then round(0.6 + (r - 4) * 0.19 - 1e-9, 2) when r = 3 then 0.65
             when r is not null then round(0.6 + (2 - r) * 0.19 - 1e-9, 2)
             when not regexp_matches(lower(t), '[a-z]') then 0 when pos + neg = 0 then 0.55
             when share >= 0.65 then least(round(0.58 + least(pos * 0.08, 0.38) - 1e-9, 2), 0.97)
             when share <= 0.35 then least(round(0.58 + least(neg * 0.08, 0.38) - 1e-9, 2), 0.97)
             else round(0.52 + abs(share - 0.5) * 0.2 - 1e-9, 2) end::double as sentiment_confidence
        from joined)"""


@query(f"with {sentiment_ctes('review_id', 'review_text', 'v_reviews')} select review_id, predicted_sentiment, sentiment_confidence from scored", "reviews")
def review_sentiment(spark, d):
    return sentiment.add_sentiment(reviews_view(spark, d)).select("review_id", "predicted_sentiment", "sentiment_confidence")


@query(f"with {sentiment_ctes('doc_id', 'text', 'documents')} select doc_id, predicted_sentiment, sentiment_confidence from scored")
def document_sentiment(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return sentiment.add_sentiment(docs, "text").drop("text")


@query(
    f"""with {sentiment_ctes('conv_id, turn, role', 'text', 'conversations')}
       select conv_id, turn, role, predicted_sentiment, sentiment_confidence from scored"""
)
def user_turn_sentiment(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return sentiment.add_sentiment(turns, "text").drop("text")


@query(
    f"""with {sentiment_ctes('review_id, category, rating', 'review_text', 'v_reviews')}
       select category, count(*) as total_reviews,
         round(count(case when predicted_sentiment = 'positive' then 1 end) * 100.0::double / count(*), 1) as positive_pct,
         round(count(case when predicted_sentiment = 'negative' then 1 end) * 100.0::double / count(*), 1) as negative_pct,
         round(count(case when predicted_sentiment = 'neutral' then 1 end) * 100.0::double / count(*), 1) as neutral_pct,
         round(avg(rating), 2) as avg_rating from scored group by category""",
    "reviews",
)
def review_statistics(spark, d):
    return sentiment_stats(sentiment.add_sentiment(reviews_view(spark, d)), ["category"])


def review_confusion(spark, d, keys=()):
    scored = sentiment.add_sentiment(reviews_view(spark, d))
    return sentiment.confusion_counts(scored, "sentiment_label", "predicted_sentiment", keys)


CONFUSION = sentiment_ctes("review_id, category, sentiment_label", "review_text", "v_reviews") + """,
      counts as (select {keys} sentiment_label as truth, predicted_sentiment as pred, count(*) as n from scored group by all),
      sides as (select {keys} truth as label, n as s, 0 as p, case when truth = pred then n else 0 end as tp from counts
                union all select {keys} pred, 0, n, 0 from counts),
      per as (select {keys} label, sum(s)::bigint as support, sum(p)::bigint as p, sum(tp)::bigint as tp from sides group by all),
      report as (select {keys} label, case when p > 0 then tp::double / p else 0 end as "precision", case when support > 0 then tp::double / support else 0 end as recall,
                 case when p + support > 0 then 2 * tp::double / (p + support) else 0 end as f1, support from per)"""


@query(
    "with " + CONFUSION.replace("{keys}", "category,")
    + """ select category, round(sum(recall * support) / sum(support), 4) as accuracy, round(avg(f1), 4) as macro_f1,
         round(sum(f1 * support) / sum(support), 4) as weighted_f1, sum(support)::bigint as n from report group by category""",
    "reviews",
)
def sentiment_scores_by_category(spark, d):
    out = sentiment.classification_summary(review_confusion(spark, d, ["category"]), ["category"])
    return out.withColumns({c: F.round(c, 4) for c in ("accuracy", "macro_f1", "weighted_f1")})


@query(
    "with " + CONFUSION.replace("{keys}", "")
    + """ select label, round("precision", 6) as "precision", round(recall, 6) as recall, round(f1, 6) as f1, support from report""",
    "reviews",
)
def sentiment_class_report(spark, d):
    out = sentiment.classification_report(review_confusion(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "with " + CONFUSION.replace("{keys}", "")
    + """, l as (select unnest(['positive', 'neutral', 'negative']) as label)
       select a.label as truth, b.label as pred, coalesce(n, 0) as n from l a cross join l b left join counts c on c.truth = a.label and c.pred = b.label""",
    "reviews",
)
def sentiment_confusion_matrix(spark, d):
    return sentiment.confusion_matrix(review_confusion(spark, d))


@query(
    """with j as (select case quality when 1 then 'positive' else 'negative' end as truth, case toxic when 1 then 'negative' else 'positive' end as pred
         from labels join documents using (doc_id)),
       counts as (select truth, pred, count(*) as n from j group by all), l as (select unnest(['positive', 'negative']) as label)
       select a.label as truth, b.label as pred, coalesce(n, 0) as n from l a cross join l b left join counts c on c.truth = a.label and c.pred = b.label"""
)
def label_agreement_matrix(spark, d):
    """Quality against toxicity labels of the documents."""
    both = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id"), "doc_id").select(
        F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("truth"),
        F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("pred"),
    )
    return sentiment.confusion_matrix(sentiment.confusion_counts(both, "truth", "pred"), labels=("positive", "negative"))


# ---------------------------------------------------------------- keywords

STOP = text_list(lexicons.STOP_WORDS)


def gram_ctes(group: str, ids: str, text: str, source: str) -> str:
    return f"""src as (select {group} as g, {ids} as id, list_filter(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
          lambda x: x not in ({STOP})) as w from {source}),
      uni as (select g, id, unnest(w) as term, generate_subscripts(w, 1) as i from src),
      grams as (select g, id, term from uni union all
        select g, id, term || ' ' || nxt from (select *, lead(term) over (partition by id order by i) as nxt from uni) where nxt is not null),
      tf as (select g, id, term, count(*) as tf from grams group by all),
      totals as (select g, term, sum(tf)::bigint as total, count(*) as df from tf group by all),
      vocab as (select * from totals qualify row_number() over (partition by g order by total desc, term) <= 50)"""


KEYWORD_TAIL = """,
      docs as (select g, count(*) as n from src group by g),
      weighted as (select tf.g, id, tf.term, tf * (ln((1.0::double + n) / (1.0::double + df)) + 1.0::double) as w
        from tf join vocab v on tf.g = v.g and tf.term = v.term join docs on docs.g = tf.g),
      norms as (select id, sqrt(sum(w * w)) as norm from weighted group by id),
      scores as (select weighted.g, term, sum(w / norm) / any_value(n) as score from weighted join norms on weighted.id = norms.id join docs on docs.g = weighted.g group by all),
      ranked as (select *, cast(row_number() over (partition by g order by round(score, 10) desc, term) as int) as rank from scores)
      select g as {name}, rank, term, round(score, 4) as score from ranked where rank <= 10"""


@query(
    f"""with {gram_ctes('lang', 'doc_id', 'text', 'documents')} select g as lang, term, total, df from vocab"""
)
def vocabulary_by_language(spark, d):
    docs = table(spark, d, "documents").select("lang", "text")
    return keywords.vocabulary(docs, ["lang"], "text").select("lang", "term", "total", "df")


@query(
    f"""with {gram_ctes('sentiment_label', 'review_id', 'review_text', 'v_reviews')}
       select id as review_id, array_to_string(list_sort(list(term)), '|') as terms, cast(count(*) as int) as n_terms from grams group by id""",
    "reviews",
)
def review_terms(spark, d):
    out = keywords.tokenize(reviews_view(spark, d).select("review_id", "review_text"), "review_text")
    return out.filter(F.size("terms") > 0).select(
        "review_id", F.array_join(F.sort_array("terms"), "|").alias("terms"), F.size("terms").alias("n_terms")
    )


@query("with " + gram_ctes("lang", "doc_id", "text", "documents") + KEYWORD_TAIL.replace("{name}", "lang"))
def keywords_by_language(spark, d):
    docs = table(spark, d, "documents").select("lang", "text")
    return keywords.tfidf_keywords(docs, ["lang"], "text")


@query(
    f"""with {sentiment_ctes('review_id', 'review_text', 'v_reviews')}, keep as (select v.review_id, review_text, predicted_sentiment from v_reviews v join scored using (review_id)
         where predicted_sentiment in ('positive', 'negative', 'neutral')), """
    + gram_ctes("predicted_sentiment", "review_id", "review_text", "keep").replace("src as", "ksrc as").replace("from src", "from ksrc")
    + KEYWORD_TAIL.replace("{name}", "predicted_sentiment").replace("from src", "from ksrc"),
    "reviews",
)
def keywords_by_sentiment(spark, d):
    scored = sentiment.add_sentiment(reviews_view(spark, d)).select("review_text", "predicted_sentiment")
    return keywords.keywords_by_sentiment(settle(scored, "reviews"))


@query("with " + gram_ctes("'all'", "conv_id * 1000000 + turn", "text", "conversations") + KEYWORD_TAIL.replace("g as {name},", ""))
def keywords_of_conversations(spark, d):
    return keywords.tfidf_keywords(table(spark, d, "conversations").select("text"), [], "text")


@query()
def trained_document_classifier(spark, d):
    from cohortry.operators.textmodel import apply_text_model, train_text_model

    docs = table(spark, d, "documents").select("doc_id", "text")
    labelled = docs.join(table(spark, d, "labels"), "doc_id").withColumn(
        "sentiment_label", F.when(F.col("quality") == 1, "positive").otherwise("negative")
    )
    model = train_text_model(labelled, "text", "sentiment_label")
    return apply_text_model(model, docs, "text").select("doc_id", "predicted_sentiment", "sentiment_confidence")


@query(
    r"""select conv_id, turn, length(regexp_replace(coalesce(text, ''), '[^\p{Lu}]', '', 'g')) / greatest(length(coalesce(text, '')), 1)::double as model_probability from conversations"""
)
def user_model_scores(spark, d):
    """A user's text model plugged in as an iterator pandas UDF (here: share of upper-case letters)."""

    def load():
        return lambda texts: [sum(ch.isupper() for ch in t) / max(len(t), 1) for t in texts.fillna("")]

    turns = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return sentiment.score_with_model(turns, "text", load).drop("text")


@query(
    "with " + gram_ctes("lang", "doc_id", "text", "documents") + KEYWORD_TAIL.split("select g as {name}")[0]
    + """ select g as lang, cast(count(*) as int) as n, string_agg(term || ' ' || printf('%.4f', score), '; ' order by rank) as keywords from ranked where rank <= 10 group by g"""
)
def keyword_lists_by_language(spark, d):
    """One row a language with its ranked keywords and their scores."""
    found = keywords.tfidf_keywords(table(spark, d, "documents").select("lang", "text"), ["lang"], "text")
    shown = F.transform("keywords", lambda k: F.format_string("%s %.4f", k["term"], k["score"]))
    return keywords.keyword_lists(found, ["lang"]).select("lang", F.size("keywords").alias("n"), F.array_join(shown, "; ").alias("keywords"))


def shipped_length_model(path):
    """The shipped model of ``shipped_model_sentiment``: long texts are positive; it fails at every text of 3k characters."""
    with open(path, encoding="utf-8") as source:
        weights = json.loads(source.readline())

    def one(text):
        if len(text) % 3 == 0:
            raise ValueError("a text that this model cannot read")
        p = 1 / (1 + math.exp(-(weights["bias"] + weights["per_character"] * min(len(text), 400))))
        return ("positive", p) if p >= 0.5 else ("negative", 1 - p)

    return lambda texts: [one(t) for t in texts]


@query(
    f"""with {sentiment_ctes('conv_id, turn, role', 'text', 'conversations')},
         asked as (select s.*, length(c.text) as n, c.text from scored s join (select distinct conv_id, turn, role, text from conversations) c using (conv_id, turn, role)),
         model as (select *, t <> '' and n % 3 <> 0 as from_model, 1 / (1 + exp(-(-3.0::double + 0.05::double * least(n, 400)))) as p from asked)
       select conv_id, turn, role,
         case when from_model then case when greatest(p, 1 - p) <= 0.75 then 'neutral' when p >= 0.5 then 'positive' else 'negative' end else predicted_sentiment end as predicted_sentiment,
         case when from_model then round(greatest(p, 1 - p), 4) else sentiment_confidence end as sentiment_confidence, coalesce(from_model, false) as from_model from model"""
)
def shipped_model_sentiment(spark, d):
    """A stored model sent to the executors; where it raises, the lexicon's result stays."""
    weights = spark.createDataFrame([(-3.0, 0.05)], "bias double, per_character double")
    name = textmodel.ship_model(spark, textmodel.one_json_file(weights, scratch_path(spark, "length-model")))
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return textmodel.apply_shipped_model(turns, "text", name, shipped_length_model).drop("text")


# ---------------------------------------------------------------- evaluation and keywords of whole documents

DOCUMENT_LABELS = """v_labelled as (select d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic, case when l.toxic = 1 then 'negative' when l.quality = 1 then 'positive' else 'neutral' end as sentiment_label
    from documents d join labels l using (doc_id))"""


def labelled_documents(spark, d):
    """Documents with a reviewer's view of them: toxic is negative, good is positive, the rest neutral."""
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("sentiment_label", label)


def document_confusion(spark, d, keys=()):
    scored = sentiment.add_sentiment(labelled_documents(spark, d).select("doc_id", "lang", "text", "sentiment_label"), "text")
    return settle(sentiment.confusion_counts(scored, "sentiment_label", "predicted_sentiment", keys), "confusion")


DOCUMENT_CONFUSION = DOCUMENT_LABELS + ", " + CONFUSION.replace(sentiment_ctes("review_id, category, sentiment_label", "review_text", "v_reviews"), sentiment_ctes("doc_id, lang, sentiment_label", "text", "v_labelled"))


@query(
    "with " + DOCUMENT_CONFUSION.replace("{keys}", "lang,")
    + """ select lang, round(sum(recall * support) / sum(support), 4) as accuracy, round(avg(f1), 4) as macro_f1,
         round(sum(f1 * support) / sum(support), 4) as weighted_f1, sum(support)::bigint as n from report group by lang"""
)
def document_sentiment_scores(spark, d):
    """Lexicon sentiment of whole documents against their labels, by language."""
    out = sentiment.classification_summary(document_confusion(spark, d, ["lang"]), ["lang"])
    return out.withColumns({c: F.round(c, 4) for c in ("accuracy", "macro_f1", "weighted_f1")})


@query(
    "with " + DOCUMENT_CONFUSION.replace("{keys}", "")
    + """ select label, round("precision", 6) as "precision", round(recall, 6) as recall, round(f1, 6) as f1, support from report"""
)
def document_class_report(spark, d):
    out = sentiment.classification_report(document_confusion(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    f"""with {gram_ctes("lang", "conv_id * 1000000 + turn", "text", "(select *, 'all' as lang from conversations)")}
       select id as turn_id, array_to_string(list_sort(list(term)), '|') as terms, cast(count(*) as int) as n_terms from grams group by id"""
)
def conversation_terms(spark, d):
    """Terms and bigrams of every turn's whole text."""
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000000 + F.col("turn")).alias("turn_id"), "text")
    out = keywords.tokenize(turns, "text")
    return out.filter(F.size("terms") > 0).select("turn_id", F.array_join(F.sort_array("terms"), "|").alias("terms"), F.size("terms").alias("n_terms"))


@query(
    f"""with {sentiment_ctes('doc_id', 'text', 'documents')}, keep as (select v.doc_id, text, predicted_sentiment from documents v join scored using (doc_id)
         where predicted_sentiment in ('positive', 'negative', 'neutral')), """
    + gram_ctes("predicted_sentiment", "doc_id", "text", "keep").replace("src as", "ksrc as").replace("from src", "from ksrc")
    + KEYWORD_TAIL.replace("{name}", "predicted_sentiment").replace("from src", "from ksrc")
)
def document_keywords_by_sentiment(spark, d):
    scored = sentiment.add_sentiment(table(spark, d, "documents").select("doc_id", "text"), "text").select("text", "predicted_sentiment")
    return keywords.keywords_by_sentiment(settle(scored, "documents"), text_col="text")


@query(
    f"""with w as (select lang, doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{WS}+'), lambda x: x <> ''))) as term from documents)
       select lang, term, kind, count(*) as n_texts from w
         join (select unnest([{text_list(lexicons.POSITIVE)}]) as term, 'positive' as kind union all select unnest([{text_list(lexicons.NEGATIVE)}]), 'negative') using (term)
       group by lang, term, kind"""
)
def lexicon_hits_by_language(spark, d):
    """A lexicon written as a CSV source and read back as a table, looked up in whole documents."""
    path = scratch_path(spark, "lexicon")
    rows = [(w, kind) for kind, words in (("positive", lexicons.POSITIVE), ("negative", lexicons.NEGATIVE)) for w in words]
    files.write_csv(spark.createDataFrame(rows, "term string, kind string"), path)
    lexicon = files.read_csv(spark, path, "term string, kind string")
    return sentiment.lexicon_hits(table(spark, d, "documents"), "text", lexicon, ["lang"])
