"""A stored text model on the executors, with the lexicon where it fails."""

import pytest
from pyspark.sql import functions as F

from cohortry.operators import keywords, sentiment, textmodel
from cohortry.operators.lexicons import STOP_WORDS
from cohortry.session import scratch_path

GOOD, BAD = "lovely warm sturdy crisp tidy".split(), "broken cold flimsy torn dirty".split()


@pytest.fixture(scope="module")
def reviews(spark):
    rows = []
    for i in range(200):
        words = (GOOD, BAD)[i % 2]
        rows.append((i, f"the {words[i % 5]} thing was {words[(i * 3 + 1) % 5]} item{i % 7}", ("positive", "negative")[i % 2]))
    return spark.createDataFrame(rows, "id int, text string, label string")


@pytest.fixture(scope="module")
def shipped(spark, reviews):
    model = textmodel.train_text_model(reviews, "text", "label")
    path = textmodel.export_word_weights(model, scratch_path(spark, "t-weights"), reviews, "text")
    return model, textmodel.ship_model(spark, path)


def test_stored_weights_score_like_the_trained_model(spark, reviews, shipped):
    model, name = shipped
    trained = {r.id: r for r in textmodel.apply_text_model(model, reviews, "text").collect()}
    got = textmodel.apply_shipped_model(reviews, "text", name, textmodel.load_word_weights()).collect()
    assert all(r.from_model for r in got)
    for r in got:
        assert r.predicted_sentiment == trained[r.id].predicted_sentiment
        assert r.sentiment_confidence == pytest.approx(trained[r.id].sentiment_confidence, abs=2e-4)
    assert sum(r.predicted_sentiment == r.label for r in got) >= 198


def failing_model():
    """Fails for texts with one word, is unsure of some, and answers with another label for others. Sent by value."""

    def failing(path):
        opened = textmodel.load_word_weights()(path)

        def model(texts):
            if any("item3" in t for t in texts):
                raise ValueError("cannot read")
            out = opened(texts)
            return [("MIXED", 0.99) if "item4" in t else (label.upper(), 0.5 if "item5" in t else score) for t, (label, score) in zip(texts, out, strict=True)]

        return model

    return failing


def test_rows_at_which_the_model_fails_keep_the_lexicon(spark, reviews, shipped):
    odd = spark.createDataFrame([(900, None, None), (901, "  ", None), (902, "4", None), (903, "great item3 and good", None)], reviews.schema)
    rows = reviews.unionByName(odd)
    got = {r.id: r for r in textmodel.apply_shipped_model(rows, "text", shipped[1], failing_model()).collect()}
    lexicon = {r.id: r for r in sentiment.add_sentiment(rows, "text").collect()}
    for i, r in got.items():
        planted = r.text is None or not r.text.strip() or "item3" in r.text
        assert r.from_model == (not planted)
        if planted:
            assert (r.predicted_sentiment, r.sentiment_confidence) == (lexicon[i].predicted_sentiment, lexicon[i].sentiment_confidence)
        elif "item4" in r.text or "item5" in r.text:
            assert r.predicted_sentiment == "neutral"
    assert got[903].predicted_sentiment == "positive" and not got[903].from_model


def test_a_model_that_cannot_be_loaded(spark, reviews, shipped):
    def broken(path):
        raise OSError(path)

    got = textmodel.apply_shipped_model(reviews, "text", shipped[1], broken)
    want = sentiment.add_sentiment(reviews, "text")
    assert got.where("from_model").count() == 0
    assert got.drop("from_model").select(want.columns).exceptAll(want).count() == 0
    assert textmodel.apply_shipped_model(reviews.where("false"), "text", shipped[1], failing_model()).count() == 0


def test_lexicon_hits(spark):
    rows = spark.createDataFrame([("a", "Good good bad"), ("a", "good x"), (None, "BAD"), ("b", None)], "g string, t string")
    lexicon = spark.createDataFrame([("good", 1), ("Good", 2), ("bad", -1), (None, 0), ("absent", 5)], "term string, weight int")
    got = {(r.g, r.term, r.weight): r.n_texts for r in sentiment.lexicon_hits(rows, "t", lexicon, ["g"]).collect()}
    assert got == {("a", "good", 1): 2, ("a", "good", 2): 2, ("a", "bad", -1): 1, (None, "bad", -1): 1}


def test_few_phrases_are_shuffled(spark):
    """Only phrases of words that reach the k-th count are formed: k words a group and ties, however large the vocabulary."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text")
    words = docs.select("lang", keywords.terms(F.col("text"), STOP_WORDS).alias("_k"))
    counts = keywords._count_terms(words, ["lang"], "_k")
    best = keywords._most_frequent(counts, ["lang"], 10)
    floor = best.groupBy("lang").agg(F.min("total").alias("_floor"))
    able = counts.join(floor, "lang").where("total >= _floor")
    assert able.groupBy("lang").count().agg(F.max("count")).first()[0] <= 16
    phrases = words.select(F.sum(F.greatest(F.size("_k") - 1, F.lit(0)))).first()[0]
    listed = able.groupBy("lang").agg(F.collect_set("term").alias("able"))
    formed = words.join(listed, "lang").withColumn("_m", F.transform("_k", lambda w: F.when(F.array_contains("able", w), w)))
    distinct = keywords._count_terms(formed.withColumn("_t", keywords.phrases(F.col("_m"), 2)), ["lang"], "_t").count()
    assert distinct < 0.05 * phrases
