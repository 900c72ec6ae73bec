"""A text model is trained on one reading of the texts, and texts are scored by all tasks."""

import pytest
from pyspark.sql import functions as F

from cohortry.operators import sentiment, textmodel

GOOD, BAD = "lovely warm sturdy crisp tidy".split(), "broken cold flimsy torn dirty".split()


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(i, f"the {(GOOD, BAD)[i % 2][i % 5]} thing item{i % 7}", ("positive", "negative")[i % 2]) for i in range(200)]
    return spark.createDataFrame(rows, "id int, text string, label string")


def test_training_reads_each_text_once(spark, reviews):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    textmodel.train_text_model(reviews.withColumn("text", counted.asNondeterministic()("text")), "text", "label")
    assert seen.value == 200


def test_one_row_group_is_scored_by_many_tasks_and_the_lexicon_gets_the_rest(spark, reviews):
    model = textmodel.train_text_model(reviews, "text", "label")
    odd = [(900, None), (901, "  "), (902, "4"), (903, "9"), (904, "???"), (905, "- !"), (906, "inf"), (907, "great lovely"), (908, "not good")]
    rows = reviews.select("id", "text").unionByName(spark.createDataFrame(odd, "id int, text string")).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scored = textmodel.apply_text_model(model, rows, "text")
        assert scored.columns == ["id", "text", "predicted_sentiment", "sentiment_confidence"]
        got = scored.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 209 and len({r.task for r in got}) == 8
    found = {r.id: (r.predicted_sentiment, r.sentiment_confidence) for r in got}
    lexicon = {r.id: (r.predicted_sentiment, r.sentiment_confidence) for r in sentiment.add_sentiment(rows, "text").collect()}
    assert all(found[i] == lexicon[i] for i in (900, 901, 902, 903, 904, 905))
    # Texts with a token are the model's, whatever their lexicon words.
    assert all(found[i] != lexicon[i] for i in (907, 908))
    assert found[906] == lexicon[906]
