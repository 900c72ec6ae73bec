"""Model-backed sentiment: a Spark ML text classifier with the lexicon as fallback."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import SparkFiles
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scalars import parse_number, strip_ws
from cohortry.functions.tokens import TERM
from cohortry.operators.churn import detached
from cohortry.operators.sentiment import add_sentiment, confident_label
from cohortry.session import settle

NEUTRAL_BELOW = 0.75


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all tasks by a hash of whole rows, so that copies of a text part as long as their ids differ.

    A file is read by as many tasks as it has row groups; work on texts is not bound to that number.
    """
    # Maps have no hash.
    return df.repartition(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]))


def train_text_model(
    df: DataFrame, text_col: str, label_col: str, num_features: int = 1 << 14, max_iter: int = 20, reg: float = 1e-3
) -> PipelineModel:
    """Fit tokens -> hashed TF -> IDF -> logistic regression on labelled text.

    Hashing keeps the model size fixed whatever the vocabulary; training is distributed L-BFGS. Texts are read and cut into
    tokens once: their hashed counts are written, and every pass of the fit reads those.
    """
    tokenizer = RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=TERM, gaps=False)
    hashing = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    rows = spread(df).select(label_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    counted = settle(hashing.transform(tokenizer.transform(rows)).select(label_col, "_tf"), "text-counts")
    labels = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip").fit(counted)
    stages = [
        labels,
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", predictionCol="_prediction", probabilityCol="_probability",
            rawPredictionCol="_raw", maxIter=max_iter, regParam=reg,
        ),
        IndexToString(inputCol="_prediction", outputCol="_name", labels=labels.labelsArray[0]),
    ]
    fitted = Pipeline(stages=stages).fit(counted).stages
    return detached(PipelineModel(stages=[fitted[0], tokenizer, hashing, *fitted[1:]]), df.sparkSession)


def apply_text_model(
    model: PipelineModel,
    df: DataFrame,
    text_col: str,
    label_col: str = "predicted_sentiment",
    score_col: str = "sentiment_confidence",
    threshold: float = NEUTRAL_BELOW,
) -> DataFrame:
    """Whole texts are scored; a label below the threshold becomes neutral.

    Blank texts, ratings and texts without any token keep the lexicon result; the lexicon looks at no other text.
    """
    base = spread(df).withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    scoring = PipelineModel(stages=model.stages[1:])
    scored = scoring.transform(base).withColumn("_top", F.array_max(vector_to_array("_probability")))
    usable = (F.size("_tokens") > 0) & parse_number(strip_ws(F.col("_text"))).isNull()
    label = confident_label("_name", "_top", threshold)
    keep: Sequence[str] = [c for c in df.columns if c not in (label_col, score_col)]
    judged = scored.select(
        *keep,
        F.when(usable, F.struct(label.alias("label"), F.round("_top", 4).alias("score"))).alias("_model"),
        F.when(~usable, F.col("_text")).alias("_left"),
    )
    known = F.col("_model").isNotNull()
    return add_sentiment(judged, "_left", "_lex_label", "_lex_score").select(
        *keep,
        F.when(known, F.col("_model.label")).otherwise(F.col("_lex_label")).alias(label_col),
        F.when(known, F.col("_model.score")).otherwise(F.col("_lex_score")).alias(score_col),
    )


#: A loaded text model: texts to (label, score) pairs. It may raise for a batch or for a text.
TextModel = Callable[[list[str]], list[tuple[str, float]]]
#: Labels that count; any other one is neutral, as in the lexicon's classes.
LABELS = ("positive", "negative")


def ship_model(spark: SparkSession, path: str) -> str:
    """Hands a stored model file to every executor, and returns the name by which ``apply_shipped_model`` finds it.

    ``path`` may lie in any file system that Spark reads. Executors that join later fetch it too.
    """
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def _each(model: TextModel, texts: list[str]) -> list[tuple[str | None, float | None]]:
    """The model's answers, null for texts at which it fails: a batch that raises is asked text by text."""
    try:
        found = list(model(texts))
        if len(found) == len(texts):
            return found
    except Exception:  # noqa: BLE001 - whatever a user's model raises
        if len(texts) == 1:
            return [(None, None)]
    if len(texts) == 1:
        return [(None, None)]
    half = len(texts) // 2
    return _each(model, texts[:half]) + _each(model, texts[half:])


def apply_shipped_model(
    df: DataFrame,
    text_col: str,
    name: str,
    load: Callable[[str], TextModel],
    label_col: str = "predicted_sentiment",
    score_col: str = "sentiment_confidence",
    threshold: float = NEUTRAL_BELOW,
) -> DataFrame:
    """Scores whole texts with a shipped model; where it fails a row keeps the lexicon's result.

    ``load`` opens the model's file; a task calls it once. A batch at which the model raises is halved until the failing
    texts stand alone, so one bad text costs the others nothing. Blank texts are never given to the model, and a model
    that cannot be loaded fails every text. A label other than positive or negative, or one whose score does not pass
    ``threshold``, is neutral. ``from_model`` says which result a row has.
    """

    @F.pandas_udf("struct<label string, score double>")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            model = load(SparkFiles.get(name))
        except Exception:  # noqa: BLE001 - a broken file leaves the lexicon
            model = None
        for texts in batches:
            known = texts.notna() if model is not None else pd.Series(False, index=texts.index)
            found = pd.DataFrame({"label": pd.Series(None, index=texts.index, dtype="object"), "score": pd.Series(None, index=texts.index, dtype="float64")})
            if known.any():
                answers = _each(model, texts[known].tolist())
                found.loc[known, "label"] = [a[0] for a in answers]
                found.loc[known, "score"] = pd.array([a[1] for a in answers], dtype="Float64").to_numpy("float64", na_value=float("nan"))
            yield found

    base = add_sentiment(df, text_col, "_lex_label", "_lex_score")
    blank = strip_ws(F.coalesce(F.col(text_col), F.lit(""))) == ""
    asked = base.withColumn("_m", ask(F.when(~blank, F.col(text_col))))
    usable = F.col("_m.label").isNotNull() & F.col("_m.score").isNotNull() & ~F.isnan("_m.score")
    known = F.when(F.lower("_m.label").isin(*LABELS), confident_label("_m.label", "_m.score", threshold)).otherwise("neutral")
    keep = [c for c in df.columns if c not in (label_col, score_col)]
    return asked.select(
        *keep,
        F.when(usable, known).otherwise(F.col("_lex_label")).alias(label_col),
        F.when(usable, F.round("_m.score", 4)).otherwise(F.col("_lex_score")).alias(score_col),
        usable.alias("from_model"),
    )


def one_json_file(rows: DataFrame, folder: str) -> str:
    """Writes the few rows of a model as one JSON-lines file in ``folder`` and returns the file's path."""
    rows.coalesce(1).write.mode("error").option("ignoreNullFields", "false").json(folder)
    return rows.sparkSession.read.text(folder).select(F.input_file_name()).first()[0]


def export_word_weights(model: PipelineModel, folder: str, df: DataFrame, text_col: str, least: int = 2, most: int = 50_000) -> str:
    """A trained two-class text model as a file of words and their weights, for ``load_word_weights``; returns its path.

    The words are the ``most`` frequent of ``df`` with ``least`` occurrences or more; a word's weight is what one occurrence
    adds to the classifier's margin. The row without a word has the intercept.
    """
    tokenizer, hashing, idf, classifier = model.stages[1:5]
    terms = tokenizer.transform(df.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))).select(F.explode("_tokens").alias("word"))
    words = terms.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most)
    single = idf.transform(hashing.transform(words.select("word", F.array("word").alias("_tokens"))))
    margin = vector_to_array("_raw")[1] - F.lit(float(classifier.intercept))
    head = df.sparkSession.range(1).select(F.lit(None).cast("string").alias("word"), F.lit(float(classifier.intercept)).alias("weight"))
    return one_json_file(head.unionByName(classifier.transform(single).select("word", margin.alias("weight"))), folder)


def load_word_weights(labels: tuple[str, str] = ("negative", "positive")) -> Callable[[str], TextModel]:
    """Opens a file of ``export_word_weights``: whole texts, the same words, a logistic score of the likelier label."""

    def load(path: str) -> TextModel:
        with open(path, encoding="utf-8") as source:
            weights = {r["word"]: r["weight"] for r in map(json.loads, source)}
        words = re.compile(r"\w{2,}")

        def one(text: str) -> tuple[str, float]:
            z = weights[None] + sum(weights.get(w, 0.0) for w in words.findall(text.lower()))
            p = 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))
            return (labels[1], p) if p >= 0.5 else (labels[0], 1 - p)

        return lambda texts: [one(t) for t in texts]

    return load
