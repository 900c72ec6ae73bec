"""From raw documents to packed training windows: language, quality, near copies, benchmark leaks, packing.

Each stage takes all documents that the one before it kept, as a table that was written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import decontamination, jaccard_join, langid, packing, quality
from cohortry.llm.queries import TOKENIZER, remainder, table
from cohortry.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def own_columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The document's columns among those of a result, whose own ``doc_id`` and the like come first."""
    return found.select(*(F.col(f"kept_{c}" if f"kept_{c}" in found.columns else c).alias(c) for c in docs.columns))


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of id and text as ``doc_id``: rows that share an id but not the text, or have none, are told apart."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), F.col("doc_id").alias("_own"), *(c for c in docs.columns if c != "doc_id"))


def back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("_own" if c == "doc_id" else c).alias(c) for c in docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with an identified language that makes up at least half of them.

    Texts that are null, empty or without a letter and mixtures without a majority go. Rows without an id and repeated
    rows are judged like others. The model learns from rows with a ``lang``; without any, and for an empty table, nothing stays.
    """
    model = langid.fit(docs.where(remainder(4) != 2))
    found = langid.predict(docs, model, keep=docs.columns)
    return own_columns(found.where("lang_pred <> 'und' and score >= 0.5"), docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the quality vote predicts as good; it learns from the labelled ones.

    Null and empty texts are scored like others, rows without an id too. Without labels everything scores 0.5 and stays.
    """
    model = quality.fit(docs.where(remainder(5) != 0), table(spark, sf_dir, "labels"), "quality")
    found = quality.score(docs, model, threshold=0.3, keep=docs.columns)
    return own_columns(found.where("predicted = 1"), docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near copies, that of the smallest id (a row without an id only if there is no other).

    It goes by row: of rows that share an id, only those with near copies are touched. Texts without words (null, empty) are
    nobody's copies; repeated rows of an id and a text are copies of each other; an empty table stays empty.
    """
    keyed = by_row(docs)
    classes = settle(jaccard_join.jaccard_join(keyed, threshold=0.8, size=5), "near-copies")
    copies = settle(classes.where("n_links > 0").select(F.col("doc_id").alias("key"), "class_id").distinct(), "copies")
    owners = jaccard_join.marked(keyed.select("doc_id", "_own"), copies.select(F.col("key").alias("id")))
    named = copies.join(owners.select(F.col("doc_id").alias("key"), "_own").distinct(), "key")
    first = F.struct(F.col("_own").isNull().alias("none"), F.col("_own").alias("own"), F.col("key").alias("key"))
    kept = named.groupBy("class_id").agg(F.min(first)["key"].alias("kept"))
    dropped = named.join(kept, "class_id").where("key <> kept").select(F.col("key").alias("id"))
    repeated = classes.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_copies").alias("copies")).where("n > 1 and copies > 1").select(F.col("doc_id").alias("id"))
    return back(jaccard_join.without_ids(keyed, dropped, repeated), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a ten-word window of a benchmark item occurs, row by row.

    A row goes for its own text alone, whatever other rows its id stands on. Null and empty texts stay; an empty
    benchmark drops nothing.
    """
    keyed = by_row(docs)
    found = decontamination.contamination(keyed, table(spark, sf_dir, "benchmark"), size=10)
    return back(jaccard_join.without_ids(keyed, found.where("size(places) > 0").select(F.col("doc_id").alias("id"))), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the pieces of all documents in windows of 2,048 tokens; a null or empty text is its end id alone."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), window=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: EM, the latent space and the tokenizer have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
