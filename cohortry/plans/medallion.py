"""Bronze -> silver -> gold over CSV sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import cleaning, features
from cohortry.sources import files


@dataclass
class MedallionTables:
    customers: DataFrame
    reviews: DataFrame
    ab_events: DataFrame
    gold: DataFrame
    report: DataFrame
    rows: dict[str, int]


def run_medallion(
    spark: SparkSession,
    sources: Mapping[str, str],
    base: str,
    schemas: Mapping[str, str] | None = None,
    database: str | None = None,
    clip: bool = True,
    as_of: str | None = None,
) -> MedallionTables:
    """Land the three sources, clean them, build the feature store and report on every layer.

    Each layer reads the *written* table of the layer before, so a CSV is parsed once; row counts are
    observed during the writes. Events are partitioned by date, which later date filters prune.
    """
    names = ("customers", "reviews", "ab_events")
    schemas = schemas or {}
    rows: dict[str, int] = {}
    bronze = {}
    for name in names:
        bronze[name], rows[f"bronze/{name}"] = files.ingest_bronze(
            spark, sources[name], f"{base}/bronze", name, schemas.get(name), as_of
        )
    lineage = ("_ingested_at", "_source_file")
    cleaners = {
        "customers": lambda t: cleaning.clean_customers(t.drop(*lineage), as_of=as_of),
        "reviews": lambda t: cleaning.clean_reviews(t.drop(*lineage), as_of=as_of),
        "ab_events": lambda t: cleaning.clean_ab_events(t.drop(*lineage), as_of=as_of).withColumn(
            "event_date", F.to_date("timestamp")
        ),
    }
    silver = {}
    for name in names:
        path = f"{base}/silver/{name}"
        by = ("event_date",) if name == "ab_events" else ()
        rows[f"silver/{name}"] = files.write_layer(cleaners[name](bronze[name]), path, by)
        silver[name] = files.read_layer(spark, path)
    store = f"{base}/gold/feature_store"
    built = features.build_gold(silver["customers"], silver["ab_events"], clip, as_of)
    rows["gold/feature_store"] = files.write_layer(built, store)
    gold = (
        files.register_table(spark, database, "gold_feature_store", store, f"{base}/catalog")
        if database
        else files.read_layer(spark, store)
    )
    layers = [(layer, name, f"{base}/{layer}/{name}") for layer in ("bronze", "silver") for name in names]
    report = features.quality_report(spark, [*layers, ("gold", "feature_store", store)])
    return MedallionTables(silver["customers"], silver["reviews"], silver["ab_events"], gold, report, rows)
