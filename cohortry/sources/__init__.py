from cohortry.sources.files import (
    ingest_bronze,
    load_optional,
    load_reviews,
    load_feature_store,
    read_layer,
    register_table,
    write_csv,
    write_json_results,
    write_layer,
    write_text,
)
from cohortry.sources.tables import ab_events_view, customers_view, reviews_view, table

__all__ = [
    "ab_events_view",
    "customers_view",
    "ingest_bronze",
    "load_feature_store",
    "load_optional",
    "load_reviews",
    "read_layer",
    "register_table",
    "reviews_view",
    "table",
    "write_csv",
    "write_json_results",
    "write_layer",
    "write_text",
]
