"""File sources and sinks: CSV ingest, layer tables, result files, catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StructType

from cohortry import schemas
from cohortry.functions.scalars import finite_or_null


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def with_lineage(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add ``_ingested_at`` and ``_source_file`` (the file each row came from)."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.select("*", stamp.alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file"))


def ingest_bronze(
    spark: SparkSession,
    source_path: str,
    bronze_path: str,
    table_name: str,
    schema: StructType | str | None = None,
    as_of: str | None = None,
) -> tuple[DataFrame, int]:
    """Land a CSV source unchanged as a bronze table; returns the table and its row count.

    The count is observed during the write, so the source is not scanned again.
    """
    raw = with_lineage(read_csv(spark, source_path, schema), as_of)
    rows = write_layer(raw, f"{bronze_path}/{table_name}")
    return read_layer(spark, f"{bronze_path}/{table_name}"), rows


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite a layer table, schema included; returns the rows written.

    With ``partition_by`` the rows are rebalanced on those columns first: one hot
    date is split over several tasks by AQE and small dates share one.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(seen.get["rows"])


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_table(
    spark: SparkSession, database: str, name: str, path: str, database_path: str | None = None
) -> DataFrame:
    """Register a layer path as an external catalog table and return that table; a table of another path is replaced."""
    where = f" LOCATION '{database_path}'" if database_path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    table = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(f"{database}.{name}"):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
        plain = lambda p: p.removeprefix("file:").replace("//", "/").rstrip("/")
        if not rows or plain(rows[0]["data_type"]) != plain(path):
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    return spark.table(f"`{database}`.`{name}`")


def load_feature_store(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_csv(spark, path, None if infer else schemas.FEATURE_STORE)


def load_reviews(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_csv(spark, path, None if infer else schemas.REVIEWS)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_text(df: DataFrame, path: str, column: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def _scrub(c, dtype: DataType):
    if isinstance(dtype, (DoubleType, FloatType)):
        return finite_or_null(c)
    if isinstance(dtype, StructType):
        inner = F.struct(*[_scrub(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(c.isNotNull(), inner)
    return c


def finite_results(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every double, nested structs included."""
    return df.select(*[_scrub(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def write_json_results(df: DataFrame, path: str) -> None:
    """One JSON document per row; null fields are written, NaN/Inf become null."""
    finite_results(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def load_optional(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame | None]:
    """Load whatever exists, by extension; a missing file or table gives None.

    ``.csv`` is a headed CSV, ``.json`` JSON lines, ``.md``/``.txt`` whole text files; anything else
    is a Parquet path, or a catalog table when it holds no slash.
    """
    readers = {
        "csv": lambda p: read_csv(spark, p),
        "json": lambda p: spark.read.json(p),
        "md": lambda p: spark.read.text(p, wholetext=True),
        "txt": lambda p: spark.read.text(p, wholetext=True),
    }
    found: dict[str, DataFrame | None] = {}
    for name, path in paths.items():
        if "/" not in path and spark.catalog.tableExists(path):
            found[name] = spark.table(path)
            continue
        reader = readers.get(path.rstrip("/").rsplit(".", 1)[-1], spark.read.parquet)
        try:
            found[name] = reader(path)
        except AnalysisException:
            found[name] = None
    return found
