"""Feature tables in the session's catalog: by name in SQL, and bucketed for joins without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perilgrid.schema import FEATURE_TYPES
from perilgrid.sources.feature_table import CODEC, conform, table_path

ROWS_PER_FILE = 250_000
MAX_TASKS = 200  # up to here Spark writes a shuffle straight to files, without sorting and spilling


def attach_feature_table(spark: SparkSession, root: str, name: str, table: str) -> DataFrame:
    """Give a stored feature table a name in SQL; the data stay where they are.

    Functions for geometries work on views: see :func:`perilgrid.functions.sql.create_feature_view`.
    """
    schema = FEATURE_TYPES[name].table_schema
    return spark.catalog.createTable(table, path=table_path(root, name), source="parquet", schema=schema)


def create_bucketed_table(
    df: DataFrame, name: str, table: str, keys: list[str], buckets: int, mode: str = "error"
) -> DataFrame:
    """Save a feature table in the catalog, clustered and sorted by key columns.

    Tables of equally many buckets by the same keys are joined and grouped by them without a shuffle. Rows go
    to a task of their bucket first: a small bucket is one file, a large one several, each sorted in memory. They
    go as they are given, without the attributes that are null throughout. A key that holds a large share of the
    rows makes one large file: such tables are better left to the joins that split hot keys.
    """
    # a row goes by the same hash to its task and to its bucket, so tasks a multiple of the buckets write one bucket each
    files = min(-(-df.count() // (buckets * ROWS_PER_FILE)), max(1, MAX_TASKS // buckets))
    rows = conform(df.repartition(buckets * max(1, files), *keys), name)
    writer = rows.write.format("parquet").mode(mode).option("compression", CODEC)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
