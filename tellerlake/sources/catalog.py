"""Catalog tables over lake files and report outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellerlake import schemas as S
from tellerlake.sources.readers import read_transactions


def register_source(
    spark: SparkSession, table: str, path: str, view: str = "lake_transactions"
) -> str:
    """Name to query transactions under: the catalog table, or a view over its files."""
    if spark.catalog.tableExists(table):
        return table
    read_transactions(spark, path).createOrReplaceTempView(view)
    return view


def register_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """(Re)point an external table at a finished Parquet output; files are not touched."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(f"CREATE TABLE {database}.{name} USING PARQUET LOCATION '{path}'")


def register_lake(spark: SparkSession, database: str, name: str, path: str) -> None:
    """External table over the ``step=`` partitioned lake, with its partitions recovered."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.TRANSACTION_SCHEMA)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(
        f"CREATE TABLE {database}.{name} ({columns}) USING PARQUET "
        f"PARTITIONED BY (step) LOCATION '{path}'"
    )
    recover_partitions(spark, f"{database}.{name}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def create_fraud_view(spark: SparkSession, database: str, table: str, view: str) -> None:
    """Stored view of confirmed fraud, the definition shared by all readers."""
    names = ", ".join(f"`{n}`" for n in S.TRANSACTION_SCHEMA.fieldNames()[:-1])
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{view} AS "
        f"SELECT {names} FROM {database}.{table} WHERE isFraud = 1"
    )


def save_mart(
    mart: DataFrame, database: str, name: str = "txn_summary_mart", buckets: int | None = None
) -> None:
    """Replace the managed mart table.

    With ``buckets`` the mart is clustered by customer, so later joins and
    aggregations on the customer read it without a shuffle.
    """
    mart.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = mart.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "customerId").sortBy("customerId", "step")
    writer.saveAsTable(f"{database}.{name}")


def analyze(spark: SparkSession, table: str, columns: bool = False) -> None:
    """Table statistics, optionally with column statistics for range estimates."""
    scope = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{scope}")
