"""Seed files and partitioned fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CELL_REFERENCE


def read_seed(spark: SparkSession, path: str, schema: T.StructType = CELL_REFERENCE) -> DataFrame:
    """A CSV reference file with declared types; a row that does not fit them is an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def load_seed(spark: SparkSession, csv_path: str, table_path: str, schema: T.StructType = CELL_REFERENCE) -> None:
    """Replace the reference table by the content of the CSV file."""
    read_seed(spark, csv_path, schema).write.mode("overwrite").parquet(table_path)


def append_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("event_date", "network_type"),
    max_records_per_file: int = 1_000_000,
    mode: str = "append",
) -> None:
    """Write a fact table in folders by day and network type, with evenly sized files.

    The rebalance hint groups rows by partition value and lets adaptive execution split the big
    partitions and join the small ones, so a day with a third of all rows is written by many
    tasks; a plain ``repartition`` by these columns would send it to one.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_cols])
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def create_fact_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_cols: Sequence[str] = ("event_date", "network_type"),
    provider: str = "parquet",
    properties: dict[str, str] | None = None,
) -> None:
    """Declare a partitioned catalog table if it is missing.

    ``partition_cols`` may be transforms such as ``days(event_ts)`` where the provider has them;
    ``properties`` pass on provider settings such as a target file size.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    settings = ", ".join(f"'{name}' = '{value}'" for name, value in (properties or {}).items())
    spark.sql(
        f"create table if not exists {table} ({columns}) using {provider} "
        f"partitioned by ({', '.join(partition_cols)})" + (f" tblproperties ({settings})" if settings else "")
    )


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables and views available to SQL in this session, under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
