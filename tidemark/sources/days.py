"""Tables in one folder per day, of which a run replaces some days and keeps the others where they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import child_folders

_DAY = "__day"


def day_of(time_column: str) -> Column:
    return F.date_format(time_column, "yyyy-MM-dd")


def write_days(rows: DataFrame, root: str, folder: str, day: Column) -> dict[str, str]:
    """Write ``rows`` below ``root/folder``; the folder of each day, relative to ``root``.

    The rebalance hint lets a day be written by as many tasks as its bytes need.
    """
    dated = rows.withColumn(_DAY, day)
    dated.hint("rebalance", F.col(_DAY)).write.mode("overwrite").partitionBy(_DAY).parquet(f"{root}/{folder}")
    names = [name for name in child_folders(rows.sparkSession, f"{root}/{folder}") if "=" in name]
    return {name.split("=", 1)[1]: f"{folder}/{name}" for name in names}


def read_days(
    spark: SparkSession, root: str, days: dict[str, str], schema: T.StructType, only: Iterable[str] | None = None, but: Iterable[str] = ()
) -> DataFrame:
    """The rows of all days, of ``only`` some, or of all ``but`` some; no other folder is looked at."""
    chosen, left = set(days if only is None else only), set(but)
    paths = [f"{root}/{folder}" for day, folder in sorted(days.items()) if day in chosen and day not in left]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
