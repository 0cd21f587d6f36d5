"""Helpers for DataFrames: tables of a folder, Arrow stages, and durable intermediate tables."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: it survives lost executors,
    cuts the lineage, and is computed once."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    _drop_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once nothing on the driver
    refers to them; otherwise they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` on every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


@contextmanager
def batch_bytes(spark: SparkSession, limit: str) -> Iterator[None]:
    """Arrow batches of at most about ``limit`` in what runs meanwhile, so that a task's memory does not follow
    the 10,000 rows, or 64 MB, of Spark's own limits, of which the JVM and Python each hold several copies."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`stored` table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
