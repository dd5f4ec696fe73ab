"""A frame written once and read many times, removed when the caller's result is written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from ledgerlake.session import fresh_dir
from ledgerlake.sinks import fs


@contextmanager
def staged(df: DataFrame, tag: str) -> Iterator[DataFrame]:
    """``df`` as a parquet table below the shared work folder, for the time of a ``with`` block.

    What the block makes of it must be written before the block ends: the table is removed then.
    """
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs.delete(spark, path)
