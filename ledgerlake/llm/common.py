"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import fresh_dir
from ledgerlake.sinks import fs

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns by exact name under new names; other columns cannot clash, whatever they are called.

    Works by position, so ``Text`` beside ``text`` or a repeated extra name does no harm.
    """
    names = df.columns
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{names.index(src)}").alias(out) for out, src in columns.items()])


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends there, lost executors lose nothing."""
    spark = df.sparkSession
    path = fresh_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove tables that ``staged`` returned and nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            fs.delete(df.sparkSession, folder)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block a query's shuffle files are removed when it ends; what is used again must be staged."""
    old = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, old)


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def byte_slices(batch: pa.RecordBatch, column: str = "text", rows: int = 256,
                size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of an Arrow batch with the UTF-8 bytes of a text column (null: empty).

    A slice has at most ``rows`` rows and about ``size`` bytes of text (or one longer text),
    so a task holds few texts as objects, also where many long ones meet.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        run = np.cumsum(lengths[at:at + rows])
        n = max(1, int(np.searchsorted(run, size, side="right")))
        yield batch.slice(at, n), [t or b"" for t in texts.slice(at, n).to_pylist()]
        at += n


def table_of(kinds: dict[str, pa.DataType], columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def worker_cache(key: str, build):
    """A value kept by this Python worker between its tasks; one value at a time, whichever operator's it is."""
    store = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker")).__dict__
    if store.get("kept", ("",))[0] != key:
        store.pop("kept", None)                           # gone before the next one is built
        store["kept"] = (key, build())
    return store["kept"][1]
