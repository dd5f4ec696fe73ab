"""Delta sessions as a file stream (optional re-aim of L8, not a reference capability).

New delta files under ``<base>/delta_id=<id>/`` are picked up by a file
source that tells their names; each micro-batch reads its files by their
headers, as the batch job does (``read_deltas``), and is applied to the stored
mirror with ``foreachBatch``.  Columns match by name, whatever their order; a
column that a file adds is added to the mirror.  The streaming checkpoint is the "already loaded" log.  The
mirror's manifest records the last epoch of each checkpoint in the same
switch that brings in its rows, so a replayed micro-batch is skipped.  Rows
keep their session id: a session may arrive in several micro-batches (its
rows add up) and a session that arrives late never overrides a newer one, as
in the batch job.  Each micro-batch rewrites only the buckets its keys fall
into and prunes older versions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.plans.mirror import BUCKETS, DELTA_COL, MirrorStore
from ledgerlake.sources import deltas as D
from ledgerlake.sources.csv_files import read_deltas

KEEP_VERSIONS = 3
# Fixed value: the columns of Spark's file listing source; a stream reads the paths only, never the content.
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def start_mirror_stream(spark: SparkSession, deltas_base: str, schema: T.StructType, keys: list[str],
                        mirror_path: str, checkpoint: str, mode: str = "faithful", order: list[str] | None = None,
                        timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", available_now: bool = True,
                        keep_versions: int = KEEP_VERSIONS, max_files: int | None = None, date_format: str = "dd.MM.yyyy"):
    """Start the stream; with ``available_now`` it processes what is there and stops.  ``schema`` holds the mirror's columns."""
    reader = (spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    apply_rows = batch_writer(spark, mirror_path, keys, checkpoint, mode, order, keep_versions)

    def apply_files(batch: DataFrame, epoch_id: int) -> None:
        files = sorted(r["path"] for r in batch.select("path").collect())      # one row a file of this trigger
        if files:
            rows, wider = read_deltas(spark, files, schema, keys, date_format=date_format, timestamp_format=timestamp_format)
            rows = rows.withColumn(DELTA_COL, D.delta_id_of_path(F.col("_file"), "partitioned")).drop("_file")
            apply_rows(rows, epoch_id, wider)

    w = reader.load(deltas_base).writeStream.foreachBatch(apply_files).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def batch_writer(spark: SparkSession, mirror_path: str, keys: list[str], checkpoint: str, mode: str = "faithful",
                 order: list[str] | None = None, keep_versions: int = KEEP_VERSIONS):
    """The function that applies an epoch's delta rows once, whatever a restart replays; ``schema`` names columns they add."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def apply_batch(batch: DataFrame, epoch_id: int, schema: T.StructType | None = None) -> None:
        store = MirrorStore(spark, mirror_path, keys)
        epochs = store.table.notes().get("epochs", {})
        if epochs.get(stream, -1) >= epoch_id:
            return
        stored = store.schema()
        have = {f.name.lower() for f in stored.fields}
        wider = T.StructType([*stored.fields, *(f for f in (schema or stored).fields if f.name.lower() not in have)])
        store.apply(batch, wider, mode, order, {"epochs": epochs | {stream: epoch_id}})
        store.table.prune(keep_versions)

    return apply_batch


def read_mirror(spark: SparkSession, mirror_path: str) -> DataFrame:
    return MirrorStore(spark, mirror_path, []).read()


def seed_mirror(spark: SparkSession, seed: DataFrame, mirror_path: str, keys: list[str], buckets: int = BUCKETS,
                mode: str = "faithful", order: list[str] | None = None) -> None:
    MirrorStore(spark, mirror_path, keys, buckets).seed(seed, mode, order)
