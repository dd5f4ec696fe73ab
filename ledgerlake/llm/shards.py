"""Sharding by sampled splitters: near-equal bytes per shard, equal texts side by side.

Records are ordered by a 60-bit key: 44 bits of the text's md5, then 16 bits of the
id's md5, so copies of a text are neighbours and a huge group of copies can still be
cut.  Splitters are quantiles of a key sample in which a record's chance grows with
its size.  Records are range-partitioned on them; a range with more than twice its
share of bytes, or far more rows than a task should order, is subdivided with a denser
sample of its own.  There are ``ranges_per_shard`` ranges a shard or one for each
``rows_per_range`` records, whichever is more, so a task's rows stay bounded as the
table grows.  Exact byte and row sums of the ranges (one short row each, 25,000 of them
for 5e10 records) give each range its place, a running sum inside the range gives each
record its own, and a record's middle byte names its shard.
Splitters only decide where the work is done; the result is the exact cut.

Defined results: a null text has size 16 and counts as the empty text; records that
agree in key and id are interchangeable; a record larger than a share fills its shard
alone and may leave a shard empty; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, staged

OVERHEAD = 16            # bytes a record takes besides its text
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 2_000_000
SAMPLES_PER_RANGE = 16
ROUNDS = 6               # of subdividing; a range of one key cannot be cut further


def _hex(text: F.Column, digits: int) -> F.Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the order key."""
    d = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    return d.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"),
                    (_hex(text, 11) * 65536 + _hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 4)).alias("key"))


def _range_of(splitters: list[int]):
    cuts = np.array(sorted(splitters), np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.int64), side="right").astype(np.int32))
    return range_of


def _sample(rows: DataFrame, expected: int, total: int, seed: int) -> list[int]:
    """Keys drawn with a chance in proportion to size; about ``expected`` of them."""
    u = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return sorted(r[0] for r in rows.where(u < F.col("size") * F.lit(expected / max(1, total))).select("key").collect())


def _quantiles(keys: list[int], parts: int) -> set[int]:
    return {keys[len(keys) * i // parts] for i in range(1, parts)} if keys else set()


def split_ranges(rows: DataFrame, total: int, ranges: int, rows_per_range: int = ROWS_PER_RANGE) -> tuple[list[int], list[tuple]]:
    """Splitters and (range, bytes, rows) in order, ranges of too many bytes or rows subdivided."""
    cuts = _quantiles(_sample(rows, ranges * SAMPLES_PER_RANGE, total, 0), ranges)
    share = total / ranges
    for attempt in range(ROUNDS + 1):
        placed = rows.withColumn("range", _range_of(list(cuts))("key"))
        sums = sorted(tuple(r) for r in placed.groupBy("range").agg(
            F.sum("size"), F.count(F.lit(1)), F.min("key"), F.max("key")).collect())
        over = [r for r in sums if (r[1] > 2 * share or r[2] > 2 * rows_per_range) and r[3] < r[4]]
        if not over or attempt == ROUNDS:
            return sorted(cuts), [r[:3] for r in sums]
        inside = placed.where(F.col("range").isin([r[0] for r in over]))
        bytes_over = sum(r[1] for r in over)
        parts = sum(int(np.ceil(max(r[1] / share, r[2] / rows_per_range))) for r in over)
        drawn = _sample(inside, parts * SAMPLES_PER_RANGE, bytes_over, attempt + 1)
        cuts |= set(drawn[SAMPLES_PER_RANGE // 2::SAMPLES_PER_RANGE // 2]) | {r[4] for r in over}


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  ranges_per_shard: int = RANGES_PER_SHARD, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard (0 to shards-1), slot (0, 1, .. inside the shard)."""
    spark = docs.sparkSession
    rows = staged(records(docs, id_col, text_col), "shard-records")
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    ranges = max(shards * ranges_per_shard, -(-count // rows_per_range))
    cuts, sums = split_ranges(rows, total, ranges, rows_per_range) if total else ([], [])
    offsets, b, n = [], 0, 0
    for r, size, count in sums:
        offsets.append((r, b, n))
        b, n = b + size, n + count
    starts = F.broadcast(spark.createDataFrame(offsets, "range int, bytes_before long, rows_before long"))   # one row a range
    w = Window.partitionBy("range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * (F.col("bytes_before") + F.sum("size").over(w)) - F.col("size")
    placed = staged(
        rows.withColumn("range", _range_of(cuts)("key")).join(starts, "range")
        .withColumn("middle", middle).withColumn("rank", F.col("rows_before") + F.row_number().over(w.orderBy("key", "doc_id")) - 1)
        .select("doc_id", "size", "text_crc32", "rank",
                F.least(F.lit(shards - 1), F.floor(F.expr(f"(middle * {shards}) div {2 * max(1, total)}"))).cast("int").alias("shard")),
        "shard-places")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first")))                            # one row a shard
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard",
                                              (F.col("rank") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the records into ``path/shard=N``, each shard in slot order within its files; ids must be distinct."""
    at = assign_shards(docs, shards, id_col, text_col).select(F.col("doc_id").alias("_id"), "shard", "slot")
    docs.join(at, docs[id_col].eqNullSafe(at["_id"])).drop("_id").repartitionByRange("shard", "slot") \
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
