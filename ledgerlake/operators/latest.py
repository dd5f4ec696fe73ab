"""Newest-batch selection per key (X1) for mirrors fed by ordered deltas.

``keep_newest_batch`` is the reference's rule: among all rows of a key, keep
every row of the newest batch (duplicates inside that batch all survive; NULL
keys form one group).  It is computed as ``max(batch)`` per key -- an
aggregate that combines map-side, so a key holding a third of the rows costs
one partial row per task -- followed by a semi-join on ``(key, batch)``.
Rows of a hot key spread over the join partitions by their batch number as
well, and AQE splits what remains skewed.  No window: a window would sort the
whole hot key inside one task.

``latest_per_key`` is the corrected form: one row per key, the greatest by
(batch, order within the batch), via ``max_by`` -- again an aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_newest_batch(df: DataFrame, keys: list[str], batch: str) -> DataFrame:
    newest = df.groupBy(*keys).agg(F.max(batch).alias("_newest"))
    newest = newest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_newest")
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(newest[f"_k_{k}"]) for k in keys])
    return df.join(newest, cond & (df[batch] == newest["_newest"]), "left_semi")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    red = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_row"))
    return red.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
