"""Upsert of a batch into a keyed table (W1) and replace-where.

Upsert keeps the reference's row-by-row ``INSERT ... ON CONFLICT DO UPDATE``
semantics, set-based:

* inside the batch the **last row in file order wins** per key;
* target rows whose key is not in the batch stay;
* for keys in the batch, every column named in the batch is replaced and
  target columns the batch lacks keep their old value (new keys get NULL);
* nothing is deleted.

Scale: the batch is reduced to one row per key with ``max_by`` -- an
aggregate, so it combines map-side and a hot key (a third of the batch) does
not end up as one giant sort group -- then the target is anti-joined on the
key and the reduced batch appended.  Both sides shuffle once on the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, pk: list[str], order: list[str] | Column) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (a file-order column or columns)."""
    okey = order if isinstance(order, Column) else F.struct(*[F.col(c) for c in order])
    rest = [c for c in batch.columns if c not in pk]
    if not rest:
        return batch.select(*pk).distinct()
    red = batch.groupBy(*pk).agg(F.max_by(F.struct(*rest), okey).alias("_row"))
    return red.select(*pk, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(target: DataFrame, batch: DataFrame, pk: list[str], order: list[str] | Column) -> DataFrame:
    """Result of applying ``batch`` to ``target`` row by row in file order (see module doc).

    Target rows whose key the batch does not touch pass an anti-join on the
    key, and only the touched rows are read for carried-over columns.  Spark
    broadcasts the batch's key set where it turns out small.
    """
    new = last_per_key(batch, pk, order)
    keys = new.select(*pk)
    missing = [c for c in target.columns if c not in new.columns]
    if missing:
        old = target.join(keys, pk, "left_semi").select(*pk, *[F.col(c).alias(f"_old_{c}") for c in missing])
        new = new.join(old, pk, "left").select(
            *new.columns, *[F.col(f"_old_{c}").alias(c) for c in missing])
    kept = target.join(keys, pk, "left_anti")
    return kept.unionByName(new.select(*target.columns))


def replace_where(target: DataFrame, new_rows: DataFrame, cond: Column) -> DataFrame:
    """``DELETE FROM target WHERE cond; INSERT new_rows`` -- rows where ``cond`` is NULL are kept.

    Used for "replace one day" (W2: a day that gets no new rows ends empty,
    which dynamic partition overwrite would get wrong) and "replace one
    month" (W3, key = from_date, to_date).
    """
    return target.filter(~F.coalesce(cond, F.lit(False))).unionByName(new_rows.select(*target.columns))


def duplicate_keys(df: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that occur more than once (a primary key must be unique and not NULL)."""
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"), F.max(null_key).alias("has_null"))
            .filter((F.col("n") > 1) | F.col("has_null")).drop("has_null"))
