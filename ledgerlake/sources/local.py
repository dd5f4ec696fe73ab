"""Small frames of literal rows, built JVM-side (log entries, session lists, empty tables).

``spark.createDataFrame(list)`` goes through a Python RDD and needs Python
workers; a handful of literal rows does not.  Here the rows become one
``inline`` of literal structs over ``range(1)``: a plain JVM plan, typed by the
given schema, and values never spliced into SQL text (Q8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = schema.fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
