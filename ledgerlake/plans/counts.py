"""Group counts and a dimension join (L7: A4, A5, J8).

``count_by`` counts rows per value (case-sensitive, NULL is a group) with a
partial aggregate.  ``count_for_dim`` attaches those counts to a dimension
whose names are lower case, matching ``lower(name)`` of the counted values;
dimension rows without a match keep a NULL count, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).count()


def count_for_dim(dim: DataFrame, dim_col: str, counts: DataFrame, count_col: str) -> DataFrame:
    c = counts.select(F.lower(F.col(count_col)).alias("_name"), F.col("count"))
    return dim.join(c, dim[dim_col] == c["_name"], "left").select(dim[dim_col], "count")
