"""Extreme rows with ties (X4) for several categories at once.

``extreme_rows(df, {"Min_x": ("min", "x"), ...})`` returns every row whose
column equals the global min/max of that column, tagged with the category; a
row that is the extreme of several categories appears once per category,
like the reference's 4-way ``UNION ALL``.

Plan: the extremes are scalar subqueries over one aggregate (Spark merges
them into a single aggregate pass and broadcasts the scalars); the rows are
then tagged in one scan with ``explode`` over the matching tags.  No global
window (which would pull every row into one task) and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extreme_rows(df: DataFrame, categories: dict[str, tuple[str, str]], tag: str = "Category") -> DataFrame:
    fns = {"min": F.min, "max": F.max}
    stats = df.agg(*[fns[fn](F.col(col)).alias(f"_x{i}") for i, (fn, col) in enumerate(categories.values())])
    tags = []
    for i, (name, (_, col)) in enumerate(categories.items()):
        scalar = stats.select(f"_x{i}").scalar()
        tags.append(F.when(F.col(col) == scalar, F.lit(name)))
    return df.select(F.explode(F.array(*tags)).alias(tag), "*").filter(F.col(tag).isNotNull())
