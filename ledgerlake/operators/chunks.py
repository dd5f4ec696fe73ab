"""Message splitting into fixed-size pieces (F17): the run log's 4000-character rows.

``'' `` and NULL give no rows; a 9001-character text gives 4000/4000/1001.
Pure column expressions (``sequence`` + ``substring``), so whole texts are
split inside the executors, one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the reference's piece length for the log table.
LOG_PIECE = 4000


def split_chunks(df: DataFrame, col: str, size: int = LOG_PIECE, index: str = "chunk_no",
                 out: str = "chunk") -> DataFrame:
    n = F.length(F.col(col))
    pieces = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / F.lit(size)).cast("int")))
    keep = [c for c in df.columns if c != col]
    exploded = df.select(*keep, F.col(col), F.explode(pieces).alias(index))
    return exploded.select(*keep, F.col(index),
                           F.expr(f"substring(`{col}`, {index} * {size} + 1, {size})").alias(out))
