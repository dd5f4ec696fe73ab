"""Scalar helpers F5, F7-F13 that need more than one built-in call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fm_digits(n: Column, width: int = 8) -> Column:
    """``to_char(n, 'FM9...9')`` with ``width`` nines: no padding; too many digits -> '#' x width."""
    limit = 10 ** width
    return F.when(F.abs(n) < F.lit(limit), n.cast("bigint").cast("string")).otherwise(F.lit("#" * width))


def dec(c: Column, dtype: T.DataType, precision: int, scale: int) -> Column:
    """Cast to DECIMAL(p, s) unless the column already is a decimal; with ANSI on, a value that does not fit fails."""
    return c if isinstance(dtype, T.DecimalType) else c.cast(T.DecimalType(precision, scale))


def mart_dec(c: Column) -> Column:
    """Final cast of every mart amount: numeric(23,8)."""
    return c.cast(T.DecimalType(23, 8))


def typed_null(type_name: str) -> Column:
    """``cast(null as <type>)``."""
    return F.lit(None).cast(type_name)
