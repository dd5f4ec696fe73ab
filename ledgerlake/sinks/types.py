"""Types of a stored column over time (W13, W15): which changes keep every value, and how older rows are read.

Widening goes along integer -> long -> decimal -> text, float -> double -> text, integers -> double where every value
fits, date -> timestamp -> text.  A decimal may grow on either side of the point.  Double -> decimal is allowed for
decimals with at least 15 digits before the point, as amounts are stored: values are rounded to the decimal's
scale when read, and one that does not fit is an error.  Everything else is a narrowing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits that hold every value of an integer type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_SIZE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
AMOUNT_DIGITS = 15


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether a column of type ``old`` may become one of type ``new`` without rewriting the rows stored so far."""
    a, b = type(old), type(new)
    if old == new or isinstance(old, T.NullType):
        return True
    if isinstance(new, T.StringType):
        return isinstance(old, (T.AtomicType,)) and not isinstance(old, T.BinaryType)
    if a in _DIGITS:
        if b in _DIGITS:
            return _SIZE.index(a) <= _SIZE.index(b)
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= _DIGITS[a]
        return isinstance(new, T.DoubleType) and a is not T.LongType
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    if isinstance(old, T.DoubleType):
        return isinstance(new, T.DecimalType) and new.precision - new.scale >= AMOUNT_DIGITS
    return isinstance(old, T.DateType) and isinstance(new, (T.TimestampType, T.TimestampNTZType))


def refused(old: T.StructType, new: T.StructType) -> list[str]:
    """The columns of ``old`` whose change to ``new`` is no widening, as text; dropped and added columns are none."""
    have = {f.name.lower(): f.dataType for f in new.fields}
    return [f"{f.name}: {f.dataType.simpleString()} -> {have[f.name.lower()].simpleString()}" for f in old.fields
            if f.name.lower() in have and not widens(f.dataType, have[f.name.lower()])]


def as_of_now(old: T.StructType, new: T.StructType) -> list[Column]:
    """The columns of ``new`` from rows stored as ``old``: widened, NULL where the column came later."""
    have = {f.name.lower(): f.name for f in old.fields}
    return [(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in new.fields]
