"""Typing of raw trip columns: what cannot be read becomes NULL, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(value: Column, stored: T.DataType) -> Column:
    return value if isinstance(stored, T.DoubleType) else value.try_cast("double")


def to_long(value: Column, stored: T.DataType) -> Column:
    """Whole number; text such as `132.0` is truncated to 132."""
    if isinstance(stored, T.LongType):
        return value
    if not isinstance(stored, T.StringType):
        return value.try_cast("bigint")
    whole_part = F.regexp_extract(value, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(value.try_cast("bigint"), whole_part.try_cast("bigint"))


def to_pickup_time(value: Column, stored: T.DataType) -> Column:
    """Text needs a date; a time of day alone is no pickup time. Stored timestamps stay as they are."""
    if not isinstance(stored, T.StringType):
        return value
    return F.when(value.try_cast("date").isNotNull(), value.try_cast("timestamp"))


PARSERS = {"double": to_double, "bigint": to_long, "timestamp": to_pickup_time}
