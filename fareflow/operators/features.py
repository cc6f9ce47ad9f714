"""Raw trips to cleaned trips: typed projection, calendar parts, validity rules.

Everything here is one narrow stage: no shuffle, no Python worker. The rules are
applied to the stored columns, so on Parquet they reach the scan as pushed filters.
"""

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas as S
from fareflow.functions.parsing import PARSERS

_COMPARE = {">": operator.gt, "<": operator.lt, "<=": operator.le}


def _stored_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in df.schema.fields}


def _typed(name: str, stored: dict[str, T.DataType]) -> Column:
    return PARSERS[S.TRIP_TYPES[name]](F.col(name), stored.get(name.lower(), T.NullType()))


def typed_trips(df: DataFrame, labelled: bool, keep: Sequence[str] = ()) -> DataFrame:
    """The trip columns by name, in their contract types; others only if in `keep`."""
    stored = _stored_types(df)
    typed = [_typed(c, stored).alias(c) for c in S.trip_columns(labelled)]
    return df.select(*typed, *keep)


def with_calendar(df: DataFrame, year: bool = False) -> DataFrame:
    """Hour, day of week (1 = Sunday) and month of the pickup time."""
    pickup = F.col(S.PICKUP)
    parts = {"hour": F.hour(pickup), "day_of_week": F.dayofweek(pickup), "month": F.month(pickup)}
    if year:
        parts["year"] = F.year(pickup)
    return df.withColumns(parts)


def validity(df: DataFrame, labelled: bool) -> Column:
    """The row rules over `df`'s own column types.

    Whole-number columns are compared before their cast to double: the outcome is
    the same and, unlike the cast, the comparison can be pushed to Parquet.
    """
    stored = _stored_types(df)

    def operand(name: str) -> Column:
        whole = isinstance(stored.get(name.lower()), T.IntegralType)
        return F.col(name) if whole else _typed(name, stored)

    rules = S.TRIP_RULES + (S.FARE_RULES if labelled else ())
    checks = [_COMPARE[op](operand(name), F.lit(bound)) for name, op, bound in rules]
    for name in S.trip_columns(labelled):
        checks.append(operand(name).isNotNull())
        floating = S.TRIP_TYPES[name] == "double"
        if floating and not isinstance(stored.get(name.lower()), T.IntegralType):
            checks.append(~F.isnan(operand(name)))
    valid = checks[0]
    for check in checks[1:]:
        valid = valid & check
    return valid


def valid_trips(df: DataFrame, labelled: bool) -> DataFrame:
    return df.filter(validity(df, labelled))


def clean_trips(
    df: DataFrame, labelled: bool = True, keep: Sequence[str] = (), year: bool = False
) -> DataFrame:
    """Valid trips as model columns; `keep` passes further columns through."""
    columns = S.CLEANED_COLUMNS if labelled else S.FEATURE_COLUMNS
    extra = (*keep, "year") if year else tuple(keep)
    return (
        df.transform(valid_trips, labelled)
        .transform(typed_trips, labelled, keep)
        .transform(with_calendar, year)
        .select(*columns, *extra)
    )
