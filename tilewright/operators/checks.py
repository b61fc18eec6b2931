"""Whole-table checks, each one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of_type(kind: str, column: str = "geom_type") -> Column:
    """Whether every row has a type; null counts as another one."""
    return F.bool_and(F.coalesce(F.col(column) == kind, F.lit(False)))


def contains_multipolygons(column: str = "geom_type") -> Column:
    return F.coalesce(F.bool_or(F.col(column) == "MultiPolygon"), F.lit(False))


def n_true(label: str) -> Column:
    return F.coalesce(F.sum(F.coalesce(F.col(label), F.lit(False)).cast("long")), F.lit(0))


def any_null(column: str) -> Column:
    return F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False))


def check(df: DataFrame, wanted: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row of named checks, or one for each group."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in wanted.items()])
