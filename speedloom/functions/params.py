"""Fitted parameters as columns: from a one-row frame or from its fetched row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def parameters(source: DataFrame | Row, *names: str) -> dict[str, Column]:
    """Columns holding the named values of ``source``.

    A frame becomes one scalar subquery (it has one row by construction) and stays lazy;
    a row that was fetched before becomes constants and keeps the plan small.
    """
    if isinstance(source, Row):
        return {n: F.lit(source[n]) for n in names}
    values = source.select(F.struct(*names).alias("p")).scalar()
    return {n: values[n] for n in names}
