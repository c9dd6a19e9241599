"""Probability of the positive class, whatever form it is stored in."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def positive_probability(df: DataFrame, column: str) -> Column:
    """P(class 1) from a vector, an array, a struct with ``values`` or a plain number."""
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, VectorUDT):
        return F.get(vector_to_array(col), F.lit(1))
    if isinstance(kind, T.ArrayType):
        return F.get(col, F.lit(1)).cast("double")
    if isinstance(kind, T.StructType):
        if "values" in kind.names and isinstance(kind["values"].dataType, T.ArrayType):
            return F.get(col["values"], F.lit(1)).cast("double")
        return F.lit(None).cast("double")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    return F.lit(None).cast("double")


def with_probability(df: DataFrame, out: str = "prob_congestion") -> DataFrame:
    """Add ``out`` from the first probability column present; null when there is none."""
    for name in (out, "probability", "probability_lr"):
        if name in df.columns:
            return df.withColumn(out, positive_probability(df, name))
    return df.withColumn(out, F.lit(None).cast("double"))
