"""Text labels of values, as used for grouping and display."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def double_label(v: Column) -> Column:
    """Plain decimal text: ``5`` for 5.0 and no exponent below 1e15."""
    whole = (v == F.floor(v)) & (F.abs(v) < 1e15)
    plain = F.regexp_replace(v.try_cast("decimal(38,9)").cast("string"), r"\.?0+$", "")
    return (
        F.when(whole, F.when(whole, v).cast("long").cast("string"))
        .when((F.abs(v) >= 1e7) & (F.abs(v) < 1e15), plain)
        .otherwise(v.cast("string"))
    )


def label(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return double_label(value.cast("double") if isinstance(data_type, T.DoubleType)
                            else value.cast("string").cast("double"))
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    return value.cast("string")
