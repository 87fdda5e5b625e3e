"""Small helpers to accept columns by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_open(df: DataFrame, name: str) -> bool:
    """Whether the table has the column and its values have types of their own."""
    return name in df.columns and "variant" in df.schema[name].dataType.simpleString()


def column_or_null(df: DataFrame, name: str, dtype: DataType) -> Column:
    """The column if the table has it, else a typed NULL."""
    if name in df.columns:
        return F.col(name).cast(dtype).alias(name)
    return F.lit(None).cast(dtype).alias(name)


def held_column(df: DataFrame, name: str, dtype: DataType, open_type: DataType) -> Column:
    """As ``column_or_null``, of the open type where the column's values are typed."""
    return column_or_null(df, name, open_type if is_open(df, name) else dtype)
