"""Column types that BI tools import, and the Parquet sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types that BI importers read as they are.
PORTABLE = (
    T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.BinaryType, T.ArrayType,
)


def bi_types(df: DataFrame, empty_types: Mapping[str, str] | None = None) -> DataFrame:
    """Decimals as double, dates as timestamps, and untyped (all-NULL) columns with a type.

    ``empty_types`` names the type of untyped columns; string is the default.
    """

    def cast(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.NullType):
            return c.cast((empty_types or {}).get(field.name, "string")).alias(field.name)
        return c

    return df.select(*[cast(f) for f in df.schema])


def unportable_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Columns whose type a BI importer cannot read, as ``(name, type)``."""
    return [
        (f.name, f.dataType.simpleString()) for f in df.schema if not isinstance(f.dataType, PORTABLE)
    ]


def write_parquet(df: DataFrame, path: str, empty_types: Mapping[str, str] | None = None) -> None:
    """``df`` with BI-readable types, as snappy Parquet, replacing what was there."""
    ready = bi_types(df, empty_types)
    offenders = unportable_columns(ready)
    if offenders:
        raise ValueError(f"columns that BI importers cannot read: {offenders}")
    ready.write.mode("overwrite").option("compression", "snappy").parquet(path)
