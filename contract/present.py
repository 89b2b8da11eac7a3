"""Column types that compare equal across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH_LIKE = {"MONTH", "ORDER_MONTH", "ORDER_QUARTER"}


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles, every integer as bigint, month keys as dates."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif f.name.upper() in MONTH_LIKE and not isinstance(f.dataType, (T.LongType, T.StringType)):
            c = c.cast("date")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded, for results that depend on summation order in the last bits."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])
