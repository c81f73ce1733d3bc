"""Result presentation shared by the query catalogue.

Timestamps leave as TIMESTAMP_NTZ (UTC wall clock) and floating sums are
rounded to 4 decimals, so results compare across engines independent of the
session zone and of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

SUM_DECIMALS = 4


def present(df: DataFrame, round_cols: tuple[str, ...] = ()) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ; ``round_cols`` rounded to 4 decimals."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in round_cols:
            c = F.round(c, SUM_DECIMALS)
        cols.append(c.alias(f.name))
    return df.select(*cols)
