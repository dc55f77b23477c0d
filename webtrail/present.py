"""Cross-engine presentation of a result: plain, engine-neutral column types.

Dates become ``yyyy-MM-dd`` strings, timestamps ``yyyy-MM-dd HH:mm:ss.SSSSSS``
strings, decimals and integers doubles (integers unrounded; every value here is
far below 2**53), and doubles are rounded to six places, so a result has the
same pandas types and values whichever engine produced it (a nullable integer
column would otherwise be float64 from one engine and Int64 from the other).  Used only by
the query registry; the table builders keep their native types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)
