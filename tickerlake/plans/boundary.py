"""Types at the query boundary, so results compare across engines.

Inside the library every price and percentage is an exact DECIMAL. At the
edge of a registered query, decimals with places become DOUBLE and whole
decimals become BIGINT; arrays become comma-joined strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_plain_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double" if f.dataType.scale else "bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
