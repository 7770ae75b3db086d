"""Fingerprints of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tallyward.functions.text import quoted

# Any two different numbers.
SEEDS = (17, 71)


def row_prints(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a row, as two integers: equal rows have equal ones, nulls and both zeros counted as equal.

    The columns go by position, so names do not matter. Which columns are null is hashed too, because a hash passes
    over nulls and would take (null, 1) for (1, null).
    """
    values = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        values.append(c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, DoubleType | FloatType) else c)
    nulls = [F.col(quoted(f.name)).isNull() for f in df.schema.fields]
    a, b = (F.xxhash64(F.lit(seed), *values, *nulls) for seed in SEEDS)
    return a, b
