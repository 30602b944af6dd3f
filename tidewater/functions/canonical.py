"""An order-free form of nested values, in which rows with maps compare, group and subtract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(c: Column, dtype: T.DataType) -> Column:
    """Maps as arrays of entries sorted by key, at any depth; NaN is one value and -0.0 is 0.0."""
    if isinstance(dtype, T.StructType):
        fields = [canonical(c.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: canonical(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            canonical(e["key"], dtype.keyType).alias("key"), canonical(e["value"], dtype.valueType).alias("value"))))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        zero = F.lit(0.0).cast(dtype)
        return F.when(c == zero, zero).otherwise(c)
    return c


def canonical_rows(df: DataFrame) -> DataFrame:
    """The frame with every column in canonical form, for ``exceptAll``, grouping and joins."""
    return df.select(*[canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(rows in canonical form, n): how many more of each row left has than right (negative: right has more); equal counts are left out.

    One shuffle of both, combined on the map side, so a row that a third of the table repeats moves as a count."""
    a, b = canonical_rows(left), canonical_rows(right)
    both = a.withColumn("n", F.lit(1)).unionByName(b.withColumn("n", F.lit(-1)))
    return both.groupBy(*[f"`{c}`" for c in a.columns]).agg(F.sum("n").alias("n")).where("n <> 0")
