"""Type policy for extracted tables.

A JDBC or Parquet reader already hands Spark types over; the policy maps them
to the warehouse's types as one ``select`` of casts (no pass over the data of
its own). Fixed rules of the pipeline:

* any integer  -> LongType
* float/double -> DoubleType
* decimal      -> kept (option: DoubleType)
* boolean, date, binary -> kept
* timestamp without zone -> TimestampNTZType; with zone -> TimestampType
  (option: truncate to whole seconds)
* integer arrays -> ArrayType(LongType); other arrays -> ArrayType(StringType)
* anything else -> StringType
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import trunc_to

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def target_type(dtype: T.DataType, decimal_as_double: bool = False) -> T.DataType:
    if isinstance(dtype, _INTEGERS):
        return T.LongType()
    if isinstance(dtype, _FLOATS):
        return T.DoubleType()
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType() if decimal_as_double else dtype
    if isinstance(dtype, (T.BooleanType, T.DateType, T.BinaryType,
                          T.TimestampType, T.TimestampNTZType)):
        return dtype
    if isinstance(dtype, T.ArrayType):
        inner = T.LongType() if isinstance(dtype.elementType, _INTEGERS) else T.StringType()
        return T.ArrayType(inner, True)
    return T.StringType()


def policy_column(field: T.StructField, decimal_as_double: bool = False,
                  truncate_seconds: bool = False) -> Column:
    target = target_type(field.dataType, decimal_as_double)
    c = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)) and truncate_seconds:
        # a zoned stamp is truncated as an instant; one without a zone from its own fields
        c = trunc_to("second", c) if isinstance(field.dataType, T.TimestampNTZType) else F.date_trunc("SECOND", c)
    if target != field.dataType or truncate_seconds and isinstance(
            field.dataType, (T.TimestampType, T.TimestampNTZType)):
        c = c.cast(target)
    return c.alias(field.name)


def apply_type_policy(df: DataFrame, decimal_as_double: bool = False,
                      truncate_seconds: bool = False) -> DataFrame:
    """Cast every column to the warehouse type; names and order unchanged."""
    return df.select(*[policy_column(f, decimal_as_double, truncate_seconds)
                       for f in df.schema.fields])
