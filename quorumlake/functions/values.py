"""Typed-value helpers: dates, defaults, type tags and serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_month_day_year(text: Column) -> Column:
    """`M/D/YYYY` to a timestamp; null where the text is no such date."""
    return F.try_to_timestamp(F.trim(text), F.lit("M/d/yyyy"))


def parse_date_and_clock(date: Column, clock: Column) -> Column:
    """The day part of `date` joined with a 12-hour clock time."""
    stamp = F.concat(F.substring_index(date, "T", 1), F.lit("T"), clock)
    return F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd'T'h:mm a"))


def to_iso_z(stamp: Column) -> Column:
    """ISO form with microseconds and a `Z`."""
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def from_iso_z(text: Column) -> Column:
    """ISO text with a `Z`, with or without a fraction, to a timestamp."""
    return F.try_to_timestamp(F.replace(text, F.lit("Z"), F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))


def index_or_default(value: Column) -> Column:
    """A sequence number, with missing or zero mapped to -1."""
    return F.coalesce(F.nullif(value.cast("int"), F.lit(0)), F.lit(-1))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


# Type tags stored beside a value.
_TAGS = {
    "INTEGER": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "DOUBLE": (T.FloatType, T.DoubleType),
    "STRING": (T.StringType,),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
}


def type_tag(df: DataFrame, column: str) -> Column:
    """The tag of a column's type; other types give their own name."""
    dtype = df.schema[column].dataType
    for tag, kinds in _TAGS.items():
        if isinstance(dtype, kinds):
            return F.lit(tag)
    return F.lit(dtype.simpleString())


def as_stored_text(df: DataFrame, column: str) -> Column:
    """Scalars as text; nested values as JSON."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")
