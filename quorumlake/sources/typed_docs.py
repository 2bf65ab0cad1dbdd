"""Documents whose values carry their type: `{field: {stringValue: ...}}`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import from_iso_z

# Type keys of a document value.
STRING, INTEGER, DOUBLE = "stringValue", "integerValue", "doubleValue"
BOOLEAN, TIMESTAMP = "booleanValue", "timestampValue"


def _value(field: str, kind: str) -> Column:
    return F.try_element_at(F.try_element_at(F.col("_fields"), F.lit(field)), F.lit(kind))


def _decoded(field: str, dtype: str) -> Column:
    if dtype == "long":
        return _value(field, INTEGER).cast("long")
    if dtype == "double":
        return F.coalesce(_value(field, DOUBLE), _value(field, INTEGER)).cast("double")
    if dtype == "boolean":
        return _value(field, BOOLEAN).cast("boolean")
    if dtype == "timestamp":
        return from_iso_z(_value(field, TIMESTAMP))
    kinds = (STRING, INTEGER, DOUBLE, BOOLEAN, TIMESTAMP)
    return F.coalesce(*[_value(field, kind) for kind in kinds])


def decode(documents: DataFrame, id_column: str, fields: dict[str, str]) -> DataFrame:
    """Typed columns from `(name, fields)` rows, `fields` being JSON text.

    The id is the last segment of the document name. `fields` maps each wanted
    field to long, double, boolean, timestamp or string.
    """
    parsed = documents.withColumn("_fields", F.from_json("fields", "map<string, map<string, string>>"))
    return parsed.select(
        F.substring_index("name", "/", -1).alias(id_column),
        *[_decoded(field, dtype).alias(field) for field, dtype in fields.items()],
    )
