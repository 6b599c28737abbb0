"""Named, typed columns from positional fields, and JSON text conversion."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import field_at

# Type names a schema config may use; anything else is a string.
TYPES = {
    "integer": T.IntegerType(),
    "string": T.StringType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
    "decimal": T.DecimalType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "date": T.DateType(),
}
_SIZED_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def field_type(name: str) -> T.DataType:
    sized = _SIZED_DECIMAL.fullmatch(name)
    if sized:
        return T.DecimalType(int(sized.group(1)), int(sized.group(2)))
    return TYPES.get(name, T.StringType())


def build_schema(fields: Iterable[Mapping[str, str]]) -> T.StructType:
    """A schema from `{name, type}` entries; every field is nullable."""
    return T.StructType([T.StructField(f["name"], field_type(f["type"])) for f in fields])


def typed_projection(df: DataFrame, schema: T.StructType, fields: str = "fields") -> DataFrame:
    """Positional fields as named, typed columns; text that does not convert is null."""
    return df.select(*[
        field_at(F.col(fields), i).try_cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema.fields)
    ])


def json_decode(text: Column, schema: T.DataType) -> Column:
    return F.from_json(text, schema)


def json_encode(value: Column) -> Column:
    return F.to_json(value)
