"""JSON payload expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the metadata API answers for one token.
RESPONSE_SCHEMA = "success string, data struct<symbol: string, name: string, decimals: bigint>"


def is_true(value: Column) -> Column:
    """Truth of a JSON scalar read as text: all but NULL, false, zero and empty text."""
    text = F.lower(F.trim(value))
    return text.isNotNull() & ~text.isin("", "false") & ~text.rlike(r"^[+-]?0+(\.0*)?(e[+-]?\d+)?$")


def json_value(body: Column) -> Column:
    """Body as a variant; bad JSON fails the job."""
    return F.parse_json(body)


def json_value_or_null(body: Column) -> Column:
    """Body as a variant; NULL for bad JSON."""
    return F.try_parse_json(body)


def is_json_array(value: Column) -> Column:
    """True for a variant that holds a list."""
    return F.schema_of_variant(value).startswith("ARRAY")


def as_json_array(body: Column, value: Column) -> Column:
    """Text of a list: the body itself, or the single value wrapped in one."""
    return F.when(is_json_array(value), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))


def json_text(value: Column) -> Column:
    """A variant, struct, list or map written as JSON text."""
    return F.to_json(value)


def record_count(body: Column) -> Column:
    """Records in a payload: the length of a list, 1 for a single value."""
    return F.coalesce(F.json_array_length(body), F.lit(1))


def json_field(value: Column, path: str, sql_type: str, default: object = None) -> Column:
    """A field of a variant, or a default where it is absent or null."""
    field = F.try_variant_get(value, path, sql_type)
    return field if default is None else F.coalesce(field, F.lit(default))
