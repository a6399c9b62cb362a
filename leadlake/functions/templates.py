"""Text templates over lead columns.

A field that the table lacks takes the default of the template; a null in an existing column prints "None".
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(columns: Collection[str], name: str, default: str) -> Column:
    if name not in columns:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def list_field(columns: Collection[str], name: str) -> Column:
    return F.coalesce(F.to_json(name), F.lit("[]")) if name in columns else F.lit("[]")


def lines(columns: Collection[str], head: str, fields: dict[str, tuple[str, str | None]], tail: str) -> Column:
    """``head``, one "Label: value" line per field and ``tail``; a default of None marks a list field."""
    parts: list[Column] = [F.lit(head)]
    for label, (name, default) in fields.items():
        value = list_field(columns, name) if default is None else field(columns, name, default)
        parts.append(F.concat(F.lit(f"{label}: "), value))
    return F.concat_ws("\n", *parts, F.lit(tail))


def lookup(table: dict[str, str], key: Column, default: str) -> Column:
    """Value of a small literal map, or the default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))
