"""Field allow-lists.

For json every nesting level is filtered by the same list and keys come out in
list order; for csv only the top level is selected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import json_number


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def has_float(kind: T.DataType) -> bool:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return True
    if isinstance(kind, T.ArrayType):
        return has_float(kind.elementType)
    if isinstance(kind, T.MapType):
        return has_float(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(has_float(f.dataType) for f in kind)
    return False


def _ordered(names: Sequence[str], fields: Sequence[str]) -> list[str]:
    return [name for name in fields if name in names] if fields else list(names)


def json_value(value: Column, kind: T.DataType, fields: Sequence[str], mark: str | None = None) -> Column:
    """``value`` as json can show it: keys filtered, NaN and infinities as null.

    With ``mark``, other floats are their text between two of these; see ``render.to_json``.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        infinite = F.abs(value) == F.lit(float("inf"))
        shown = value if mark is None else F.concat(F.lit(mark), json_number(value), F.lit(mark))
        return F.when(~(F.isnan(value) | infinite), shown)
    if not fields and not has_float(kind):
        return value
    if isinstance(kind, T.StructType):
        kept = [
            json_value(value.getField(name), kind[name].dataType, fields, mark).alias(name)
            for name in _ordered(kind.names, fields)
        ]
        return F.when(value.isNotNull(), F.struct(*kept))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)) or has_float(kind):
            return F.transform(value, lambda item: json_value(item, kind.elementType, fields, mark))
        return value
    if isinstance(kind, T.MapType):
        if fields and isinstance(kind.keyType, T.StringType):
            keys = F.filter(
                F.array(*[F.lit(name) for name in dict.fromkeys(fields)]),
                lambda key: F.map_contains_key(value, key),
            )
            value = F.when(
                value.isNotNull(),
                F.map_from_arrays(keys, F.transform(keys, lambda key: F.element_at(value, key))),
            )
        return F.transform_values(value, lambda _, item: json_value(item, kind.valueType, fields, mark))
    if isinstance(kind, T.VariantType) and fields:
        raise TypeError("an allow-list cannot be applied inside a VARIANT; extract the fields first")
    return value


def json_columns(df: DataFrame, fields: Sequence[str] = (), mark: str | None = None) -> list[Column]:
    return [
        json_value(column(name), df.schema[name].dataType, fields, mark).alias(name)
        for name in _ordered(df.columns, dict.fromkeys(fields))
    ]


def project_fields(df: DataFrame, fields: Sequence[str], format: str = "ldjson") -> DataFrame:
    """``df`` with only ``fields``: all levels for json / ldjson, the top level for csv / tsv."""
    if not fields:
        return df
    if format in ("csv", "tsv"):
        return df.select(
            *[
                column(name) if name in df.columns else F.lit(None).cast("string").alias(name)
                for name in dict.fromkeys(fields)
            ]
        )
    return df.select(*json_columns(df, fields))
