"""Records to text, one row per line.  All of it is column expressions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.project import column, has_float, json_columns, project_fields
from millrace.functions.text import plain_number, quoted

# ISO 8601 with all six digits that a timestamp has.
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_ZONED_TIME = _TIME + "XXX"
_JSON_TIMES = {"timestampFormat": _ZONED_TIME, "timestampNTZFormat": _TIME}

_BARE = (T.IntegralType, T.DecimalType, T.BooleanType)


def _between_quotes(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _listed(fields: tuple[str, ...]):
    """A function that keeps, at every depth of a json text, the named keys, in their order.

    The shape of a VARIANT record is known record by record only, so each is taken apart by itself.
    """

    def kept(value):
        if isinstance(value, dict):
            return {name: kept(value[name]) for name in fields if name in value}
        if isinstance(value, list):
            return [kept(item) for item in value]
        return int(value) if isinstance(value, float) and value.is_integer() and abs(value) < 1e21 else value

    def render(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode
        for some in texts:
            yield some.map(lambda text: None if text is None else encode(kept(json.loads(text))))

    return F.pandas_udf(render, "string")


def new_mark() -> str:
    """Text that no record holds: it is drawn anew for each rendering."""
    return f"<{uuid.uuid4().hex}>"


def to_json(value: Column, options: dict[str, str], mark: str | None) -> Column:
    """``value`` as json, where marked texts are numbers: the quotes around them go with the marks.

    So a float is written as the shortest text that reads back, ``42`` and not ``42.0``, at every depth.
    Rendering a record of many floats takes two to three times as long.
    """
    text = F.to_json(value, options)
    if mark is None:
        return text
    for gone in (f'"{mark}', f'.0{mark}"', f'{mark}"'):
        text = F.replace(text, F.lit(gone), F.lit(""))
    return text


def csv_cell(value: Column, kind: T.DataType) -> Column:
    """One cell: text quoted, numbers and booleans bare, nested values as quoted json."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return quoted(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return plain_number(value)
    if isinstance(kind, _BARE):
        return value.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        shape = _ZONED_TIME if isinstance(kind, T.TimestampType) else _TIME
        return _between_quotes(F.date_format(value, shape))
    if isinstance(kind, T.BinaryType):
        return _between_quotes(F.base64(value))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return quoted(F.to_json(value, _JSON_TIMES))
    if isinstance(kind, T.VariantType):
        # each row has a kind of its own, and the first character of its json shows which
        text = F.to_json(value)
        return (
            F.when(text.startswith('"'), quoted(F.variant_get(value, "$", "string")))
            .when(text.startswith("{") | text.startswith("["), quoted(text))
            .when(text != "null", text)
        )
    return quoted(value.cast("string"))


def header_line(names: Sequence[str], separator: str) -> str:
    return separator.join('"' + name.replace('"', '""') + '"' for name in names)


def whole_record(df: DataFrame) -> str | None:
    """The only column, when it is a VARIANT: then it holds the record itself."""
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType):
        return df.columns[0]
    return None


def _extra(df: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [column(name) for name in keep]


def _records(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return df.drop(*keep) if keep else df


def json_text(df: DataFrame, fields: Sequence[str] = (), keep_nulls: bool = False, plain_numbers: bool = False) -> Column:
    """The record as json.  A VARIANT record keeps its nulls, which differ from missing keys.

    With ``plain_numbers`` floats of columns, at any depth, are shortest text; those inside a VARIANT are not.
    """
    record = whole_record(df)
    if record is not None:
        if set(fields) == {record}:
            raise TypeError(f"{record!r} is the record itself: an allow-list names the keys in it")
        text = F.to_json(column(record))
        return _listed(tuple(dict.fromkeys(fields)))(text) if fields else text
    mark = new_mark() if plain_numbers and has_float(df.schema) else None
    options = {**_JSON_TIMES, "ignoreNullFields": str(not keep_nulls).lower()}
    return to_json(F.struct(*json_columns(df, fields, mark)), options, mark)


def render_ldjson(
    df: DataFrame,
    fields: Sequence[str] = (),
    keep_nulls: bool = False,
    keep: Sequence[str] = (),
    plain_numbers: bool = False,
) -> DataFrame:
    """One json object per record in column ``value``; ``keep`` columns ride along."""
    text = json_text(_records(df, keep), fields, keep_nulls, plain_numbers)
    return df.select(text.alias("value"), *_extra(df, keep))


def render_csv(
    df: DataFrame,
    fields: Sequence[str] = (),
    separator: str = ",",
    forbid: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One csv line per record.  A record without any value has no line.

    ``forbid`` names a line delimiter that must not appear inside a line.
    """
    record = whole_record(_records(df, keep))
    if record is not None:
        if not fields:
            raise ValueError("csv output of VARIANT records needs fields")
        taken = [
            F.variant_get(column(record), "$['" + name.replace("'", "\\'") + "']", "variant").alias(name)
            for name in dict.fromkeys(fields)
        ]
        df = df.select(*taken, *_extra(df, keep))
    shown = project_fields(_records(df, keep), fields, "csv")
    if not shown.columns:
        return df.select(F.lit("").alias("value"), *_extra(df, keep)).where(F.lit(False))
    present = [name for name in shown.columns if name in df.columns]
    if not present:
        return df.select(F.lit("").alias("value"), *_extra(df, keep)).where(F.lit(False))
    cells = [
        F.coalesce(csv_cell(column(name), shown.schema[name].dataType), F.lit(""))
        if name in present
        else F.lit("")
        for name in shown.columns
    ]
    some_value = F.lit(False)
    for name in present:
        some_value = some_value | column(name).isNotNull()
    line = F.concat_ws(separator, *cells)
    if forbid is not None:
        complaint = F.raise_error(F.concat(F.lit("line delimiter inside a csv cell: "), line))
        line = F.when(line.contains(forbid), complaint.cast("string")).otherwise(line)
    return df.where(some_value).select(line.alias("value"), *_extra(df, keep))


def render_tsv(df: DataFrame, fields: Sequence[str] = (), separator: str = "\t", **more) -> DataFrame:
    return render_csv(df, fields, separator, **more)


def render_raw(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ``data`` column as it is; nothing at all becomes an empty line."""
    if "data" not in df.columns:
        raise ValueError("raw output needs a column named data")
    return df.select(F.coalesce(F.col("data").cast("string"), F.lit("")).alias("value"), *_extra(df, keep))
