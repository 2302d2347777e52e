"""Readers for the five formats."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.functions.project import column
from millrace.options import OptionError, ReadOptions
from millrace.session import adopt, sized_session
from millrace.sources.check import refuse_streamed, stream_roots, streamed_roots
from millrace.sources.lines import read_lines, source_struct
from millrace.sources.parse import csv_reason, json_reason, parse_csv_lines, parse_json_documents, parse_json_lines
from millrace.sources.policy import apply_policy, mark_rejects, record_columns, source_name, split_rejects

Schema = T.StructType | str | None


def infer_schema(lines: DataFrame, sampling_ratio: float = 1.0) -> T.StructType:
    """The record type of json text in ``value``.

    This is a pass over the data of its own: give a schema, or read as ``"variant"``,
    when the input is large.
    """
    spark = lines.sparkSession
    text = getattr(lines.select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read().option("samplingRatio", str(sampling_ratio))
    return T.StructType.fromJson(json.loads(reader.json(text).schema().json()))


def _native_json(
    spark: SparkSession, options: ReadOptions, schema: T.StructType | str, source: str | None
) -> DataFrame:
    """Spark's json scan: byte parser, pruned columns, fails on the first broken record.

    It is lenient about text after the first object of a line and about blank lines.
    """
    refuse_streamed(spark, options)
    session = spark if options.size is None else sized_session(spark, options.size)
    reader = session.read.schema(schema).options(
        mode="FAILFAST",
        recursiveFileLookup=True,
        allowSingleQuotes=False,
        allowNonNumericNumbers=False,
    )
    if options.format == "json":
        reader = reader.option("multiLine", True)
    else:
        reader = reader.option("lineSep", options.line_delimiter)
    path = options.path if isinstance(options.path, str) else list(options.path)
    df = reader.json(path)
    if source:
        df = df.select("*", source_struct().alias(source))
    return df if session is spark else adopt(spark, df)


def parsed_lines(
    spark: SparkSession,
    options: ReadOptions,
    schema: Schema = None,
    *,
    streaming: bool = False,
    limits: dict | None = None,
    sampling_ratio: float = 1.0,
    source: bool = True,
    exact_text: bool = True,
    log: str | None = None,
) -> DataFrame:
    """``value, source, record, ok`` for every record below the path."""
    if streaming:
        streamed = stream_roots(spark, options, log)
    else:
        streamed = streamed_roots(spark, options)
    lines = read_lines(
        spark,
        options.path,
        compression=options.compression,
        line_delimiter=options.line_delimiter,
        size=None if options.file_per_slice and options.compression != "none" else options.size,
        whole=options.format == "json",
        source=source,
        streaming=streaming,
        limits=limits,
        streamed=streamed,
        log=log,
    )
    if options.format == "raw":
        return lines.select(
            "value", "source", F.struct(F.col("value").alias("data")).alias("record"), F.lit(True).alias("ok")
        )
    if options.format in ("csv", "tsv"):
        extra = dict(options.extra_args)
        return parse_csv_lines(
            lines,
            # other parsers' names for settings of ours; given here they win
            extra.pop("headers", options.fields),
            options.separator,
            remove_header=options.remove_header,
            ignore_empty=extra.pop("ignoreEmpty", options.ignore_empty),
            check_width=extra.pop("checkColumn", options.check_width),
            surplus=options.surplus,
            extra_args=extra,
            strict=options.strict,
        )
    if schema is None:
        if streaming:
            raise OptionError("a stream needs a schema (or 'variant')")
        schema = infer_schema(lines, sampling_ratio)
    schema = _named(schema, options.fields)
    if options.format == "json":
        return parse_json_documents(lines, schema)
    return parse_json_lines(lines, schema, exact_text)


def _named(schema: T.StructType | str, fields: Sequence[str]) -> T.StructType | str:
    """The part of a json schema that is asked for; of all other fields only the syntax is checked."""
    if schema == "variant" or not fields:
        return schema
    full = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    kept = [full[name] for name in dict.fromkeys(fields) if name in full.names]
    return T.StructType(kept) if kept else full


def read(
    spark: SparkSession,
    options: ReadOptions,
    schema: Schema = None,
    *,
    with_source: bool | str = False,
    rejects: bool | str = False,
    observation: Observation | None = None,
    sampling_ratio: float = 1.0,
) -> Any:
    """Records below ``options.path`` as a frame.

    ``rejects=True`` gives ``(good, bad)`` instead, ``rejects="column"`` one frame with a
    ``rejected`` column; both replace ``on_reject``.  With ``rejects="reasons"`` the bad
    records also have the ``reason``: the first rule that they break.  ``observation`` receives the counts
    ``read`` and ``rejected`` when ``on_reject`` is ``log``.
    """
    source = source_name(with_source)
    if options.format in ("json", "ldjson") and not options.strict:
        if options.compression != "none" or options.on_reject != "throw" or rejects:
            raise OptionError("strict=False works with compression 'none' and on_reject 'throw' only")
        if schema is None or schema == "variant":
            raise OptionError("strict=False needs a schema")
        return _select(_native_json(spark, options, schema, source), options, source)
    reasons = rejects == "reasons"
    needed = source is not None or rejects is True or reasons
    parsed = parsed_lines(spark, options, schema, sampling_ratio=sampling_ratio, source=needed, exact_text=bool(rejects))
    if rejects == "column":
        return mark_rejects(parsed, source)
    if rejects:
        good, bad = split_rejects(parsed, source, _reason(options) if reasons else None)
        return _select(good, options, source), bad
    path = options.path if isinstance(options.path, str) else ", ".join(options.path)
    if options.format == "raw":
        return parsed.select(*record_columns(parsed, source))
    kept = apply_policy(parsed, options.on_reject, path, source, observation)
    return _select(kept, options, source)


def _reason(options: ReadOptions) -> Column:
    text = F.col("value")
    if options.format in ("json", "ldjson"):
        return json_reason(text)
    return csv_reason(text, options.fields, options.separator, options.extra_args)


def _select(df: DataFrame, options: ReadOptions, source: str | None) -> DataFrame:
    """json readers may name the top-level fields they want; others are not parsed, and not scanned with ``strict=False``."""
    if options.format not in ("json", "ldjson") or not options.fields:
        return df
    names = [name for name in dict.fromkeys(options.fields) if name in df.columns]
    return df.select(*[column(name) for name in names], *([column(source)] if source else []))


def read_ldjson(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: Schema = None,
    line_delimiter: str = "\n",
    fields: Sequence[str] | None = None,
    *,
    with_source: bool | str = False,
    rejects: bool | str = False,
    observation: Observation | None = None,
    **more: Any,
) -> Any:
    """Line-delimited json objects."""
    options = ReadOptions(path, "ldjson", line_delimiter=line_delimiter, fields=fields or (), **more)
    return read(spark, options, schema, with_source=with_source, rejects=rejects, observation=observation)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: Schema = None,
    fields: Sequence[str] | None = None,
    *,
    with_source: bool | str = False,
    rejects: bool | str = False,
    observation: Observation | None = None,
    **more: Any,
) -> Any:
    """Files that are one json object or one array of objects; a file is never divided."""
    options = ReadOptions(path, "json", fields=fields or (), **more)
    return read(spark, options, schema, with_source=with_source, rejects=rejects, observation=observation)


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    line_delimiter: str = "\n",
    *,
    with_source: bool | str = False,
    **more: Any,
) -> DataFrame:
    """Lines as they are, blank ones too, in column ``data``."""
    options = ReadOptions(path, "raw", line_delimiter=line_delimiter, **more)
    return read(spark, options, with_source=with_source)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str],
    field_delimiter: str = ",",
    line_delimiter: str = "\n",
    remove_header: bool = True,
    ignore_empty: bool = True,
    extra_args: Mapping[str, Any] | None = None,
    *,
    with_source: bool | str = False,
    rejects: bool | str = False,
    observation: Observation | None = None,
    **more: Any,
) -> Any:
    """Delimited lines as trimmed strings, in the order of ``fields``."""
    options = ReadOptions(
        path,
        "csv",
        fields=fields,
        field_delimiter=field_delimiter,
        line_delimiter=line_delimiter,
        remove_header=remove_header,
        ignore_empty=ignore_empty,
        extra_args=extra_args or {},
        **more,
    )
    return read(spark, options, with_source=with_source, rejects=rejects, observation=observation)


def read_tsv(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str],
    field_delimiter: str | None = None,
    line_delimiter: str = "\n",
    remove_header: bool = True,
    ignore_empty: bool = True,
    extra_args: Mapping[str, Any] | None = None,
    *,
    with_source: bool | str = False,
    rejects: bool | str = False,
    observation: Observation | None = None,
    **more: Any,
) -> Any:
    """``read_csv`` with a tab; another delimiter is an error."""
    options = ReadOptions(
        path,
        "tsv",
        fields=fields,
        field_delimiter=field_delimiter,
        line_delimiter=line_delimiter,
        remove_header=remove_header,
        ignore_empty=ignore_empty,
        extra_args=extra_args or {},
        **more,
    )
    return read(spark, options, with_source=with_source, rejects=rejects, observation=observation)
