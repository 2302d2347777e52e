"""The four operations, driven by a settings dictionary.

``file_reader`` and ``s3_reader`` give a frame, ``file_exporter`` and ``s3_exporter`` write
one and hand it on.  ``routed_sender`` is the export that follows the route of a record.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.paths import object_uri
from millrace.operators.export import send
from millrace.options import ReadOptions, WriteOptions
from millrace.sources.check import check_source
from millrace.sources.readers import read

Config = Mapping[str, Any]


def file_reader(spark: SparkSession, config: Config, schema: Any = None, **more: Any) -> Any:
    """Read a directory; it has to exist, hold something, and be no symbolic link."""
    options = ReadOptions.from_config(config)
    for path in [options.path] if isinstance(options.path, str) else options.path:
        check_source(spark, path)
    return read(spark, options, schema, **more)


def s3_reader(
    spark: SparkSession, config: Config, schema: Any = None, scheme: str = "s3a", **more: Any
) -> Any:
    """Read ``bucket/prefix`` of an object store; connection settings are ``fs.s3a.*``."""
    options = ReadOptions.from_config(config)
    paths = [options.path] if isinstance(options.path, str) else options.path
    uris = [object_uri(path, scheme) for path in paths]
    return read(spark, replace(options, path=uris), schema, **more)


def file_exporter(df: DataFrame, config: Config) -> DataFrame:
    """Write every record below the path; routes are not followed."""
    send(df, replace(WriteOptions.from_config(config), dynamic_routing=False))
    return df


def _object_options(config: Config, scheme: str) -> WriteOptions:
    uri = object_uri(config.get("path") or "", scheme)
    return WriteOptions.from_config({**config, "path": uri}, file_per_slice=True)


def s3_exporter(df: DataFrame, config: Config, scheme: str = "s3a") -> DataFrame:
    """Write to ``bucket/prefix``; each batch makes its own objects."""
    send(df, replace(_object_options(config, scheme), dynamic_routing=False))
    return df


def routed_sender(df: DataFrame, config: Config, scheme: str | None = None) -> int:
    """Write with the routing that ``config`` asks for; returns the number of records."""
    options = WriteOptions.from_config(config) if scheme is None else _object_options(config, scheme)
    return send(df, options)
