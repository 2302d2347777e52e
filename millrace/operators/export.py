"""Sinks: a frame to named files of one format."""

from __future__ import annotations

import posixpath
import uuid
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.functions.project import column
from millrace.functions.render import (
    header_line,
    json_text,
    render_csv,
    render_ldjson,
    render_raw,
)
from millrace.options import OptionError, WriteOptions
from millrace.plans.commit import (
    drop_empty_first_part,
    earlier_files,
    publish,
    publish_direct,
    remove_earlier,
    staging_folder,
)
from millrace.plans.direct import Target, write_direct
from millrace.plans.naming import suffix
from millrace.plans.packing import LZ4_END_MARK, pack_files, with_header
from millrace.session import Files, small_methods
from millrace.sources.files import opened


def render(df: DataFrame, options: WriteOptions) -> DataFrame:
    """``value`` per record (and the route column, when routing is on)."""
    routed = options.dynamic_routing
    if not routed and options.route_col in df.columns:
        df = df.drop(column(options.route_col))
    keep = [options.route_col] if routed else []
    if options.format in ("csv", "tsv"):
        forbid = options.line_delimiter if options.line_breaks == "throw" else None
        return render_csv(df, options.fields, options.separator, forbid=forbid, keep=keep)
    if options.format == "raw":
        return render_raw(df, keep=keep)
    return render_ldjson(df, options.fields, options.keep_nulls, keep, options.plain_numbers)


def render_json(
    df: DataFrame,
    fields: Any = (),
    records_per_file: int | None = None,
    keep_nulls: bool = False,
    bytes_per_file: int = 64 * 1024 * 1024,
    plain_numbers: bool = False,
) -> DataFrame:
    """One row per output file: a json array of up to ``records_per_file`` records."""
    lines = df.select(json_text(df, fields, keep_nulls, plain_numbers).alias("value"))
    return pack_files(
        lines,
        array=True,
        lz4=False,
        line_delimiter="\n",
        records_per_file=records_per_file,
        bytes_per_file=bytes_per_file,
    )


def _arranged(df: DataFrame, options: WriteOptions) -> DataFrame:
    """The partitions that become files.

    Routes are rebalanced: rows of a route meet in few tasks, and adaptive execution cuts a
    route that is too large for one task, so neither many routes nor one hot route hurt.
    """
    if options.dynamic_routing:
        route = column(options.route_col)
        df = df.withColumn(options.route_col, F.nullif(route.cast("string"), F.lit("")))
        if not options.gather_routes:
            return df.repartition(options.files) if options.files else df
        count = [options.files] if options.files else []
        return df.hint("rebalance", *count, options.route_col)
    if options.files:
        return df.repartition(options.files)
    return df


def _body_rows(df: DataFrame, options: WriteOptions) -> tuple[DataFrame, dict[str, str]]:
    """Rows as the text writer should write them, and the writer options they need."""
    lines = render(df, options)
    route = options.route_col if options.dynamic_routing else None
    names = list(dict.fromkeys(options.fields)) or [
        name for name in df.columns if name != options.route_col
    ]
    header = None
    if options.include_header and options.format in ("csv", "tsv"):
        header = header_line(names, options.separator)
    array, lz4 = options.format == "json", options.compression == "lz4"
    writer = {"lineSep": options.line_delimiter}
    if options.compression == "gzip":
        writer["compression"] = "gzip"

    headed_routes = route is not None and header is not None
    if route and (array or lz4 or headed_routes):
        lines = lines.sortWithinPartitions(column(route))
    # a routed csv with header is packed as well: the writer sorts rows by route once more, and only
    # in a row that is a whole file the header surely stays in front
    if array or lz4 or headed_routes:
        packed = pack_files(
            lines,
            array=array,
            lz4=lz4,
            line_delimiter=options.line_delimiter,
            header=header,
            route=route,
            records_per_file=options.records_per_file,
            bytes_per_file=options.bytes_per_file,
        )
        writer["maxRecordsPerFile"] = "1"
        if lz4:
            writer["lineSep"] = LZ4_END_MARK
        return packed, writer
    if options.records_per_file:
        writer["maxRecordsPerFile"] = str(options.records_per_file)
    if header is not None:
        lines = lines.select(with_header(header, options.line_delimiter, options.records_per_file).alias("value"))
    return lines, writer


def _direct_rows(df: DataFrame, options: WriteOptions) -> tuple[DataFrame, str | None]:
    """Lines (and their route, sorted by it) for files that tasks name themselves, and the header of each."""
    lines = render(df, options)
    header = None
    if options.include_header and options.format in ("csv", "tsv"):
        names = list(dict.fromkeys(options.fields)) or [name for name in df.columns if name != options.route_col]
        header = header_line(names, options.separator)
    if options.dynamic_routing:
        route = column(options.route_col)
        return lines.select("value", route.alias("route")).sortWithinPartitions("route"), header
    return lines.select("value"), header


# Settings of a connection that only Hadoop knows.
_HADOOP_ONLY = ("fs.s3a.access.key", "fs.s3a.endpoint")


def _opens(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files there themselves, with the connection that Spark would use."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if path.startswith("s3") and any(conf.getRaw(key) for key in _HADOOP_ONLY):
        return False
    try:
        opened(path)
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def _send_direct(df: DataFrame, options: WriteOptions, batch: int | None, run: str) -> int:
    spark = df.sparkSession
    rows, header = _direct_rows(_arranged(df, options), options)
    root = Files(spark, options.path).qualified(options.path)
    hive = options.dynamic_routing and options.layout_mode == "hive"
    bounded = options.format == "json" or options.compression == "lz4" or (options.dynamic_routing and header is not None)

    def write(offset: int, low: int, manifest: str) -> None:
        target = Target(
            path=root,
            id=options.id,
            ending=suffix(options.format, options.compression, options.extension),
            compression=options.compression,
            delimiter=options.line_delimiter,
            array=options.format == "json",
            header=header,
            routed=options.dynamic_routing,
            route_prefix=f"{options.route_col}=" if hive else "",
            records_per_file=options.records_per_file,
            bytes_per_file=options.bytes_per_file if bounded else None,
            offset=offset,
            low=low,
            manifest=manifest,
        )
        with small_methods(spark):
            write_direct(rows, target)

    return publish_direct(spark, options, batch, run, write)


def send(df: DataFrame, options: WriteOptions, *, batch: int | None = None, run: str | None = None) -> int:
    """Write every record of ``df`` and return how many there were.

    ``run`` tells the run of the job; without it, that is the application.
    """
    spark = df.sparkSession
    run = run or spark.sparkContext.applicationId
    if options.naming_mode == "direct" and _opens(spark, Files(spark, options.path).qualified(options.path)):
        return _send_direct(df, options, batch, run)
    counts = Observation()
    # counted in the stage that writes: a repeated task of that stage is not counted twice
    counted = _arranged(df, options).observe(counts, F.count(F.lit(1)).alias("records"))
    rows, writer_options = _body_rows(counted, options)
    writer = rows.write.options(**writer_options)
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if options.dynamic_routing:
        writer = writer.partitionBy(options.route_col)

    if options.naming_mode == "exact":
        staging = staging_folder(options)
        try:
            with small_methods(spark):
                writer.text(staging)
            publish(spark, staging, options, batch, run)
        finally:
            Files(spark, options.path).remove(staging)
    else:
        if options.layout == "plain" and options.dynamic_routing:
            raise OptionError("on a store that only Hadoop can open, layout 'plain' needs naming 'exact'")
        # a stream batch owns a folder, so that a second try replaces the first
        folder = options.path if batch is None else posixpath.join(options.path, f"batch={batch}")
        mode = "append" if batch is None else "overwrite"
        before = earlier_files(Files(spark, folder), options) if options.replace and batch is None else []
        with small_methods(spark):
            writer.mode(mode).option("mapreduce.output.basename", options.id).text(folder)
        if not options.dynamic_routing:
            drop_empty_first_part(spark, options, folder, set(before))
        remove_earlier(spark, options, before)
    return counts.get["records"]


class Sender:
    """One run of an export job: every ``send`` is its next slice.

    A new sender with the same settings is a new run: its first slice replaces what the last run has written,
    also if that run died half way.
    """

    def __init__(self, options: WriteOptions):
        self.options = options
        self.run = uuid.uuid4().hex

    def send(self, df: DataFrame) -> int:
        return send(df, self.options, run=self.run)


def _options(path: str, format: str, settings: dict[str, Any]) -> WriteOptions:
    return WriteOptions(path=path, format=format, **settings)


def export(df: DataFrame, path: str, format: str, **settings: Any) -> DataFrame:
    """Write ``df`` below ``path`` and hand it on.  Records are never routed here.

    See ``WriteOptions`` for the settings.
    """
    send(df, _options(path, format, {**settings, "dynamic_routing": False}))
    return df


def export_routed(df: DataFrame, path: str, format: str, route_col: str, **settings: Any) -> DataFrame:
    """Write each record below ``path/<route>``; a null or empty route means ``path`` itself."""
    send(df, _options(path, format, {**settings, "route_col": route_col, "dynamic_routing": True}))
    return df
