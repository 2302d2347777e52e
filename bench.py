"""Export and read-back times of every format and codec over the largest table.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
Reads end in Spark's ``noop`` sink, so that every column of every record is produced.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

import millrace as m  # noqa: E402
from millrace.session import Files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("millrace-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    root = m.scratch_folder(spark, "bench")
    # as many partitions as cores, so that one parquet row group does not decide the result
    staged = f"{root}/lineitem"
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(int(CPUS)).write.parquet(staged)
    lineitem = spark.read.parquet(staged)
    rows = lineitem.count()
    schema, fields = lineitem.schema, lineitem.columns
    # a stored text column, so that the raw sink is measured and not the rendering
    m.render_ldjson(lineitem).withColumnRenamed("value", "data").write.parquet(f"{root}/text")
    raw = spark.read.parquet(f"{root}/text")
    seconds: dict[str, float] = {}
    written: dict[str, int] = {}

    def timed(name: str, action) -> None:
        best = None
        for run in range(RUNS):
            started = time.perf_counter()
            action(run)
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)

    def both(name: str, df: DataFrame, format: str, read, **settings) -> None:
        folders = [f"{root}/{name}-{run}" for run in range(RUNS)]
        timed(f"export_{name}", lambda run: m.export(df, folders[run], format, **settings))
        written[name] = sum(length for _, length in Files(spark, root).walk(folders[0]))
        timed(f"read_{name}", lambda run: drain(read(folders[0])))

    both("ldjson", lineitem, "ldjson", lambda p: m.read_ldjson(spark, p, schema))
    timed("read_ldjson_native", lambda run: drain(m.read_ldjson(spark, f"{root}/ldjson-0", schema, strict=False)))
    both("json", lineitem, "json", lambda p: m.read_json(spark, p, schema), records_per_file=50_000)
    both("raw", raw, "raw", lambda p: m.read_raw(spark, p))
    both("csv", lineitem, "csv", lambda p: m.read_csv(spark, p, fields), include_header=True)
    both("tsv", lineitem, "tsv", lambda p: m.read_tsv(spark, p, fields))
    for codec in ("gzip", "lz4"):
        both(
            f"ldjson_{codec}",
            lineitem,
            "ldjson",
            lambda p, codec=codec: m.read_ldjson(spark, p, schema, compression=codec),
            compression=codec,
        )
    timed(
        "export_routed",
        lambda run: m.export_routed(lineitem, f"{root}/routed-{run}", "ldjson", "l_returnflag"),
    )
    timed("project_fields", lambda run: drain(m.render_ldjson(lineitem, ["l_orderkey", "l_shipdate"])))

    def stream(run: int) -> None:
        options = m.ReadOptions(path=f"{root}/ldjson-0", format="ldjson")
        sink = m.WriteOptions(f"{root}/stream-{run}", "ldjson")
        m.export_stream(m.read_stream(spark, options, schema), sink, f"{root}/marks-{run}").awaitTermination()

    timed("stream_copy", stream)
    result = {
        "metric": "export and read-back of lineitem, all formats",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "rows": rows,
        "bytes": written,
        "cores": int(CPUS),
        "spark": spark.version,
    }
    Files(spark, root).remove(root)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
