"""Whole-table runs of every operator, with the SQL that describes their result.

Each run writes to a fresh folder below ``spark.checkpoint.dir``, reads back, and returns
a frame.  ``WORKLOADS`` maps a name to ``(run, sql)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millrace.functions import (
    is_readable_path,
    is_valid_bucket_name,
    parse_object_path,
    render_csv,
    render_ldjson,
)
from millrace.operators import (
    Sender,
    counted,
    export,
    export_routed,
    file_exporter,
    file_reader,
    inventory_summary,
    render_json,
    routed_sender,
    send,
)
from millrace.options import ReadOptions, WriteOptions
from millrace.session import scratch_folder
from millrace.sources import (
    file_inventory,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    read_tsv,
)
from millrace.streaming import export_stream, read_stream

Run = Callable[[SparkSession, str], DataFrame]
WORKLOADS: dict[str, tuple[Run, str]] = {}


def workload(sql: str) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        WORKLOADS[run.__name__] = (run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER_TYPE = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"

EVENT_TYPE = "event_id bigint, user_id bigint, event_type string, props string"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "props"]
EVENT_SQL = "SELECT event_id, user_id, event_type, props FROM events"
FULL_EVENT_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(ORDER_COLUMNS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(EVENT_COLUMNS)


def folder_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


# --- line-delimited json ---------------------------------------------------------------


@workload(ORDER_SQL)
def ldjson_roundtrip_orders(spark, sf_dir):
    out = scratch_folder(spark, "ldjson")
    export(orders(spark, sf_dir), out, "ldjson")
    return read_ldjson(spark, out, ORDER_TYPE)


@workload(ORDER_SQL)
def ldjson_native_scan_orders(spark, sf_dir):
    """The same files through Spark's own json scan."""
    out = scratch_folder(spark, "ldjson")
    export(orders(spark, sf_dir), out, "ldjson")
    return read_ldjson(spark, out, ORDER_TYPE, strict=False)


@workload(
    """SELECT l_orderkey, l_linenumber, l_returnflag,
              CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
              strftime(l_shipdate, '%Y-%m-%d') AS shipped
       FROM lineitem"""
)
def ldjson_roundtrip_lineitem(spark, sf_dir):
    out = scratch_folder(spark, "ldjson")
    df = table(spark, sf_dir, "lineitem")
    export(df, out, "ldjson")
    back = read_ldjson(spark, out, df.schema)
    return back.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )


@workload(
    """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus
              || '","o_orderpriority":"' || o_orderpriority || '"}' AS value
       FROM orders"""
)
def ldjson_render_orders(spark, sf_dir):
    fields = ["o_orderkey", "o_orderstatus", "o_orderpriority", "absent"]
    return render_ldjson(orders(spark, sf_dir), fields)


@workload(
    """SELECT '{"o_orderkey":' || o_orderkey || ',"status":'
              || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '"' || o_orderstatus || '"' END
              || '}' AS value
       FROM orders"""
)
def ldjson_keep_nulls_orders(spark, sf_dir):
    df = orders(spark, sf_dir).select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status")
    )
    return render_ldjson(df, keep_nulls=True)


@workload("SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def ldjson_inferred_part(spark, sf_dir):
    out = scratch_folder(spark, "ldjson")
    export(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), out, "ldjson")
    return read_ldjson(spark, out).select("p_partkey", "p_name", "p_size")


@workload("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events")
def ldjson_timestamps_events(spark, sf_dir):
    """Times keep their microseconds."""
    out = scratch_folder(spark, "ldjson")
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    export(df, out, "ldjson")
    back = read_ldjson(spark, out, df.schema)
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@workload("SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM events")
def csv_timestamps_events(spark, sf_dir):
    out = scratch_folder(spark, "csv")
    df = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    export(df, out, "csv")
    return read_csv(spark, out, ["event_id", "ts"])


@workload(
    """SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
       FROM events"""
)
def ldjson_variant_events(spark, sf_dir):
    """Records without a declared type, read as VARIANT."""
    out = scratch_folder(spark, "ldjson")
    lines = table(spark, sf_dir, "events").select(
        F.format_string('{"id":%d,"props":%s}', "event_id", "props").alias("data")
    )
    export(lines, out, "raw")
    record = read_ldjson(spark, out, "variant").select("record")
    return record.select(
        F.variant_get("record", "$.id", "bigint").alias("event_id"),
        F.variant_get("record", "$.props.k", "bigint").alias("k"),
    )


@workload(EVENT_SQL)
def variant_copy_events(spark, sf_dir):
    """A copy job that never learns the shape of its records."""
    first, second = scratch_folder(spark, "variant"), scratch_folder(spark, "variant")
    export(events(spark, sf_dir), first, "ldjson")
    export(read_ldjson(spark, first, "variant"), second, "json", compression="gzip")
    return read_json(spark, second, EVENT_TYPE, compression="gzip")


@workload(
    """SELECT event_id || ',"' || event_type || '","' || replace(props, '"', '""') || '"' AS value
       FROM events"""
)
def variant_csv_events(spark, sf_dir):
    out = scratch_folder(spark, "variant")
    export(events(spark, sf_dir), out, "ldjson")
    records = read_ldjson(spark, out, "variant")
    return render_csv(records, ["event_id", "event_type", "props"])


@workload("SELECT conv_id, turn, role, text FROM conversations")
def ldjson_delimiter_conversations(spark, sf_dir):
    """Texts with line breaks under a delimiter of three characters."""
    out = scratch_folder(spark, "ldjson")
    export(table(spark, sf_dir, "conversations"), out, "ldjson", line_delimiter="\r\n\f")
    schema = "conv_id bigint, turn bigint, role string, text string"
    return read_ldjson(spark, out, schema, "\r\n\f").select("conv_id", "turn", "role", "text")


def _shortest(column: str) -> str:
    return f"regexp_replace(CAST({column} AS VARCHAR), '\\.0$', '')"


@workload(
    f"""SELECT '{{"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey
              || ',"l_linenumber":' || l_linenumber || ',"l_quantity":' || {_shortest("l_quantity")}
              || ',"l_extendedprice":' || {_shortest("l_extendedprice")} || ',"l_discount":' || {_shortest("l_discount")}
              || ',"l_tax":' || {_shortest("l_tax")} || ',"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus
              || '","l_shipdate":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '"}}' AS data
       FROM lineitem"""
)
def ldjson_numbers_lineitem(spark, sf_dir):
    """All columns as text: numbers without a superfluous point or exponent, read back as raw lines."""
    out = scratch_folder(spark, "numbers")
    df = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    export(df, out, "ldjson", plain_numbers=True)
    return read_raw(spark, out)


# --- json files ------------------------------------------------------------------------


@workload("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_roundtrip_nation(spark, sf_dir):
    out = scratch_folder(spark, "json")
    export(table(spark, sf_dir, "nation"), out, "json")
    return read_json(spark, out, "n_nationkey int, n_name string, n_regionkey int")


@workload("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def json_roundtrip_customer(spark, sf_dir):
    out = scratch_folder(spark, "json")
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    export(df, out, "json", records_per_file=5000)
    return read_json(spark, out, df.schema)


@workload("SELECT doc_id, text, lang FROM documents")
def json_roundtrip_documents(spark, sf_dir):
    """Spark's own multi-line scan reads the arrays."""
    out = scratch_folder(spark, "json")
    df = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    export(df, out, "json", bytes_per_file=8 * 1024 * 1024)
    return read_json(spark, out, df.schema, strict=False)


@workload("SELECT o_orderkey, o_orderstatus FROM orders")
def json_render_orders(spark, sf_dir):
    arrays = render_json(orders(spark, sf_dir), ["o_orderkey", "o_orderstatus"], records_per_file=1000)
    records = F.from_json("value", "array<struct<o_orderkey:bigint,o_orderstatus:string>>")
    return arrays.select(F.inline(records))


@workload(
    """SELECT '{"tags":[{"o_orderpriority":"' || o_orderpriority || '"}],"o_orderkey":' || o_orderkey
              || ',"detail":{"o_custkey":' || o_custkey || '}}' AS value
       FROM orders"""
)
def json_fields_nested(spark, sf_dir):
    nested = orders(spark, sf_dir).select(
        "o_orderkey",
        F.struct("o_orderstatus", "o_custkey").alias("detail"),
        F.array(F.struct("o_orderstatus", "o_orderpriority")).alias("tags"),
    )
    fields = ["tags", "o_orderkey", "detail", "o_custkey", "o_orderpriority", "absent"]
    return render_ldjson(nested, fields)


# --- raw lines -------------------------------------------------------------------------


@workload("SELECT text AS data FROM documents")
def raw_roundtrip_documents(spark, sf_dir):
    out = scratch_folder(spark, "raw")
    df = table(spark, sf_dir, "documents").select(F.col("text").alias("data"))
    export(df, out, "raw", line_delimiter="\u0001|\n")
    return read_raw(spark, out, "\u0001|\n", size=1024 * 1024)


@workload("SELECT line AS data FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)")
def raw_lines_documents(spark, sf_dir):
    """Every line of every text, blank ones too, cut into small splits."""
    out = scratch_folder(spark, "raw")
    export(table(spark, sf_dir, "documents").select(F.col("text").alias("data")), out, "raw")
    return read_raw(spark, out, size=256 * 1024)


# --- csv and tsv -----------------------------------------------------------------------


@workload(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
              regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') AS c_acctbal, c_mktsegment
       FROM customer"""
)
def csv_roundtrip_customer(spark, sf_dir):
    out = scratch_folder(spark, "csv")
    fields = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    export(table(spark, sf_dir, "customer"), out, "csv", fields=fields, include_header=True)
    return read_csv(spark, out, fields, extra_args={"maxCharsPerColumn": -1})


@workload(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer"""
)
def csv_delimiters_customer(spark, sf_dir):
    out = scratch_folder(spark, "csv")
    fields = ["c_custkey", "c_name", "c_mktsegment"]
    df = table(spark, sf_dir, "customer")
    export(df, out, "csv", fields=fields, field_delimiter="||", line_delimiter="\r\n\f")
    return read_csv(spark, out, fields, "||", "\r\n\f")


@workload("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source FROM documents")
def csv_roundtrip_documents(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks inside their cells."""
    out = scratch_folder(spark, "csv")
    fields = ["doc_id", "text", "source"]
    export(table(spark, sf_dir, "documents"), out, "csv", fields=fields, line_delimiter="\u0001")
    return read_csv(spark, out, fields, line_delimiter="\u0001")


@workload(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size
       FROM part"""
)
def tsv_roundtrip_part(spark, sf_dir):
    out = scratch_folder(spark, "tsv")
    fields = ["p_partkey", "p_name", "p_brand", "p_size"]
    export(table(spark, sf_dir, "part"), out, "tsv", fields=fields, include_header=True)
    return read_tsv(spark, out, fields)


@workload(
    """SELECT '"' || replace(s_name, '"', '""') || '",' || s_nationkey || ','
              || regexp_replace(CAST(s_acctbal AS VARCHAR), '\\.0$', '') AS value
       FROM supplier"""
)
def csv_render_supplier(spark, sf_dir):
    return render_csv(table(spark, sf_dir, "supplier"), ["s_name", "s_nationkey", "s_acctbal"])


@workload(
    """SELECT l_orderkey || ',' || l_linenumber || ','
              || regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') || ','
              || regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') || ','
              || regexp_replace(CAST(l_discount AS VARCHAR), '\\.0$', '') || ','
              || regexp_replace(CAST(l_quantity * 1000000 AS VARCHAR), '\\.0$', '') || ',"'
              || l_returnflag || '"' AS value
       FROM lineitem"""
)
def csv_numbers_lineitem(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("big", F.col("l_quantity") * 1000000)
    fields = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "big", "l_returnflag"]
    return render_csv(df, fields)


@workload(
    """SELECT o_orderkey || ',"{""status"":""' || o_orderstatus || '"",""keys"":['
              || o_custkey || ',' || o_orderkey || ']}"' AS value
       FROM orders"""
)
def csv_nested_orders(spark, sf_dir):
    df = orders(spark, sf_dir).select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.array("o_custkey", "o_orderkey").alias("keys")).alias("d"),
    )
    return render_csv(df)


def padded_part(spark, sf_dir):
    """Cells with blanks around them, quoted and not, and empty ones."""
    size = F.when(F.col("p_size") % 5 == 0, F.lit("   ")).otherwise(F.col("p_size").cast("string"))
    line = F.concat(
        F.lit("  "), F.col("p_name"), F.lit(" , "), size, F.lit(' , "  '), F.col("p_type"), F.lit('\t"')
    )
    return table(spark, sf_dir, "part").select(line.alias("data"))


@workload(
    """SELECT p_name AS a, CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS b,
              p_type AS c
       FROM part"""
)
def csv_trim_empty_part(spark, sf_dir):
    out = scratch_folder(spark, "csv")
    export(padded_part(spark, sf_dir), out, "raw")
    return read_csv(spark, out, ["a", "b", "c"])


@workload(
    """SELECT p_name AS a, CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS b,
              p_type AS c
       FROM part"""
)
def csv_keep_empty_part(spark, sf_dir):
    out = scratch_folder(spark, "csv")
    export(padded_part(spark, sf_dir), out, "raw")
    return read_csv(spark, out, ["a", "b", "c"], ignore_empty=False)


@workload("SELECT true AS every_file_headed, count(*) AS data_lines FROM part")
def csv_headers_part(spark, sf_dir):
    """Each file of an export with headers has one; counted on the raw lines."""
    out = scratch_folder(spark, "csv")
    fields = ["p_partkey", "p_name"]
    export(table(spark, sf_dir, "part"), out, "csv", fields=fields, include_header=True, records_per_file=500)
    lines = read_raw(spark, out, with_source=True)
    head = F.col("data") == '"p_partkey","p_name"'
    per_file = lines.groupBy("source.path").agg(
        F.count_if(head).alias("heads"), F.count_if(~head).alias("data")
    )
    return per_file.agg(
        F.bool_and(F.col("heads") == 1).alias("every_file_headed"), F.sum("data").alias("data_lines")
    )


@workload(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, 'kept' AS kind FROM part
       UNION ALL SELECT 'p_partkey', 'p_name', 'header'"""
)
def csv_header_kept_part(spark, sf_dir):
    """With ``remove_header`` off the header is a record like the others."""
    out = scratch_folder(spark, "csv")
    fields = ["p_partkey", "p_name"]
    df = table(spark, sf_dir, "part")
    export(df, out, "csv", fields=fields, include_header=True)
    back = read_csv(spark, out, fields, remove_header=False)
    heads = back.where(F.col("p_partkey") == "p_partkey").distinct()
    rest = back.where(F.col("p_partkey") != "p_partkey")
    return rest.withColumn("kind", F.lit("kept")).union(heads.withColumn("kind", F.lit("header")))


# --- bad records -----------------------------------------------------------------------


def partly_broken_orders(spark, sf_dir, out):
    line = F.format_string('{"o_orderkey":%d,"o_orderstatus":"%s"}', "o_orderkey", "o_orderstatus")
    broken = F.substring(line, F.lit(1), F.length(line) - 1)
    df = orders(spark, sf_dir).select(
        F.when(F.col("o_orderkey") % 7 == 0, broken).otherwise(line).alias("data")
    )
    export(df, out, "raw")


BROKEN_TYPE = "o_orderkey bigint, o_orderstatus string"


@workload("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def reject_none(spark, sf_dir):
    out = scratch_folder(spark, "rejects")
    partly_broken_orders(spark, sf_dir, out)
    return read_ldjson(spark, out, BROKEN_TYPE, on_reject="none")


@workload(
    """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"' AS record
       FROM orders WHERE o_orderkey % 7 = 0"""
)
def reject_bad(spark, sf_dir):
    out = scratch_folder(spark, "rejects")
    partly_broken_orders(spark, sf_dir, out)
    _, bad = read_ldjson(spark, out, BROKEN_TYPE, rejects=True)
    return bad.select("record")


@workload(
    """SELECT count(*) AS read, count(*) FILTER (o_orderkey % 7 = 0) AS rejected,
              count(*) FILTER (o_orderkey % 7 <> 0) AS kept
       FROM orders"""
)
def reject_log(spark, sf_dir):
    out = scratch_folder(spark, "rejects")
    partly_broken_orders(spark, sf_dir, out)
    seen = Observation()
    kept = read_ldjson(spark, out, BROKEN_TYPE, on_reject="log", observation=seen).count()
    counts = seen.get
    return spark.range(1).select(
        F.lit(counts["read"]).cast("bigint").alias("read"),
        F.lit(counts["rejected"]).cast("bigint").alias("rejected"),
        F.lit(kept).cast("bigint").alias("kept"),
    )


@workload(
    """SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS records
       FROM orders GROUP BY 1"""
)
def reject_routed(spark, sf_dir):
    """One scan writes good and bad records to their own folders."""
    out, apart = scratch_folder(spark, "rejects"), scratch_folder(spark, "apart")
    partly_broken_orders(spark, sf_dir, out)
    marked = read_ldjson(spark, out, BROKEN_TYPE, rejects="column")
    kind = F.when(F.col("rejected").isNull(), "good").otherwise("bad")
    export_routed(marked.withColumn("kind", kind), apart, "ldjson", "kind")
    back = read_raw(spark, apart, with_source=True)
    return back.groupBy(folder_name(F.col("source.path")).alias("kind")).agg(F.count("*").alias("records"))


@workload(
    """SELECT CAST(o_orderkey AS VARCHAR) AS a, o_orderstatus AS b FROM orders WHERE o_orderkey % 7 <> 0"""
)
def reject_csv(spark, sf_dir):
    """Open quotes and wrong cell counts are refused."""
    out = scratch_folder(spark, "rejects")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = (
        F.when(F.col("o_orderkey") % 14 == 0, F.concat(key, F.lit(',"'), status))
        .when(F.col("o_orderkey") % 7 == 0, F.concat(key, F.lit(","), status, F.lit(",more")))
        .otherwise(F.concat(key, F.lit(',"'), status, F.lit('"')))
    )
    export(orders(spark, sf_dir).select(line.alias("data")), out, "raw")
    return read_csv(spark, out, ["a", "b"], on_reject="none", check_width=True)


# --- codecs ----------------------------------------------------------------------------


@workload(EVENT_SQL)
def gzip_roundtrip_events(spark, sf_dir):
    out = scratch_folder(spark, "gzip")
    export(events(spark, sf_dir), out, "ldjson", compression="gzip")
    return read_ldjson(spark, out, EVENT_TYPE, compression="gzip")


@workload(EVENT_SQL)
def gzip_any_name_events(spark, sf_dir):
    """gzip data in files whose names do not say so."""
    out = scratch_folder(spark, "gzip")
    export(events(spark, sf_dir), out, "ldjson", compression="gzip", extension="data")
    return read_ldjson(spark, out, EVENT_TYPE, compression="gzip")


@workload(EVENT_SQL)
def lz4_roundtrip_events(spark, sf_dir):
    out = scratch_folder(spark, "lz4")
    export(events(spark, sf_dir), out, "ldjson", compression="lz4")
    return read_ldjson(spark, out, EVENT_TYPE, compression="lz4")


@workload(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
              event_type, props FROM events"""
)
def lz4_csv_events(spark, sf_dir):
    out = scratch_folder(spark, "lz4")
    export(events(spark, sf_dir), out, "csv", compression="lz4", include_header=True)
    return read_csv(spark, out, EVENT_COLUMNS, compression="lz4")


@workload(ORDER_SQL)
def lz4_json_orders(spark, sf_dir):
    out = scratch_folder(spark, "lz4")
    export(orders(spark, sf_dir), out, "json", compression="lz4")
    return read_json(spark, out, ORDER_TYPE, compression="lz4")


# --- routing, appending, jobs ----------------------------------------------------------

ROUTE_SQL = "SELECT event_type AS route, count(*) AS records FROM events GROUP BY event_type"


def per_folder(lines: DataFrame) -> DataFrame:
    return lines.groupBy(folder_name(F.col("source.path")).alias("route")).agg(F.count("*").alias("records"))


@workload(ROUTE_SQL)
def routed_export_events(spark, sf_dir):
    out = scratch_folder(spark, "routed")
    export_routed(table(spark, sf_dir, "events"), out, "ldjson", "event_type")
    return per_folder(read_raw(spark, out, with_source=True))


@workload("SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def routed_hive_events(spark, sf_dir):
    """The ``name=value`` layout, which Spark prunes by folder."""
    out = scratch_folder(spark, "routed")
    export_routed(table(spark, sf_dir, "events"), out, "ldjson", "event_type", layout="hive")
    return spark.read.text(out).groupBy("event_type").agg(F.count("*").alias("records"))


@workload(ROUTE_SQL)
def routed_in_place_events(spark, sf_dir):
    """Few routes: no shuffle, each task writes its share of each route."""
    out = scratch_folder(spark, "routed")
    export_routed(table(spark, sf_dir, "events"), out, "ldjson", "event_type", gather_routes=False)
    return per_folder(read_raw(spark, out, with_source=True))


@workload(
    """SELECT event_type, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id
       FROM events"""
)
def routed_csv_events(spark, sf_dir):
    out = scratch_folder(spark, "routed")
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    export_routed(df, out, "csv", "event_type", include_header=True, records_per_file=1000)
    back = read_csv(spark, out, ["event_id", "user_id"], with_source=True)
    return back.select(folder_name(F.col("source.path")).alias("event_type"), "event_id", "user_id")


@workload(ROUTE_SQL)
def routed_job_events(spark, sf_dir):
    """Routing through job settings, with the old name of the switch."""
    out = scratch_folder(spark, "routed")
    df = table(spark, sf_dir, "events").withColumnRenamed("event_type", "route")
    config = {"path": out, "format": "json", "file_per_slice": True, "_key": "a"}
    routed_sender(df, config)
    back = read_json(spark, out, "event_id bigint", with_source=True)
    return per_folder(back)


@workload(ORDER_SQL)
def append_export_orders(spark, sf_dir):
    out = scratch_folder(spark, "append")
    df = orders(spark, sf_dir)
    done = F.col("o_orderstatus") == "F"
    export(df.where(done), out, "ldjson", file_per_slice=False)
    export(df.where(~done), out, "ldjson", file_per_slice=False)
    return read_ldjson(spark, out, ORDER_TYPE)


@workload(ORDER_SQL)
def slices_export_orders(spark, sf_dir):
    """Two slices with their own ids, the second one written twice: a rerun replaces its files."""
    out = scratch_folder(spark, "slices")
    df = orders(spark, sf_dir)
    done = F.col("o_orderstatus") == "F"
    export(df.where(done), out, "ldjson", id="done")
    for _ in range(2):
        export(df.where(~done), out, "ldjson", id="open", replace=True)
    return read_ldjson(spark, out, ORDER_TYPE)


@workload(ORDER_SQL)
def copy_job_orders(spark, sf_dir):
    """File to file by job settings: export, read, export in another format, read."""
    first, second = scratch_folder(spark, "copy"), scratch_folder(spark, "copy")
    file_exporter(orders(spark, sf_dir), {"path": first, "format": "ldjson", "_name": "sender"})
    df = file_reader(spark, {"path": first, "format": "ldjson", "size": 4_000_000}, ORDER_TYPE)
    file_exporter(df, {"path": second, "format": "json", "file_per_slice": True, "compression": "gzip"})
    config = {"path": second, "format": "json", "file_per_slice": True, "compression": "gzip"}
    return file_reader(spark, config, ORDER_TYPE)


@workload(ORDER_SQL)
def direct_names_orders(spark, sf_dir):
    """The way of object stores: Spark commits the files under their final names."""
    out = scratch_folder(spark, "direct")
    export(orders(spark, sf_dir), out, "ldjson", naming="direct", id="orders")
    return read_ldjson(spark, out, ORDER_TYPE)


@workload(ORDER_SQL)
def two_batches_orders(spark, sf_dir):
    """One job description, two batches: the second goes on with the numbers of the first."""
    out = scratch_folder(spark, "batches")
    df = orders(spark, sf_dir)
    done = F.col("o_orderstatus") == "F"
    job = {"path": out, "format": "ldjson", "file_per_slice": True}
    for batch in (df.where(done), df.where(~done)):
        file_exporter(batch, job)
    return read_ldjson(spark, out, ORDER_TYPE)


@workload(ORDER_SQL)
def rerun_job_orders(spark, sf_dir):
    """A job of two batches died in its second one and runs again, with other batches: its rows are there once."""
    out = scratch_folder(spark, "rerun")
    df = table(spark, sf_dir, "orders").select(ORDER_COLUMNS)
    options = WriteOptions(out, "ldjson", files=4)
    died = Sender(options)
    for k in range(3):
        died.send(df.where(F.pmod("o_orderkey", F.lit(4)) == k))
    again = Sender(options)
    for k in range(2):
        again.send(df.where(F.pmod("o_orderkey", F.lit(2)) == k))
    return read_ldjson(spark, out, ORDER_TYPE)


@workload("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, true AS named FROM orders")
def direct_exact_names_orders(spark, sf_dir):
    """Files that tasks write under names with format and codec: json arrays, two runs, no moves."""
    out = scratch_folder(spark, "direct")
    options = WriteOptions(out, "json", id="orders", naming="direct", compression="gzip", records_per_file=1000)
    for _ in range(2):
        Sender(options).send(orders(spark, sf_dir))
    back = read_json(spark, out, ORDER_TYPE, compression="gzip", with_source=True)
    return back.select(*ORDER_COLUMNS, F.col("source.path").rlike(r"/orders\.\d+\.json\.gz$").alias("named"))


@workload("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderstatus AS folder FROM orders")
def direct_routes_orders(spark, sf_dir):
    """Plain route folders without a move, lz4 frames in them."""
    out = scratch_folder(spark, "direct")
    export_routed(orders(spark, sf_dir).withColumn("to", F.col("o_orderstatus")), out, "ldjson", "to", naming="direct", layout="plain", compression="lz4")
    back = read_ldjson(spark, out, ORDER_TYPE, compression="lz4", with_source=True)
    return back.select(*ORDER_COLUMNS, folder_name(F.col("source.path")).alias("folder"))


@workload(ORDER_SQL)
def direct_rerun_orders(spark, sf_dir):
    """Under Spark's own names, an export that replaces leaves its rows once."""
    out = scratch_folder(spark, "direct")
    for _ in range(2):
        export(orders(spark, sf_dir), out, "ldjson", naming="direct", id="orders", replace=True)
    return read_ldjson(spark, out, ORDER_TYPE)


@workload("SELECT l_returnflag AS folder, true AS first, true AS one_per_file, count(*) AS records FROM lineitem GROUP BY ALL")
def routed_headers_lineitem(spark, sf_dir):
    """Raw lines of a routed csv: each file begins with its header and has no other."""
    out = scratch_folder(spark, "headers")
    df = table(spark, sf_dir, "lineitem")
    export_routed(df, out, "csv", "l_returnflag", include_header=True, fields=["l_orderkey", "l_linenumber", "l_comment", "l_shipdate"])
    lines = read_raw(spark, out, with_source=True).select("data", "source.path", F.monotonically_increasing_id().alias("at"))
    head = F.col("data").startswith('"l_orderkey"')
    files = lines.groupBy("path").agg(
        F.min_by(head, "at").alias("first"), (F.count_if(head) == 1).alias("one"), F.count_if(~head).alias("records")
    )
    return files.groupBy(folder_name(F.col("path")).alias("folder")).agg(
        F.bool_and("first").alias("first"), F.bool_and("one").alias("one_per_file"), F.sum("records").alias("records")
    )


# --- what must not vanish --------------------------------------------------------------


@workload(
    """SELECT p_partkey % 3 = 0 AS surplus, count(*) AS records,
              CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey END) AS BIGINT) AS keys FROM part GROUP BY 1"""
)
def csv_surplus_part(spark, sf_dir):
    """A line with a value beyond the fields is a bad record, and comes back whole."""
    out = scratch_folder(spark, "surplus")
    more = F.when(F.col("p_partkey") % 3 == 0, F.lit(',"x, ""y"""')).otherwise(F.lit(","))
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(',"'), F.col("p_name"), F.lit('"'), more)
    export(table(spark, sf_dir, "part").select(line.alias("data")), out, "raw")
    df = read_csv(spark, out, ["key", "name"], rejects="column")
    whole = F.col("rejected").endswith(',"x, ""y"""')
    return df.groupBy(F.coalesce(whole, F.lit(False)).alias("surplus")).agg(
        F.count("*").alias("records"), F.sum(F.when(F.col("rejected").isNull(), F.col("key").cast("bigint"))).alias("keys")
    )


@workload("SELECT CASE WHEN p_partkey % 4 = 0 THEN 'a' ELSE CAST(p_partkey AS VARCHAR) END AS a, '' AS b, p_name AS c FROM part")
def csv_header_like_part(spark, sf_dir):
    """Where empty cells are values, a line that repeats some names is a record."""
    out = scratch_folder(spark, "header")
    first = F.when(F.col("p_partkey") % 4 == 0, "a").otherwise(F.col("p_partkey").cast("string"))
    third = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("c"), F.col("p_name"))).otherwise(F.col("p_name"))
    lines = table(spark, sf_dir, "part").select(F.concat_ws(",", first, F.lit(""), third).alias("data"))
    likes = spark.range(50).select(F.lit("a,,c").alias("data"))
    export(lines.unionAll(likes), out, "raw")
    back = read_csv(spark, out, ["a", "b", "c"], ignore_empty=False)
    kept = back.where("c = 'c'").count()
    if kept != 50:
        raise AssertionError(f"{kept} of 50 records with the names of fields came back")
    tail = F.when(F.col("a") == "a", F.substring("c", 2, 2**30)).otherwise(F.col("c"))
    return back.where("c <> 'c'").select("a", "b", tail.alias("c"))


@workload("SELECT event_id, user_id AS user, event_type AS kind, value AS number FROM events")
def json_odd_names_events(spark, sf_dir):
    """Names of fields are data: signs, blanks and dots in them, at any depth."""
    out = scratch_folder(spark, "names")
    inner = F.struct(F.col("event_type").alias("user-agent"), F.col("value").alias("a b"))
    df = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("@timestamp"), inner.alias("x.y"))
    export(df, out, "json", records_per_file=2000)
    back = read_json(spark, out, df.schema, size=1024 * 1024)
    return back.select(
        "event_id", F.col("`@timestamp`").alias("user"), F.col("`x.y`.`user-agent`").alias("kind"), F.col("`x.y`.`a b`").alias("number")
    )


@workload("SELECT 'a b%20+' || event_type AS folder, count(*) AS records, true AS listed FROM events GROUP BY 1")
def source_path_odd_names_events(spark, sf_dir):
    """The path of a row is the path of the listing, whatever signs are in it."""
    out = scratch_folder(spark, "paths")
    df = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("a b%20+"), "event_type").alias("route"))
    export_routed(df, out, "ldjson", "route")
    rows = read_ldjson(spark, out, "event_id bigint", with_source=True).groupBy("source.path").agg(F.count("*").alias("n"))
    met = rows.join(file_inventory(spark, out), "path", "left")
    return met.groupBy(folder_name(F.col("path")).alias("folder")).agg(
        F.sum("n").alias("records"), F.bool_and(F.col("size").isNotNull()).alias("listed")
    )


@workload(
    """SELECT 'data/' AS prefix, true AS readable, CAST(sum(strlen(props) + 1) AS BIGINT) AS bytes FROM events
       UNION ALL SELECT '_own/', true, CAST(sum(strlen(props) + 1) AS BIGINT) FROM events
       UNION ALL SELECT '.own/', false, CAST(sum(strlen(props) + 1) AS BIGINT) FROM events"""
)
def inventory_all_events(spark, sf_dir):
    """A listing has all files, those that a reader would not take as well."""
    out = scratch_folder(spark, "inventory")
    df = table(spark, sf_dir, "events").select(F.col("props").alias("data"))
    for folder in ("data", "_own", ".own"):
        export(df, f"{out}/{folder}", "raw")
    objects = file_inventory(spark, out).select(F.concat(F.lit("bucket/"), "key").alias("object"), "size", "readable")
    return inventory_summary(objects).select("prefix", "readable", "bytes")


@workload("SELECT count(*) AS files, sum(strlen(props) + 1)::BIGINT AS bytes, true AS in_tasks FROM events")
def inventory_many_files(spark, sf_dir):
    """As many files as there are events, most of them in one folder, the others deep below; many tasks look at them."""
    out = scratch_folder(spark, "inventory")
    df = table(spark, sf_dir, "events").select(F.col("props").alias("data"), F.when(F.col("event_id") % 10 == 0, "a/b/c/d").otherwise("flat").alias("to"))
    export_routed(df, out, "raw", "to", naming="direct", layout="plain", records_per_file=1, gather_routes=False)
    found = file_inventory(spark, out)
    task = found.select("size", F.spark_partition_id().alias("task"))
    return task.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), (F.countDistinct("task") > 1).alias("in_tasks"))


# --- whole tables, all columns -----------------------------------------------------------


def _full(name: str) -> None:
    def run(spark, sf_dir):
        out = scratch_folder(spark, name)
        df = table(spark, sf_dir, name)
        export(df, out, "ldjson")
        return read_ldjson(spark, out, df.schema)

    run.__doc__ = f"All columns of ``{name}`` to line-delimited json and back."
    WORKLOADS[f"ldjson_full_{name}"] = (run, f"SELECT * FROM {name}")


for _name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
    _full(_name)
for _name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
    _full(_name)


# --- paths, counts, listings -----------------------------------------------------------


@workload(
    """WITH o AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS object FROM pages),
            s AS (SELECT page_id, object, split_part(object, '/', 1) AS bucket,
                         substr(object, length(split_part(object, '/', 1)) + 2) AS rest FROM o)
       SELECT page_id, bucket,
              CASE WHEN rest = '' OR starts_with(rest, '/') THEN ''
                   ELSE regexp_replace(rtrim(rest, '/'), '/+', '/', 'g') || '/' END AS prefix,
              length(bucket) BETWEEN 3 AND 63
                AND regexp_full_match(bucket, '[a-z0-9][a-z0-9.-]*[a-z0-9]')
                AND NOT contains(bucket, '..') AND NOT contains(bucket, '-.') AND NOT contains(bucket, '.-')
                AND NOT regexp_full_match(bucket, '([0-9]{1,3}\\.){3}[0-9]{1,3}') AS valid,
              NOT regexp_matches(object, '(^|/)\\.') AS readable
       FROM s"""
)
def object_path_pages(spark, sf_dir):
    path = F.regexp_replace("url", "^https?://", "")
    df = table(spark, sf_dir, "pages").select("page_id", path.alias("object"))
    place = parse_object_path(F.col("object"))
    return df.select(
        "page_id", place.getField("bucket").alias("bucket"), place.getField("prefix").alias("prefix"), "object"
    ).select(
        "page_id",
        "bucket",
        "prefix",
        is_valid_bucket_name(F.col("bucket")).alias("valid"),
        is_readable_path(F.col("object")).alias("readable"),
    )


@workload(
    """WITH n AS (SELECT p_partkey, unnest([p_name, replace(p_name, ' ', '.'), replace(p_name, ' ', '..'),
                         replace(p_name, ' ', '-.'), replace(p_name, ' ', '-'), p_brand,
                         '10.0.0.' || p_size, '-' || p_size, left(p_name, 2), repeat(p_name, 9)]) AS name FROM part)
       SELECT p_partkey, name,
              length(name) BETWEEN 3 AND 63
                AND regexp_full_match(name, '[a-z0-9][a-z0-9.-]*[a-z0-9]')
                AND NOT contains(name, '..') AND NOT contains(name, '-.') AND NOT contains(name, '.-')
                AND NOT regexp_full_match(name, '([0-9]{1,3}\\.){3}[0-9]{1,3}') AS valid
       FROM n"""
)
def bucket_names_part(spark, sf_dir):
    name = F.col("p_name")
    names = F.array(
        name,
        F.replace(name, F.lit(" "), F.lit(".")),
        F.replace(name, F.lit(" "), F.lit("..")),
        F.replace(name, F.lit(" "), F.lit("-.")),
        F.replace(name, F.lit(" "), F.lit("-")),
        F.col("p_brand"),
        F.concat(F.lit("10.0.0."), "p_size"),
        F.concat(F.lit("-"), "p_size"),
        F.left(name, F.lit(2)),
        F.repeat(name, 9),
    )
    df = table(spark, sf_dir, "part").select("p_partkey", F.explode(names).alias("name"))
    return df.withColumn("valid", is_valid_bucket_name(F.col("name")))


@workload(
    """SELECT count(*) AS written, count(*) AS read, count(*) AS counted, true AS sizes_agree FROM events"""
)
def source_counts(spark, sf_dir):
    """Counts at the sink, at the source and per file; file sizes from two places."""
    out = scratch_folder(spark, "counts")
    written = send(events(spark, sf_dir), WriteOptions(out, "ldjson", records_per_file=2500))
    df, seen = counted(read_ldjson(spark, out, EVENT_TYPE, with_source=True))
    per_file = df.groupBy(
        F.regexp_replace("source.path", "^file:/+", "/").alias("path"), "source.total"
    ).agg(F.count("*").alias("records"))
    listed = file_inventory(spark, out).select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), "size"
    )
    joined = listed.join(per_file, "path", "full")
    row = joined.agg(
        F.sum("records").alias("read"), F.bool_and(F.equal_null("size", "total")).alias("agree")
    ).first()
    return spark.range(1).select(
        F.lit(written).cast("bigint").alias("written"),
        F.lit(row["read"]).cast("bigint").alias("read"),
        F.lit(seen.get["records"]).cast("bigint").alias("counted"),
        F.lit(row["agree"]).alias("sizes_agree"),
    )


@workload(
    """SELECT 'events' AS bucket, event_type || '/' AS prefix, true AS readable,
              CAST(sum(strlen(props) + 1) AS BIGINT) AS bytes
       FROM events GROUP BY event_type"""
)
def inventory_by_prefix(spark, sf_dir):
    out = scratch_folder(spark, "inventory")
    df = table(spark, sf_dir, "events").select("event_type", F.col("props").alias("data"))
    export_routed(df, out, "raw", "event_type")
    objects = file_inventory(spark, out).select(
        F.concat(F.lit("events/"), "key").alias("object"), "size", "readable"
    )
    return inventory_summary(objects).select("bucket", "prefix", "readable", "bytes")


@workload(
    """SELECT event_type AS folder FROM events WHERE event_type > 'error' GROUP BY event_type"""
)
def inventory_start_after(spark, sf_dir):
    out = scratch_folder(spark, "inventory")
    df = table(spark, sf_dir, "events").select("event_type", F.col("props").alias("data"))
    export_routed(df, out, "raw", "event_type")
    # '0' follows '/', so this starts behind everything in the folder error/
    listed = file_inventory(spark, out, start_after="error0")
    return listed.select(F.substring_index("key", "/", 1).alias("folder")).distinct()


# --- records of unknown shape -------------------------------------------------------------


@workload(
    """SELECT '{"props":{"k":' || CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) || '},"event_id":' || event_id
              || CASE WHEN event_id % 2 = 0 THEN ',"tags":[{"k":' || event_id % 5 || '},' || event_id % 3 || ']' ELSE '' END || '}' AS data
       FROM events"""
)
def variant_fields_events(spark, sf_dir):
    """An allow-list on records whose shapes differ: it holds at every depth, in its own order."""
    first, second = scratch_folder(spark, "variant"), scratch_folder(spark, "variant")
    shape = """concat('{"event_id":', event_id, ',"user":{"user_id":', user_id, '},"props":', props,
               IF(event_id % 2 = 0, concat(',"tags":[{"x":"no","k":', event_id % 5, '},', event_id % 3, ']'), ''), '}')"""
    export(table(spark, sf_dir, "events").select(F.expr(shape).alias("data")), first, "raw")
    export(read_ldjson(spark, first, "variant"), second, "ldjson", fields=["props", "k", "event_id", "tags", "absent", "k"])
    return read_raw(spark, second)


@workload(FULL_EVENT_SQL)
def stream_sized_events(spark, sf_dir):
    """One file, read by many tasks of a micro-batch."""
    source, marks, out = (scratch_folder(spark, n) for n in ("source", "marks", "out"))
    df = table(spark, sf_dir, "events")
    export(df, source, "ldjson", files=1)
    stream = read_stream(spark, ReadOptions(source, "ldjson", size=32 * 1024), df.schema)
    export_stream(stream, WriteOptions(out, "ldjson"), marks).awaitTermination()
    return read_ldjson(spark, out, df.schema)


# --- reasons ----------------------------------------------------------------------------


@workload(
    """SELECT CASE o_orderkey % 7 WHEN 0 THEN 'syntax' WHEN 1 THEN 'text after the record' WHEN 2 THEN 'type'
                   WHEN 3 THEN 'no object' WHEN 4 THEN 'blank' END AS reason,
              count(*) AS records, sum(CASE WHEN o_orderkey % 7 = 4 THEN 0 ELSE o_orderkey END)::BIGINT AS keys
       FROM orders WHERE o_orderkey % 7 < 5 GROUP BY 1"""
)
def reject_reasons(spark, sf_dir):
    """Five of seven records are broken, each kind by a rule of its own."""
    out = scratch_folder(spark, "reasons")
    shape = """CASE o_orderkey % 7 WHEN 0 THEN concat('{"k":', o_orderkey, ',}') WHEN 1 THEN concat('{"k":', o_orderkey, '} x')
               WHEN 2 THEN concat('{"k":"no ', o_orderkey, '"}') WHEN 3 THEN concat('[', o_orderkey, ']') WHEN 4 THEN ''
               ELSE concat('{"k":', o_orderkey, '}') END"""
    export(table(spark, sf_dir, "orders").select(F.expr(shape).alias("data")), out, "raw")
    _, bad = read_ldjson(spark, out, "k bigint", rejects="reasons")
    keys = F.coalesce(F.try_to_number(F.regexp_extract("record", "[0-9]+", 0), F.lit("999999999999")), F.lit(0))
    return bad.groupBy("reason").agg(F.count("*").alias("records"), F.sum(keys).cast("bigint").alias("keys"))


# --- names that say nothing -------------------------------------------------------------


@workload(FULL_EVENT_SQL)
def underscore_names_events(spark, sf_dir):
    """Half of the events in files and folders whose names begin with an underscore."""
    out = scratch_folder(spark, "names")
    df = table(spark, sf_dir, "events")
    export(df.where("event_id % 2 = 0"), out, "ldjson", id="_part")
    export(df.where("event_id % 4 = 1"), f"{out}/_sub/deep", "ldjson")
    export(df.where("event_id % 4 = 3"), out, "ldjson")
    return read_ldjson(spark, out, df.schema, size=64 * 1024)


@workload(FULL_EVENT_SQL)
def plain_bytes_any_name_events(spark, sf_dir):
    """Plain lines under the endings of codecs, beside lines that are what their name says."""
    out = scratch_folder(spark, "names")
    df = table(spark, sf_dir, "events")
    for n, ending in enumerate(("lz4", "gz", "zst", "json.snappy")):
        export(df.where(f"event_id % 6 = {n}"), out, "ldjson", id=f"p{n}", extension=ending)
    export(df.where("event_id % 6 = 4"), out, "ldjson", id="p4", compression="gzip")
    export(df.where("event_id % 6 = 5"), out, "ldjson", id="p5")
    return read_ldjson(spark, out, df.schema, size=64 * 1024)


@workload(FULL_EVENT_SQL)
def hidden_lz4_events(spark, sf_dir):
    """lz4 frames that are decoded step by step, since their names hide them from Spark."""
    out = scratch_folder(spark, "names")
    df = table(spark, sf_dir, "events")
    export(df, out, "ldjson", id="_part", compression="lz4", extension="bin")
    return read_ldjson(spark, out, df.schema, compression="lz4")


@workload(FULL_EVENT_SQL)
def stream_late_names_events(spark, sf_dir):
    """A stream that is started three times; files with any name come between and are read once."""
    source, marks, log, out = (scratch_folder(spark, n) for n in ("source", "marks", "log", "out"))
    df = table(spark, sf_dir, "events")
    for n, (id, ending) in enumerate((("a", "ldjson"), ("_b", "ldjson"), ("c", "lz4"))):
        export(df.where(f"event_id % 3 = {n}"), source, "ldjson", id=id, extension=ending)
        stream = read_stream(spark, ReadOptions(source, "ldjson"), df.schema, every_name=log)
        export_stream(stream, WriteOptions(out, "ldjson"), marks).awaitTermination()
    return read_ldjson(spark, out, df.schema)


# --- streams ---------------------------------------------------------------------------


@workload(EVENT_SQL)
def stream_ldjson_events(spark, sf_dir):
    source, out, marks = (scratch_folder(spark, name) for name in ("in", "out", "marks"))
    export(events(spark, sf_dir), source, "ldjson", records_per_file=5000)
    options = ReadOptions(path=source, format="ldjson")
    df = read_stream(spark, options, EVENT_TYPE, bytes_per_batch=256 * 1024 * 1024)
    export_stream(df, WriteOptions(out, "ldjson"), marks).awaitTermination()
    return read_ldjson(spark, out, EVENT_TYPE)


@workload(ROUTE_SQL)
def stream_routed_events(spark, sf_dir):
    source, out, marks = (scratch_folder(spark, name) for name in ("in", "out", "marks"))
    export(events(spark, sf_dir), source, "csv", include_header=True, compression="gzip")
    options = ReadOptions(path=source, format="csv", fields=EVENT_COLUMNS, compression="gzip")
    df = read_stream(spark, options)
    sink = WriteOptions(out, "ldjson", dynamic_routing=True, route_col="event_type")
    export_stream(df, sink, marks).awaitTermination()
    return per_folder(read_raw(spark, out, with_source=True))
