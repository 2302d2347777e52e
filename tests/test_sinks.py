import gzip
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace import (
    OptionError,
    WriteOptions,
    counted,
    export,
    export_routed,
    file_exporter,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    render_json,
    routed_sender,
    s3_exporter,
    send,
)

from conftest import SF

HEAD = '"code","item","stock"\n'
BODY = '42,"kettle",55\n43,"lamp",56\n44,"rope",57\n'


@pytest.fixture
def data(spark):
    rows = [(42, "kettle", 55), (43, "lamp", 56), (44, "rope", 57)]
    return spark.createDataFrame(rows, "code long, item string, stock long").coalesce(1)


@pytest.fixture
def routed(spark):
    return spark.createDataFrame([("north", "0"), ("south", "1")], "code string, route string").coalesce(1)


def test_csv_files_of_two_slices(data, folder, text_of):
    for slice_count in (0, 1):
        export(data, str(folder), "csv", id="w", fields=["item", "code"], first_slice=slice_count)
    expected = '"kettle",42\n"lamp",43\n"rope",44\n'
    assert text_of(folder) == {"w.0.csv": expected, "w.1.csv": expected}
    # the same slice again replaces its file
    export(data, str(folder), "csv", id="w", first_slice=1, include_header=True)
    assert text_of(folder) == {"w.0.csv": expected, "w.1.csv": HEAD + BODY}


def test_empty_input_writes_nothing(data, folder, text_of):
    for compression in ("none", "gzip", "lz4"):
        for format in ("csv", "ldjson", "json"):
            assert send(data.where("false"), WriteOptions(str(folder), format, compression=compression)) == 0
    assert text_of(folder) == {}
    send(data.where("false"), WriteOptions(str(folder), "csv", naming="direct", compression="gzip"))
    assert text_of(folder) == {}


def test_rerun_with_fewer_files_replaces_all(spark, folder, text_of):
    export(spark.range(0, 50, 1, 5), str(folder), "ldjson", id="w")
    export(spark.range(0, 7, 1, 2), str(folder), "ldjson", id="other")
    export(spark.range(0, 50, 1, 2), str(folder), "ldjson", id="w", replace=True)
    names = set(text_of(folder))
    assert names == {"w.0.ldjson", "w.1.ldjson", "other.0.ldjson", "other.1.ldjson"}
    assert read_ldjson(spark, str(folder), "id bigint").count() == 57


def test_second_batch_goes_on(spark, folder, text_of):
    job = {"path": str(folder), "format": "ldjson", "file_per_slice": True}
    file_exporter(spark.range(0, 10, 1, 2), job)
    file_exporter(spark.range(10, 20, 1, 1), job)
    assert set(text_of(folder)) == {"part.0.ldjson", "part.1.ldjson", "part.2.ldjson"}
    assert sorted(r.id for r in read_ldjson(spark, str(folder), "id bigint").collect()) == list(range(20))


@pytest.mark.parametrize("naming", ["exact", "direct"])
def test_replace_removes_stale_routes(spark, folder, naming):
    for n in (4, 2):
        df = spark.range(20).select("id", (F.col("id") % n).cast("string").alias("route"))
        export_routed(df, str(folder), "ldjson", "route", id="w", naming=naming, replace=True)
    other = spark.range(100, 105).withColumn("route", F.lit("0"))
    export_routed(other, str(folder), "ldjson", "route", id="other", naming=naming)
    assert sorted(r.id for r in read_ldjson(spark, str(folder), "id bigint").collect()) == [*range(20), *range(100, 105)]


def test_route_of_a_dot_is_the_root(spark, folder):
    df = spark.createDataFrame([(1, "."), (2, None), (3, ""), (4, "./x/.")], "id long, route string")
    export_routed(df, str(folder), "ldjson", "route", id="w")
    found = read_ldjson(spark, str(folder), "id bigint", with_source=True).select("id", F.element_at(F.split("source.path", "/"), -2).alias("f"))
    assert {r.id: r.f for r in found.collect()} == {1: folder.name, 2: folder.name, 3: folder.name, 4: "x"}


@pytest.mark.parametrize("records", [None, 3000])
def test_headers_of_routes_stay_in_front_when_sorts_spill(spark, folder, text_of, records):
    df = spark.range(0, 40000, 1, 2).select("id", (F.col("id") % 3).cast("string").alias("route"))
    export_routed(df, str(folder), "csv", "route", include_header=True, records_per_file=records, compression="none")
    for text in text_of(folder).values():
        lines = text.splitlines()
        assert lines[0] == '"id"' and lines.count('"id"') == 1 and text.endswith("\n") and "" not in lines
    assert read_csv(spark, str(folder), ["id"]).count() == 40000


def test_hot_route_is_split_by_the_rebalance(spark, folder, text_of):
    """Nine rows of ten share a route; adaptive execution still cuts it into several files."""
    df = spark.range(0, 200000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 != 0, "hot").otherwise("cold").alias("route"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        export_routed(df, str(folder), "ldjson", "route", id="w")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = text_of(folder)
    assert len([n for n in files if n.startswith("hot/")]) > 4
    assert sum(text.count("\n") for text in files.values()) == 200000


def test_one_header_per_file(data, folder, text_of):
    export(data, str(folder), "csv", id="w", include_header=True, records_per_file=2)
    lines = BODY.splitlines(True)
    assert text_of(folder) == {"w.0.csv": HEAD + lines[0] + lines[1], "w.1.csv": HEAD + lines[2]}


def test_appending(data, folder, text_of):
    config = {"path": str(folder), "format": "csv", "include_header": True, "id": "w"}
    file_exporter(data, config)
    file_exporter(data, config)
    assert text_of(folder) == {"w.csv": HEAD + BODY, "w-1.csv": HEAD + BODY}


@pytest.mark.parametrize(
    "settings, name, text",
    [
        ({"format": "csv", "field_delimiter": "\t"}, "w.csv", BODY.replace(",", "\t")),
        ({"format": "csv", "field_delimiter": "^"}, "w.csv", BODY.replace(",", "^")),
        ({"format": "csv", "line_delimiter": "^"}, "w.csv", BODY.replace("\n", "^")),
        ({"format": "tsv"}, "w.tsv", BODY.replace(",", "\t")),
        (
            {"format": "ldjson", "fields": ["item", "code"]},
            "w.ldjson",
            '{"item":"kettle","code":42}\n{"item":"lamp","code":43}\n'
            '{"item":"rope","code":44}\n',
        ),
        (
            {"format": "json", "fields": ["code", "field8"], "file_per_slice": True},
            "w.0.json",
            '[{"code":42},{"code":43},{"code":44}]\n',
        ),
    ],
)
def test_formats(data, folder, text_of, settings, name, text):
    file_exporter(data, {"path": str(folder), "id": "w", **settings})
    assert text_of(folder) == {name: text}


def test_raw_file(spark, folder, text_of):
    df = spark.createDataFrame([("line one",), ("line two",), ("line three",)], "data string").coalesce(1)
    file_exporter(df, {"path": str(folder), "format": "raw", "id": "w", "line_delimiter": "\t"})
    assert text_of(folder) == {"w": "line one\tline two\tline three\t"}


def test_exporters_do_not_route(routed, folder, text_of):
    config = {"path": str(folder), "format": "json", "id": "w", "file_per_slice": True,
              "dynamic_routing": True, "route_col": "route"}
    assert file_exporter(routed, config) is routed
    assert text_of(folder) == {"w.0.json": '[{"code":"north"},{"code":"south"}]\n'}


@pytest.mark.parametrize("switch", [{"dynamic_routing": True}, {"_key": "a"}])
def test_routing(routed, folder, text_of, switch):
    config = {"path": str(folder), "format": "json", "id": "w", "file_per_slice": True, **switch}
    assert routed_sender(routed, config) == 2
    assert text_of(folder) == {"0/w.0.json": '[{"code":"north"}]\n', "1/w.0.json": '[{"code":"south"}]\n'}


def test_records_without_route_stay_at_the_root(spark, folder, text_of):
    rows = [("oak", None), ("elm", "a"), ("fir", "b/c"), ("yew", "")]
    df = spark.createDataFrame(rows, "name string, to string")
    export_routed(df, str(folder / "p"), "ldjson", "to", id="w")
    got = text_of(folder / "p")
    assert sorted("".join(v for k, v in got.items() if "/" not in k).splitlines()) == [
        '{"name":"oak"}', '{"name":"yew"}',
    ]
    assert got["a/w.0.ldjson"] == '{"name":"elm"}\n' and got["b/c/w.0.ldjson"] == '{"name":"fir"}\n'
    export_routed(df, str(folder / "h"), "ldjson", "to", id="w", layout="hive")
    assert {k.split("/")[0] for k in text_of(folder / "h")} == {"to=__HIVE_DEFAULT_PARTITION__", "to=a", "to=b%2Fc"}


def test_route_cannot_leave_the_folder(spark, folder, text_of):
    df = spark.createDataFrame([("x", "../up")], "name string, route string")
    with pytest.raises(ValueError):
        export_routed(df, str(folder / "in"), "ldjson", "route")
    assert text_of(folder) == {}


@pytest.mark.parametrize("compression", ["none", "gzip", "lz4"])
@pytest.mark.parametrize("format", ["csv", "json"])
def test_hot_route_with_headers(spark, folder, format, compression):
    """A third of the rows on one route: every file of every route is complete by itself."""
    df = spark.range(0, 30000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 7)).alias("route")
    )
    export_routed(
        df, str(folder), format, "route", include_header=True, records_per_file=1000, compression=compression
    )
    suffix = {"none": "", "gzip": ".gz", "lz4": ".lz4"}[compression]
    found = {}
    for file in folder.rglob(f"*.{format}{suffix}"):
        body = file.read_bytes()
        if compression == "gzip":
            body = gzip.decompress(body)
        elif compression == "lz4":
            body = pa.CompressedInputStream(pa.BufferReader(body), "lz4").read()
        if format == "csv":
            head, *lines = body.decode().splitlines()
            assert head == '"id"' and 0 < len(lines) <= 1000
            ids = [int(line) for line in lines]
        else:
            ids = [record["id"] for record in json.loads(body)]
            assert 0 < len(ids) <= 1000
        found.setdefault(file.parent.name, []).extend(ids)
    expected = {}
    for i in range(30000):
        expected.setdefault("hot" if i % 3 == 0 else f"r{i % 7}", []).append(i)
    assert {k: sorted(v) for k, v in found.items()} == expected


def test_json_arrays_are_bounded(spark):
    df = spark.range(0, 100, 1, 2)
    arrays = [json.loads(r.value) for r in render_json(df, records_per_file=30).collect()]
    assert sorted(len(a) for a in arrays) == [20, 20, 30, 30]
    assert sorted(x["id"] for a in arrays for x in a) == list(range(100))
    small = [json.loads(r.value) for r in render_json(df, bytes_per_file=1).collect()]
    assert sorted(x["id"] for a in small for x in a) == list(range(100))


def test_counts(data, folder):
    df, seen = counted(data)
    assert send(df, WriteOptions(str(folder), "csv")) == 3
    assert seen.get == {"records": 3}


def test_object_paths(data, monkeypatch):
    with pytest.raises(OptionError):
        s3_exporter(data, {"path": "bucket/x", "format": "ldjson", "file_per_slice": False})


def test_other_files_are_left_alone(data, folder, text_of):
    (folder / "other.csv").write_text("keep")
    export(data, str(folder), "csv", id="w")
    assert text_of(folder)["other.csv"] == "keep"
    assert not [p for p in folder.iterdir() if p.name.startswith(".w-")]


def test_failed_export_leaves_nothing(spark, folder, text_of):
    df = spark.range(10).select(F.raise_error(F.lit("no")).cast("string").alias("data"))
    with pytest.raises(Exception):
        export(df, str(folder), "raw")
    assert text_of(folder) == {}


KINDS = [("ldjson", "\n"), ("ldjson", "\u0001|\n"), ("csv", "\u0001"), ("csv", "\u0001|\n"), ("tsv", "\u0001"), ("json", "\n"), ("raw", "\u0001|")]


@pytest.mark.parametrize("compression", ["none", "gzip", "lz4"])
@pytest.mark.parametrize("format, delimiter", KINDS)
def test_what_goes_out_comes_back(spark, folder, format, delimiter, compression):
    """Whole texts of every table row, with quotes, breaks and four languages in them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.trim("text").alias("text")
    )
    df = docs.repartition(3)
    path = str(folder / "out")
    common = {"compression": compression, "line_delimiter": delimiter}
    if format == "raw":
        df = df.select(F.concat_ws("\t", "doc_id", "text").alias("data"))
    export(df, path, format, include_header=True, **common)
    schema = "doc_id string, text string"
    if format == "ldjson":
        back = read_ldjson(spark, path, schema, **common)
    elif format == "json":
        back = read_json(spark, path, schema, compression=compression)
    elif format == "raw":
        back = read_raw(spark, path, **common)
    else:
        separator = "\t" if format == "tsv" else ","
        back = read_csv(spark, path, ["doc_id", "text"], separator, **common)
        df = df.select("doc_id", F.nullif("text", F.lit("")).alias("text"))
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0
