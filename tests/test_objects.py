"""Bucket and prefix paths end to end, on a mount table that has the shape of an object store."""

import pytest

from millrace import file_inventory, parse_object_path, read_raw, routed_sender, s3_exporter, s3_reader
from millrace.functions import object_uri
from pyspark.sql import functions as F

SCHEMA = "id bigint, name string, value bigint"


@pytest.fixture
def bucket(spark, folder):
    """``viewfs://<bucket>/data`` stands for ``s3a://<bucket>/data``."""
    name = "bucket-" + folder.name.replace("_", "0")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    (folder / "data").mkdir()
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{folder}/data")
    return name


@pytest.fixture
def records(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], SCHEMA)


@pytest.mark.parametrize("format, compression", [("json", "none"), ("ldjson", "gzip"), ("csv", "lz4")])
def test_bucket_to_bucket(spark, bucket, records, format, compression):
    first = {"path": f"/{bucket}/data/in", "format": format, "compression": compression, "id": "w",
             "file_per_slice": True, "fields": ["id", "name", "value"]}
    second = {**first, "path": f"{bucket}/data/out/"}
    assert s3_exporter(records, first, scheme="viewfs") is records
    df = s3_reader(spark, first, None if format == "csv" else SCHEMA, scheme="viewfs")
    s3_exporter(df, second, scheme="viewfs")
    back = s3_reader(spark, second, None if format == "csv" else SCHEMA, scheme="viewfs")
    got = {(int(r.id), r.name, int(r.value)) for r in back.select("id", "name", "value").collect()}
    assert got == {(1, "a", 10), (2, "b", 20), (3, "c", 30)}


def test_routes_as_object_prefixes(spark, bucket, records, folder, text_of):
    config = {"path": f"{bucket}/data/testing", "format": "ldjson", "id": "w", "_key": "a", "fields": ["id"]}
    df = records.withColumn("route", F.when(F.col("id") > 1, F.col("id").cast("string")))
    assert routed_sender(df, {**config, "naming": "direct"}, scheme="viewfs") == 3
    names = {name.rsplit("/", 1)[0] for name in text_of(folder / "data")}
    assert names == {f"testing/route={r}" for r in ("2", "3", "__HIVE_DEFAULT_PARTITION__")}


def test_listing_of_a_bucket(spark, bucket, records):
    config = {"path": f"{bucket}/data/list", "format": "ldjson", "id": "w"}
    s3_exporter(records.coalesce(1), config, scheme="viewfs")
    listed = file_inventory(spark, object_uri(f"{bucket}/data/list", "viewfs"))
    assert [(r.key, r.readable) for r in listed.collect()] == [("w.0.ldjson", True)]
    place = listed.select(parse_object_path(F.concat(F.lit(f"{bucket}/data/list/"), "key")).alias("p")).first().p
    assert tuple(place) == (bucket, "data/list/w.0.ldjson/")
    uri = object_uri(f"/{bucket}/data/list/", "viewfs")
    assert read_raw(spark, uri).count() == 3
