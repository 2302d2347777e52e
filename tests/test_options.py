import pytest

from millrace import OptionError, ReadOptions, WriteOptions, file_name


def test_read_needs_path_and_format():
    with pytest.raises(OptionError):
        ReadOptions.from_config({"format": "ldjson"})
    with pytest.raises(OptionError):
        ReadOptions.from_config({"path": "/x"})
    with pytest.raises(OptionError):
        ReadOptions(path="/x", format="something")
    with pytest.raises(OptionError):
        ReadOptions(path=12, format="ldjson")


def test_read_defaults_of_a_job():
    options = ReadOptions.from_config({"path": "/x", "format": "ldjson", "_name": "reader"})
    assert options.size is None
    assert options.file_per_slice is False
    assert options.compression == "none"
    assert options.on_reject == "throw"
    assert options.remove_header and options.ignore_empty


def test_compression_means_whole_files():
    for compression in ("gzip", "lz4"):
        with pytest.raises(OptionError):
            ReadOptions.from_config({"path": "/x", "format": "ldjson", "compression": compression})
        with pytest.raises(OptionError):
            WriteOptions.from_config({"path": "/x", "format": "ldjson", "compression": compression})
        ReadOptions.from_config(
            {"path": "/x", "format": "ldjson", "compression": compression, "file_per_slice": True}
        )
    with pytest.raises(OptionError):
        ReadOptions(path="/x", format="ldjson", compression="zip")


def test_dead_letter_action_names():
    assert ReadOptions.from_config({"path": "/x", "format": "raw", "_dead_letter_action": "none"}).on_reject == "none"
    assert ReadOptions.from_config({"path": "/x", "format": "raw", "on_reject_action": "log"}).on_reject == "log"
    with pytest.raises(OptionError):
        ReadOptions(path="/x", format="raw", on_reject="explode")


def test_tsv_takes_a_tab_only():
    fields = ["a", "b"]
    assert ReadOptions(path="/x", format="tsv", fields=fields, field_delimiter="\t").separator == "\t"
    assert ReadOptions(path="/x", format="tsv", fields=fields).separator == "\t"
    with pytest.raises(OptionError):
        ReadOptions(path="/x", format="tsv", fields=fields, field_delimiter=",")
    # a writer may override it
    assert WriteOptions(path="/x", format="tsv", field_delimiter=",").separator == ","


@pytest.mark.parametrize(
    "bad",
    [
        {"fields": "a"},
        {"fields": [1]},
        {"fields": []},
        {"fields": ["a", "a"]},
        {"fields": ["a"], "remove_header": "yes"},
        {"fields": ["a"], "ignore_empty": 1},
        {"fields": ["a"], "extra_args": ["x"]},
        {"fields": ["a"], "field_delimiter": 7},
        {"fields": ["a"], "line_delimiter": 7},
        {"fields": ["a"], "size": 0},
    ],
)
def test_csv_reader_checks(bad):
    with pytest.raises(OptionError):
        ReadOptions(path="/x", format="csv", **bad)


def test_writer_checks():
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="json", file_per_slice=False)
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="something")
    with pytest.raises(OptionError):
        WriteOptions(path=None, format="csv")
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="csv", id=4)
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="csv", line_delimiter=4)
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="csv", concurrency=0)
    with pytest.raises(OptionError):
        WriteOptions(path="s3a://bucket/x", format="csv", file_per_slice=False)
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="csv", dynamic_routing=True)
    with pytest.raises(OptionError):
        WriteOptions(path="/x", format="csv", job=4)
    assert WriteOptions(path="s3a://b/x", format="csv", dynamic_routing=True, route_col="r", layout="plain").layout_mode == "plain"


def test_old_routing_setting():
    assert WriteOptions.from_config({"path": "/x", "format": "csv", "_key": "a"}).dynamic_routing
    assert not WriteOptions.from_config({"path": "/x", "format": "csv"}).dynamic_routing


def test_object_stores_keep_spark_names():
    options = WriteOptions(path="s3a://bucket/x", format="csv")
    assert (options.naming_mode, options.layout_mode) == ("direct", "hive")
    options = WriteOptions(path="hdfs://nn/x", format="csv")
    assert (options.naming_mode, options.layout_mode) == ("exact", "plain")


@pytest.mark.parametrize(
    "settings, name",
    [
        (dict(format="ldjson"), "dir/run-7.ldjson"),
        (dict(format="json", file_per_slice=True, slice_count=25), "dir/run-7.25.json"),
        (dict(format="tsv"), "dir/run-7.tsv"),
        (dict(format="csv"), "dir/run-7.csv"),
        (dict(format="csv", extension="foo"), "dir/run-7.foo"),
        (dict(format="csv", extension=".foo"), "dir/run-7.foo"),
        (dict(format="csv", compression="lz4", extension=""), "dir/run-7"),
        (dict(format="raw"), "dir/run-7"),
        (dict(format="ldjson", compression="lz4", file_per_slice=True, slice_count=0), "dir/run-7.0.ldjson.lz4"),
        (dict(format="csv", compression="gzip", file_per_slice=True, slice_count=0), "dir/run-7.0.csv.gz"),
    ],
)
def test_file_name(settings, name):
    assert file_name("dir", "run-7", **settings) == name


def test_unknown_settings_are_refused():
    for cls in (ReadOptions, WriteOptions):
        with pytest.raises(OptionError, match="on_reject_acton"):
            cls.from_config({"path": "/x", "format": "ldjson", "on_reject_acton": "none"})
        cls.from_config({"path": "/x", "format": "ldjson", "_op": "x", "_name": "y"})
