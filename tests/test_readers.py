import gzip
import json
import logging
import os
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import Observation, functions as F, types as T

from millrace import (
    OptionError,
    ReadOptions,
    SourceError,
    check_source,
    file_inventory,
    file_reader,
    inventory_summary,
    read,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    read_tsv,
    with_source,
)

BAD = '{"p": "data"}\n{"q": data}\n{"r": "data"}\n'


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def rows(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def lz4(text):
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as out:
        out.write(text.encode() if isinstance(text, str) else text)
    return sink.getvalue().to_pybytes()


def test_bad_record_does_not_spoil_the_rest(spark, folder):
    path = put(folder, "x", BAD)
    schema = "p string, r string"
    assert rows(read_ldjson(spark, path, schema, on_reject="none")) == [
        {"p": "data", "r": None}, {"p": None, "r": "data"},
    ]
    with pytest.raises(Exception, match="bad record: .*q"):
        read_ldjson(spark, path, schema).count()
    good, bad = read_ldjson(spark, path, schema, rejects=True)
    assert good.count() == 2
    assert bad.count() == 1
    (row,) = bad.collect()
    assert row.record == '{"q": data}' and row.path.endswith("/x")
    marked = read_ldjson(spark, path, schema, rejects="column")
    assert [r.rejected for r in marked.collect()] == [None, '{"q": data}', None]


def test_log_counts_and_reports(spark, folder, caplog):
    path = put(folder, "x", BAD)
    seen = Observation()
    df = read_ldjson(spark, path, "p string", on_reject="log", observation=seen)
    assert df.count() == 2
    assert seen.get == {"read": 3, "rejected": 1}
    with caplog.at_level(logging.ERROR, "millrace"):
        read_ldjson(spark, path, "p string", on_reject="log").collect()
        until = time.time() + 10
        while not caplog.records and time.time() < until:
            time.sleep(0.1)
    assert "1 bad records of 3" in caplog.text


def test_what_counts_as_one_record(spark, folder):
    refused = ['', '  ', '{"a":1}x', '{"a":1}{"a":2}', '{"a":1}}', '{"a":1},{"a":2}', '[{"a":1}]', "null", "5",
               '"{}"', "{'a':1}", '{"a":NaN}', '{"a":"text"}', '{"a":1', '{"a":1},"_end":1', '{"a":1},"b":{}']
    taken = ['{"a":1}', ' {"a" : 1 } ', "{}", '{"a":null}', '{"b":{"c":[1,2]}}']
    text = "\n".join(refused + taken) + "\n"
    path = put(folder, "x", text)
    good, bad = read_ldjson(spark, path, "a bigint", rejects=True)
    assert [r.a for r in good.collect()] == [1, 1, None, None, None]
    for line in refused:
        alone = put(folder / "alone", "x", line + "\n")
        with pytest.raises(Exception, match="bad record: "):
            read_ldjson(spark, alone, "a bigint").collect()
    assert [r.record for r in bad.collect()] == refused


def test_variant_records(spark, folder):
    lines = ['{"f":{"x":1}}', '{"f":[{"x":2}]}', "[1]", "null", "x", "{},{}", "{}}"]
    path = put(folder, "x", "\n".join(lines))
    df = read_ldjson(spark, path, "variant", on_reject="none")
    assert [json.loads(r.t) for r in df.select(F.to_json("record").alias("t")).collect()] == [
        {"f": {"x": 1}}, {"f": [{"x": 2}]},
    ]


def test_multi_character_delimiter(spark, folder):
    path = put(folder, "x", '{"t": "1"}\r\n\f{"t": "2"}\r\n\f')
    assert [r.t for r in read_ldjson(spark, path, "t string", "\r\n\f").collect()] == ["1", "2"]


def test_carriage_return_stays(spark, folder):
    path = put(folder, "x", "a\r\nb\n\n\nc")
    assert [r.data for r in read_raw(spark, path).collect()] == ["a\r", "b", "", "", "c"]


def test_schema_is_inferred(spark, folder):
    path = put(folder, "x.ldjson", '{"b":1,"a":{"c":[1.5]}}\n')
    df = read_ldjson(spark, path)
    assert df.schema.simpleString() == "struct<a:struct<c:array<double>>,b:bigint>"
    put(folder, "y.lz4", lz4('[{"z":1},{"z":2}]'))
    df = read_json(spark, str(folder / "y.lz4"), compression="lz4")
    assert rows(df) == [{"z": 1}, {"z": 2}]


def test_json_files(spark, folder):
    put(folder, "one.json", '{\n "name": "n",\n "ops": [{"op": 1}]\n}\n')
    put(folder, "sub/many.json", json.dumps([{"name": str(i), "ops": []} for i in range(5)]))
    schema = "name string, ops array<struct<op:bigint>>"
    for strict in (True, False):
        df = read_json(spark, str(folder), schema, strict=strict)
        assert sorted(r.name for r in df.collect()) == ["0", "1", "2", "3", "4", "n"]
    assert read_json(spark, str(folder), schema, fields=["name"]).columns == ["name"]


def test_json_elements_are_judged_one_by_one(spark, folder):
    put(folder, "a", '[{"a":1}, 5, {"a":"q"}, "{\\"a\\":7}", null, [{"a":8}], {"a":3}]\n')
    put(folder, "b", '[{"a":1},')
    put(folder, "c", '[{"a":1}] tail')
    good, bad = read_json(spark, str(folder), "a bigint", rejects=True)
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert sorted(r.record for r in bad.collect()) == sorted(
        ["5", '{"a":"q"}', '"{\\"a\\":7}"', "null", '[{"a":8}]', '[{"a":1},', '[{"a":1}] tail']
    )
    with pytest.raises(Exception, match="bad record"):
        read_json(spark, str(folder), "a bigint").count()


FIELDS = ["c1", "c2", "c3", "c4", "c5", "c6"]
TABLE = "c1,c2,c3,c4,c5,c6\n1,2,3,4,5,6\n7,1,7,2,7,3\n9,9,8,8,7,7\n"


def test_csv_headers(spark, folder):
    path = put(folder, "csv.txt", TABLE)
    kept = rows(read_csv(spark, path, FIELDS, remove_header=False))
    assert len(kept) == 4 and kept[0] == {f: f for f in FIELDS}
    removed = rows(read_csv(spark, path, FIELDS))
    assert len(removed) == 3 and removed[0] == {f: str(i + 1) for i, f in enumerate(FIELDS)}
    # in any place and order
    path = put(folder / "more", "x", "1,2\nb,a\n3,4\n b , a\na,a\n")
    assert rows(read_csv(spark, path, ["a", "b"])) == [
        {"a": "1", "b": "2"}, {"a": "3", "b": "4"}, {"a": "a", "b": "a"},
    ]


def test_tsv(spark, folder):
    path = put(folder, "x.tsv", TABLE.replace(",", "\t"))
    assert len(rows(read_tsv(spark, path, FIELDS))) == 3
    path = put(folder / "more", "x.tsv", "a\t\tc\n\tx\t\n")
    assert rows(read_tsv(spark, path, ["p", "q", "r"])) == [
        {"p": "a", "q": None, "r": "c"}, {"p": None, "q": "x", "r": None},
    ]


def test_csv_cells(spark, folder):
    text = '1, "x,y" ,3\n"q""r",,\n  ,\u00a0z\u00a0," k "\n1,2,3,4\n1\n5" pipe,"a"b,c\n'
    path = put(folder, "x", text)
    assert [tuple(r) for r in read_csv(spark, path, ["a", "b", "c"], surplus="cut").collect()] == [
        ("1", "x,y", "3"), ('q"r', None, None), (None, "z", "k"), ("1", "2", "3"), ("1", None, None),
        ('5" pipe', '"a"b', "c"),
    ]
    assert [tuple(r) for r in read_csv(spark, path, ["a", "b", "c"], ignore_empty=False, surplus="cut").collect()][1] == (
        'q"r', "", "",
    )
    good, bad = read_csv(spark, path, ["a", "b", "c"], rejects=True, check_width=True)
    assert sorted(r.record for r in bad.collect()) == ["1", "1,2,3,4"]


def test_csv_rejects(spark, folder):
    refused = ["", ",,", '"open,1,2', '1,"open', '1,"a""', '1,"",  "z']
    path = put(folder, "x", "1,2,3\n" + "\n".join(refused) + '\n"a\'b","",""""\n')
    good, bad = read_csv(spark, path, ["a", "b", "c"], rejects=True)
    assert sorted(r.record for r in bad.collect()) == sorted(refused)
    assert [tuple(r) for r in good.collect()] == [("1", "2", "3"), ("a'b", None, '"')]
    with pytest.raises(Exception, match="bad record"):
        read_csv(spark, path, ["a", "b", "c"]).count()
    assert read_csv(spark, path, ["a", "b", "c"], on_reject="none").count() == 2


def test_csv_delimiters_and_extra_args(spark, folder):
    path = put(folder, "x", "#c\n1||'a||b'^2||c^")
    df = read_csv(spark, path, ["a", "b"], "||", "^", extra_args={"quote": "'", "comment": "#"}, on_reject="none")
    assert [tuple(r) for r in df.collect()] == [("2", "c")]
    path = put(folder / "more", "x", "1;2\n")
    assert rows(read_csv(spark, path, ["a", "b"], extra_args={"delimiter": ";"})) == [{"a": "1", "b": "2"}]
    extra = {"delimiter": ";", "headers": ["x", "y", "z"], "ignoreEmpty": False}
    assert rows(read_csv(spark, path, ["a", "b"], extra_args=extra)) == [{"x": "1", "y": "2", "z": ""}]
    extra["checkColumn"] = True
    assert rows(read_csv(spark, path, ["a"], extra_args=extra, on_reject="none")) == []


def test_trusted_csv(spark, folder):
    path = put(folder, "x", "a,b\n1, 2 \n\"x,y\",\n")
    df = read_csv(spark, path, ["a", "b"], strict=False)
    assert [tuple(r) for r in df.collect()] == [("1", "2"), ("x,y", None)]


def test_line_with_break_inside_a_cell(spark, folder):
    path = put(folder, "x", '1,"a\r\nb"^2,c^')
    assert [tuple(r) for r in read_csv(spark, path, ["a", "b"], ",", "^").collect()] == [
        ("1", "a\r\nb"), ("2", "c"),
    ]


def test_recursion_and_hidden_files(spark, folder):
    for name in ("a", "d/b", "d/e/c", ".h", "d/.hidden/x"):
        put(folder, name, name + "\n")
    assert sorted(r.data for r in read_raw(spark, str(folder)).collect()) == ["a", "d/b", "d/e/c"]


def test_source_column(spark, folder):
    path = put(folder, "a b.txt", "x\ny\n")
    got = read_raw(spark, path, with_source=True).select("data", "source.*").collect()
    assert [(r.data, r.offset, r.total) for r in got] == [("x", 0, 4), ("y", 0, 4)]
    assert with_source(spark.read.text(path)).columns == ["value", "source"]
    put(folder / "j", "x", '{"source":1}')
    with pytest.raises(ValueError):
        read_ldjson(spark, str(folder / "j"), "source int", with_source=True)
    df = read_ldjson(spark, str(folder / "j"), "source int", with_source="origin")
    assert df.columns == ["source", "origin"]


@pytest.mark.parametrize("delimiter", ["\n", "||", "\r\n\f", "é"])
def test_split_size_changes_nothing(spark, folder, delimiter):
    rng = random.Random(7)
    lines = ["".join(rng.choice("aé漢😀|\r ") for _ in range(rng.randint(0, 90))) for _ in range(2000)]
    lines = [line.replace(delimiter, "").rstrip("|\r") + "." for line in lines]
    path = put(folder, "x", delimiter.join(lines) + delimiter)
    for size in (1024, 65536, None):
        df = read_raw(spark, path, delimiter, size=size)
        assert [r.data for r in df.collect()] == lines
    assert read_raw(spark, path, delimiter, size=1024).rdd.getNumPartitions() > 20


def test_sized_read_belongs_to_the_callers_session(spark, folder):
    path = put(folder, "x", "a\n" * 1000)
    read_raw(spark, path, size=100).createOrReplaceTempView("sized_lines")
    assert spark.sql("select count(*) c from sized_lines").first().c == 1000


@pytest.mark.parametrize("codec", ["gzip", "lz4"])
def test_codec_comes_from_the_setting(spark, folder, codec):
    text = "".join(f'{{"n":{i},"t":"é{i}"}}\n' for i in range(5000))
    packed = gzip.compress(text.encode()) if codec == "gzip" else lz4(text)
    for name in ("one.gz", "two.bin", "three", "z", "gz", "a.ggz", "x.txt"):
        put(folder, name, packed)
    if codec == "lz4":
        os.rename(folder / "one.gz", folder / "one.lz4")
    df = read_ldjson(spark, str(folder), "n bigint, t string", compression=codec, with_source=True)
    counts = {r.f: r.c for r in df.groupBy(F.element_at(F.split("source.path", "/"), -1).alias("f")).agg(F.count("n").alias("c")).collect()}
    assert len(counts) == 7 and set(counts.values()) == {5000}
    assert df.where(F.concat(F.lit("é"), "n") != F.col("t")).count() == 0


def test_concatenated_members(spark, folder):
    put(folder, "g", gzip.compress(b"a\nb") + gzip.compress(b"c\nd\n"))
    assert [r.data for r in read_raw(spark, str(folder / "g"), compression="gzip").collect()] == ["a", "bc", "d"]
    put(folder, "l", lz4("a\nb") + lz4("c\nd\n"))
    assert [r.data for r in read_raw(spark, str(folder / "l"), compression="lz4").collect()] == ["a", "bc", "d"]


def test_decoder_chunks():
    from millrace.sources.codecs import line_arrays

    rng = random.Random(3)
    for delimiter in (b"\n", b"ab", b"aa", b"\r\n\x0c"):
        for _ in range(300):
            data = bytes(rng.choice(b"ab\r\n\x0cxy") for _ in range(rng.randint(0, 40)))
            cuts = sorted(rng.randint(0, len(data)) for _ in range(rng.randint(0, 6)))
            chunks = [data[i:j] for i, j in zip([0, *cuts], [*cuts, len(data)])]
            expected = data.split(delimiter)
            if expected[-1] == b"":
                expected.pop()
            got = [x.encode() for array in line_arrays(iter(chunks), delimiter) for x in array.to_pylist()]
            assert got == expected


def test_broken_utf8_in_compressed_files(spark, folder):
    put(folder, "x", lz4(b"ok\n\xff\xfe\n"))
    assert [r.data for r in read_raw(spark, str(folder), compression="lz4").collect()] == ["ok", "\ufffd\ufffd"]


def test_plans_parse_once_and_stay_narrow(spark, folder):
    path = put(folder, "x", '{"a":1,"b":2}\n')
    for on_reject in ("throw", "none"):
        plan = read_ldjson(spark, path, "a bigint, b bigint", on_reject=on_reject)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1 and "Exchange" not in plan
    path = put(folder / "c", "x", "1,2\n")
    plan = read_csv(spark, path, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    # two branches of one CASE inside the generator; a line takes one of them
    assert [line.count("from_csv") for line in plan.splitlines() if "from_csv" in line][0] <= 2
    assert plan.count("Generate") == 1 and "Exchange" not in plan
    assert "from_csv" not in plan.split("Generate")[0]


def test_native_scan_is_optional(spark, folder):
    path = put(folder, "x", '{"a":1,"b":2}\n')
    df = read_ldjson(spark, path, "a bigint, b bigint", strict=False, fields=["a"])
    assert rows(df) == [{"a": 1}]
    assert "ReadSchema: struct<a:bigint>" in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(OptionError):
        read_ldjson(spark, path, "a bigint", strict=False, on_reject="none")


def test_check_source(spark, folder):
    with pytest.raises(SourceError):
        check_source(spark, str(folder / "none"))
    with pytest.raises(SourceError):
        check_source(spark, str(folder))
    put(folder, "d/x", "1")
    check_source(spark, str(folder / "d"))
    with pytest.raises(SourceError):
        check_source(spark, str(folder / "d" / "x"))
    os.symlink(folder / "d", folder / "link")
    with pytest.raises(SourceError):
        check_source(spark, str(folder / "link"))
    with pytest.raises(SourceError):
        file_reader(spark, {"path": str(folder / "none"), "format": "raw"})
    job = {"path": str(folder / "d"), "format": "raw", "size": 750, "_name": "file_reader_api"}
    assert file_reader(spark, job).count() == 1


def test_files_that_a_scan_would_leave_out_are_named(spark, folder):
    put(folder, "d/x", "1\n")
    put(folder, "d/sub/_q.json", "1\n")
    put(folder, "plain/x.lz4", "1\n")
    for name, found in (("d", "sub/_q.json"), ("plain", "x.lz4")):
        with pytest.raises(SourceError, match=found):
            read_ldjson(spark, str(folder / name), "a int", strict=False)
    assert read_raw(spark, str(folder / "d")).count() == 2 and read_raw(spark, str(folder / "plain")).count() == 1
    assert read_raw(spark, str(folder / "d"), check_names=False).count() == 1
    put(folder, "ok/_SUCCESS", "")
    put(folder, "ok/x", "1\n")
    assert read_raw(spark, str(folder / "ok")).count() == 1


def test_values_beyond_the_fields(spark, folder):
    path = put(folder, "x", '1,2,3\n4,5,\n6,"7,8"\n9,10,"x,y"\n11,12, ,\n13\n14,,15\n16,17,""\n')
    good, bad = read_csv(spark, path, ["a", "b"], rejects=True)
    assert [tuple(r) for r in good.collect()] == [("4", "5"), ("6", "7,8"), ("11", "12"), ("13", None)]
    assert [r.record for r in bad.collect()] == ["1,2,3", '9,10,"x,y"', "14,,15", '16,17,""']
    assert read_csv(spark, path, ["a", "b"], surplus="cut").count() == 8
    with pytest.raises(Exception, match="bad record: 1,2,3"):
        read_csv(spark, path, ["a", "b"]).collect()
    assert read_csv(spark, path, ["a", "b"], on_reject="none", ignore_empty=False).count() == 2


def test_names_that_need_quotes(spark, folder):
    path = put(folder, "x", '[{"@timestamp":1,"user-agent":{"a b":"c"}},{"@timestamp":"no"}]')
    schema = T.StructType([T.StructField("@timestamp", T.LongType()), T.StructField("user-agent", T.StructType([T.StructField("a b", T.StringType())]))])
    good, bad = read_json(spark, path, schema, rejects=True, size=1000)
    assert rows(good) == [{"@timestamp": 1, "user-agent": {"a b": "c"}}] and bad.count() == 1


def test_only_named_fields_are_parsed(spark, folder):
    path = put(folder, "x", '{"a":1,"b":"no number"}\n{"b":2}\n{"a":3,"b":}\n')
    good, bad = read_ldjson(spark, path, "b int, a int", fields=["a", "zz", "a"], rejects=True)
    assert rows(good) == [{"a": 1}, {"a": None}] and [r.record for r in bad.collect()] == ['{"a":3,"b":}']
    assert read_ldjson(spark, path, "b int, a int", on_reject="none").count() == 1


def test_real_paths(spark, folder):
    put(folder, "sp ace/a b%+.txt", "1\n")
    path = read_raw(spark, str(folder), with_source=True).select("source.path").first()[0]
    assert path.endswith("/sp ace/a b%+.txt")
    assert file_inventory(spark, str(folder)).first().path == path


def test_slices_of_a_file(spark, folder):
    text = "".join(json.dumps({"n": i, "pad": "x" * 320}) + "\n" for i in range(50))[:16820]
    path = put(folder, "lines.txt", text + " " * (16820 - len(text)))
    options = ReadOptions(path=path, format="raw", size=750)
    assert read(spark, options).rdd.getNumPartitions() == 23


def test_inventory(spark, folder):
    for name in ("bar", "bad", "baz", "foo", "d/x", "d/y"):
        put(folder, name, name)
    for name in ("_x/a", ".hid", "c/_q"):
        put(folder / "all", name, "" if name == ".hid" else name)
    assert {(r.key, r["size"], r.readable) for r in file_inventory(spark, str(folder / "all")).collect()} == {
        ("_x/a", 4, True), (".hid", 0, False), ("c/_q", 4, True)
    }
    every = file_inventory(spark, str(folder)).where("not startswith(key, 'all/')")
    assert sorted(r.key for r in every.collect()) == ["bad", "bar", "baz", "d/x", "d/y", "foo"]
    assert {r.key: r["size"] for r in every.collect()}["d/x"] == 3
    assert file_inventory(spark, str(folder), prefix="ba").count() == 3
    assert file_inventory(spark, str(folder), start_after="bar").count() == 4
    assert every.where("modified > timestamp'2020-01-01'").count() == 6
    objects = every.select(F.concat(F.lit("bucket/"), "key").alias("object"), "size", "readable")
    summary = {(r.bucket, r.prefix): (r.files, r.bytes) for r in inventory_summary(objects).collect()}
    assert summary == {("bucket", ""): (4, 12), ("bucket", "d/"): (2, 6)}


def test_inventory_in_rounds(spark, folder, monkeypatch):
    monkeypatch.setattr("millrace.sources.inventory._LOOKED_AT", 100)
    monkeypatch.setattr("millrace.sources.inventory._ROWS", 64)
    want = {}
    for i in range(700):
        name = ("flat/" if i < 400 else "/".join(str(i % 7) * (i % 5 + 1)) + "/") + f"{'_' if i % 11 == 0 else ''}f{i}"
        put(folder, name, "x" * (i % 4))
        want[name] = i % 4
    (folder / "empty" / "deep").mkdir(parents=True)
    found = file_inventory(spark, str(folder))
    assert {r.key: r["size"] for r in found.collect()} == want and found.rdd.getNumPartitions() == 7
    with pytest.raises(SourceError):
        file_inventory(spark, str(folder / "none"))
    assert file_inventory(spark, str(folder / "empty")).count() == 0


def test_reasons_of_rejects(spark, folder):
    put(folder, "l/x", '{"a":1}\n{"a":}\n\n{"a":2} tail\n[1]\n{"a":"no"}\nNaN\n"s"\n')
    good, bad = read_ldjson(spark, str(folder / "l"), "a int", rejects="reasons")
    assert good.count() == 1 and bad.columns == ["record", "path", "reason"]
    assert {r.record: r.reason for r in bad.collect()} == {
        '{"a":}': "syntax", "": "blank", '{"a":2} tail': "text after the record", "[1]": "no object", '{"a":"no"}': "type", "NaN": "syntax", '"s"': "no object"
    }
    put(folder, "c/x", 'a,b\n1,2\n,\n"1,2\n1,2,3\n1\n')
    _, bad = read_csv(spark, str(folder / "c"), ["a", "b"], rejects="reasons", check_width=True)
    assert {r.record: r.reason for r in bad.collect()} == {",": "no value", '"1,2': "open quote", "1,2,3": "more cells than fields", "1": "fewer cells than fields"}


def test_log_shows_bad_records(spark, folder, caplog):
    path = put(folder, "x", "".join(f'{{"a":{i}}}\nbroken {i} {"y" * 900}\n' for i in range(300)))
    with caplog.at_level("ERROR", logger="millrace"):
        assert read_ldjson(spark, path, "a int", on_reject="log").count() == 300
        for _ in range(50):
            if caplog.records:
                break
            time.sleep(0.1)
    text = caplog.text
    assert "300 bad records of 600" in text and 5 <= text.count("broken ") <= 10 and len(text) < 6000
