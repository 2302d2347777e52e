import json

import pytest
from pyspark.sql import functions as F

from millrace import (
    is_readable_path,
    is_valid_bucket_name,
    object_uri,
    parse_object_path,
    project_fields,
    render_csv,
    render_ldjson,
    render_raw,
    render_tsv,
)
from millrace.functions import plain_number, trim_cell
from millrace.functions.text import WHITE_SPACE


def column_of(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


PATHS = {
    "data": ("data", ""),
    "/data": ("data", ""),
    "data/": ("data", ""),
    "/data/": ("data", ""),
    "data/export": ("data", "export/"),
    "/data/export": ("data", "export/"),
    "data/export/": ("data", "export/"),
    "/data/export/": ("data", "export/"),
    "data/a//b/c.txt": ("data", "a/b/c.txt/"),
    "data//b": ("data", ""),
    "data/a/./b/../c": ("data", "a/c/"),
    "data/..": ("data", "../"),
    "data/a/..": ("data", "./"),
    "data/../../x": ("data", "../../x/"),
    "data/a/...": ("data", "a/.../"),
}


def test_parse_object_path(spark):
    out = column_of(spark, [*PATHS, None], parse_object_path)
    assert [None if o is None else tuple(o) for o in out] == [*PATHS.values(), None]


@pytest.mark.parametrize("path", [p for p in PATHS if ".." not in p])
def test_object_uri_agrees(path):
    bucket, prefix = PATHS[path]
    assert object_uri(path) == f"s3a://{bucket}/{prefix}"


def test_bucket_names(spark):
    good = ["ice-cream", "k2m", "x.y.z", "9qq", "a" * 63]
    bad = ["Ice-cream", "10.20.30.40", "zz", "a" * 64, "-front", "end-.", "a..b", "a.-b", "a-.b", "k2m\n", "", None]
    assert column_of(spark, good, is_valid_bucket_name) == [True] * len(good)
    assert column_of(spark, bad, is_valid_bucket_name) == [False] * len(bad)


def test_readable_paths(spark):
    paths = ["file.txt", "some/path/file.txt", "some/.private/file.txt", ".x", "a.b/c.d", "a/../b", None]
    assert column_of(spark, paths, is_readable_path) == [True, True, False, False, True, False, False]


def test_trim_every_space(spark):
    values = [f"{space}a{space}b{space}{space}" for space in WHITE_SPACE] + ["plain", "", "  ", None]
    expected = [f"a{space}b" for space in WHITE_SPACE] + ["plain", "", "", None]
    assert column_of(spark, values, trim_cell) == expected


def test_plain_numbers(spark):
    numbers = {
        42.0: "42", -0.0: "0", 0.5: "0.5", 1234.5: "1234.5", 12345678.0: "12345678",
        1.2345678e7: "12345678", 123456789.125: "123456789.125", 1e20: "100000000000000000000",
        1e21: "1e+21", 1.5e300: "1.5e+300", 0.001: "0.001", 0.0001234: "0.0001234",
        1e-6: "0.000001", 1.5e-7: "1.5e-7", -2.5e-9: "-2.5e-9", 100.0: "100", -1e7: "-10000000",
    }
    assert column_of(spark, list(numbers), plain_number, "double") == list(numbers.values())


def test_plain_floats(spark):
    numbers = {0.1: "0.1", 1e-4: "0.0001", 16777216.0: "16777216", 3.0: "3"}
    assert column_of(spark, list(numbers), plain_number, "float") == list(numbers.values())


def lines(df):
    return [row.value for row in df.collect()]


@pytest.fixture
def data(spark):
    rows = [(42, "kettle", 55), (43, "lamp", 56), (44, "rope", 57)]
    return spark.createDataFrame(rows, "code long, item string, stock long").coalesce(1)


def test_csv_lines(data):
    assert lines(render_csv(data, ["item", "code"])) == [
        '"kettle",42', '"lamp",43', '"rope",44',
    ]
    assert lines(render_csv(data))[0] == '42,"kettle",55'
    assert lines(render_csv(data, separator="^"))[1] == '43^"lamp"^56'
    assert lines(render_tsv(data))[2] == '44\t"rope"\t57'
    assert lines(render_csv(data, ["field9", "code"]))[0] == ",42"


def test_csv_nested_and_empty(spark):
    one = spark.sql("select struct(22 as subcode, 44 as substock) as code, 66 as stock")
    two = spark.sql("select array(struct(22 as subcode, 44 as substock)) as code, 66 as stock")
    assert lines(render_csv(one, ["stock", "code"])) == ['66,"{""subcode"":22,""substock"":44}"']
    assert lines(render_csv(two, ["stock", "code"])) == ['66,"[{""subcode"":22,""substock"":44}]"']
    gaps = spark.createDataFrame([(None, None), ("a", None), (None, 1)], "x string, y long").coalesce(1)
    assert lines(render_csv(gaps)) == ['"a",', ",1"]
    kinds = spark.sql(
        "select true as b, 1.50BD as d, 901.0D as f, 'say \"hi\"' as s, date'2020-01-02' as day,"
        " timestamp'2020-01-02 03:04:05' as ts, X'0102' as bin"
    )
    assert lines(render_csv(kinds)) == [
        'true,1.50,901,"say ""hi""","2020-01-02","2020-01-02T03:04:05.000000Z","AQI="'
    ]


def test_csv_line_break_can_be_refused(spark):
    df = spark.createDataFrame([("a\nb",)], "x string")
    assert lines(render_csv(df)) == ['"a\nb"']
    with pytest.raises(Exception, match="line delimiter inside"):
        render_csv(df, forbid="\n").collect()


def test_ldjson_lines(data, spark):
    assert lines(render_ldjson(data))[0] == '{"code":42,"item":"kettle","stock":55}'
    assert lines(render_ldjson(data, ["item", "code", "field8"]))[0] == '{"item":"kettle","code":42}'
    gaps = spark.createDataFrame([(None, 1)], "x string, y long")
    assert lines(render_ldjson(gaps)) == ['{"y":1}']
    assert lines(render_ldjson(gaps, keep_nulls=True)) == ['{"x":null,"y":1}']
    odd = spark.sql("select double('NaN') as a, double('Infinity') as b, 1.5D as c, array(1D, double('NaN')) as d")
    assert lines(render_ldjson(odd)) == ['{"c":1.5,"d":[1.0,null]}']


def test_fields_at_every_level(spark):
    df = spark.sql(
        "select 66 as stock, array(named_struct('substock', 44, 'subcode', 22, 'gone', 1)) as code,"
        " map('gone', 1, 'subcode', 2) as m, named_struct('x', 1) as s, named_struct('gone', 1) as substock"
    )
    shown = project_fields(df, ["s", "code", "subcode", "substock", "m", "code"])
    assert json.loads(lines(render_ldjson(shown))[0]) == {
        "s": {}, "code": [{"subcode": 22, "substock": 44}], "substock": {}, "m": {"subcode": 2},
    }
    text = lines(render_ldjson(df, ["stock", "code", "subcode", "substock"]))[0]
    assert text == '{"stock":66,"code":[{"subcode":22,"substock":44}],"substock":{}}'


def test_raw_lines(spark):
    df = spark.createDataFrame([("line one", 1), (None, 2)], "data string, x long").coalesce(1)
    assert lines(render_raw(df)) == ["line one", ""]
    with pytest.raises(ValueError):
        render_raw(df.select("x"))


def test_variant_records(spark):
    """Records of different shapes in one frame."""
    texts = [
        '{"code":{"subcode":22,"substock":44},"stock":66}',
        '{"code":[{"subcode":22,"substock":44}],"stock":66}',
        '{"code":"say \\"hi\\"","stock":null}',
        '{"code":1.5}',
        '{"other":true}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(F.parse_json("t").alias("record"))
    assert [json.loads(t) for t in lines(render_ldjson(df))] == [json.loads(t) for t in texts]
    assert lines(render_csv(df, ["stock", "code"])) == [
        '66,"{""subcode"":22,""substock"":44}"',
        '66,"[{""subcode"":22,""substock"":44}]"',
        ',"say ""hi"""',
        ",1.5",
    ]
    with pytest.raises(ValueError):
        render_csv(df)
    with pytest.raises(TypeError):
        render_ldjson(df, ["record"])


def test_plain_numbers_in_json(spark):
    kinds = "id int, d double, f float, nested array<map<string,double>>, s struct<x:double,t:string>, text string"
    rows = [
        (1, 42.0, 0.5, [{"a": 0.1, "b": -0.0}], (1e21, '"<1.0>"'), "1.0"),
        (2, -1.5e-7, 3.0, [{"a": 1e10}], (123456789.25, None), ".0"),
        (3, None, float("nan"), [None, {"a": float("inf")}], None, None),
        (4, 0.001, 1e7, [], (0.0009, "x"), "42.0,"),
    ]
    df = spark.createDataFrame(rows, kinds)
    want = [
        r'{"id":1,"d":42,"f":0.5,"nested":[{"a":0.1,"b":0}],"s":{"x":1e+21,"t":"\"<1.0>\""},"text":"1.0"}',
        '{"id":2,"d":-1.5e-7,"f":3,"nested":[{"a":10000000000}],"s":{"x":123456789.25},"text":".0"}',
        '{"id":3,"nested":[null,{"a":null}]}',
        '{"id":4,"d":0.001,"f":10000000,"nested":[],"s":{"x":0.0009,"t":"x"},"text":"42.0,"}',
    ]
    got = [r.value for r in render_ldjson(df, plain_numbers=True).orderBy(F.get_json_object("value", "$.id")).collect()]
    assert [json.loads(x) for x in got] == [json.loads(x) for x in want] and [g.replace('{"a":null}', "{}") for g in got] == [w.replace('{"a":null}', "{}") for w in want]
    few = render_ldjson(df, ["d", "s", "x"], plain_numbers=True).first().value
    assert few == '{"d":42,"s":{"x":1e+21}}'


def test_allow_list_in_records_of_unknown_shape(spark):
    texts = ['{"b":{"a":1,"c":[{"a":2.0,"z":3},[{"z":1}],"x"]},"a":null,"z":0}', '{"z":1}', '{"c":"é\\"","a":1.5e-3,"b":[]}', '{"a":1e21,"b":12345678901234567890}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("r"))
    got = [r.value for r in render_ldjson(df, ["a", "c", "b", "a", "no"]).collect()]
    assert got == ['{"a":null,"b":{"a":1,"c":[{"a":2},[{}],"x"]}}', "{}", '{"a":0.0015,"c":"é\\"","b":[]}', '{"a":1e+21,"b":12345678901234567890}']
