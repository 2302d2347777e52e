"""The source for files that Spark's scans do not open as they are."""

import gzip
import json
import pathlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace import (
    ReadOptions,
    SourceError,
    WriteOptions,
    export,
    export_stream,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    read_stream,
)
from millrace.sources import files, names


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def lz4(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as out:
        out.write(data)
    return sink.getvalue().to_pybytes()


def test_which_names_are_data_and_which_are_streamed():
    assert names.is_data("a/_b/c") and not names.is_data("a/.b/c") and not names.is_data("_SUCCESS") and not names.is_data("x/_temporary/0/part")
    assert names.is_hidden("_a/b") and names.is_hidden("a/b._COPYING_") and not names.is_hidden("_k=1/b") and not names.is_hidden("_metadata_x/a")
    streamed = names.is_streamed
    assert [streamed(n, 1, "none") for n in ("a", "a.gz", "a.lz4", "_a", ".a.gz", "a.gz.txt")] == [False, True, True, True, False, False]
    big = names.LARGE + 1
    assert [streamed(n, big, "gzip") for n in ("a.gz", "a", "_a.gz")] == [False, True, True]
    assert streamed("a", big, "lz4") and not streamed("a", 9, "lz4") and not streamed("a", big, "none")


def test_all_names_are_read(spark, folder):
    put(folder, "a.txt", "a1\na2\n"), put(folder, "_x.ldjson", "x1\nx2\nx3"), put(folder, "sub/_deep/y.lz4", "y1\n\ny2\n")
    put(folder, "plain.gz", "plain\n"), put(folder, "real.gz", gzip.compress(b"w1\nw2\n") + gzip.compress(b"w3")), put(folder, "real.lz4", lz4(b"l1\nl2"))
    put(folder, ".hid/n", "no\n"), put(folder, "_SUCCESS", ""), put(folder, "b._COPYING_", "c\n"), put(folder, "_empty", "")
    rows = read_raw(spark, str(folder), with_source=True).collect()
    want = {"a.txt": ["a1", "a2"], "_x.ldjson": ["x1", "x2", "x3"], "y.lz4": ["y1", "", "y2"], "plain.gz": ["plain"], "real.gz": ["w1", "w2", "w3"], "real.lz4": ["l1", "l2"], "b._COPYING_": ["c"]}
    assert sorted((pathlib.Path(r.source.path).name, r.data) for r in rows) == sorted((n, x) for n, xs in want.items() for x in xs)
    assert all(r.source.path.startswith(f"file://{folder}/") for r in rows)
    assert {r.source.total for r in rows if r.source.path.endswith("_x.ldjson")} == {8}
    put(folder, "two/_x", "1\n"), put(folder, "two/x", "2\n")
    assert read_raw(spark, str(folder / "two"), check_names=False).count() == 1
    assert read_raw(spark, str(folder / "_x.ldjson")).count() == 3
    assert read_raw(spark, [str(folder / "sub"), str(folder / "a.txt")]).count() == 5


@pytest.mark.parametrize("mark", ["\n", "\r\n\f", "aab", "aa"])
def test_every_split_finds_its_lines(mark):
    rng = random.Random(len(mark))
    for total in (0, 1, 2, 7, 60, 400):
        text = "".join(rng.choice(["a", "b", "\n", "\r", mark, mark]) for _ in range(total)).encode()
        lines = text.split(mark.encode())
        lines = lines[:-1] if not lines[-1] else lines
        store = pathlib.Path("/tmp") / f"split-{len(mark)}-{total}-{rng.random()}"
        store.write_bytes(text)
        for split in (1, 2, 3, 10, 1000):
            settings = files.Settings((str(store),), "none", mark.encode(), False, split)
            parts = settings.planned((root, found) for root in settings.roots for found in files.listed(root))
            got = [line for part in parts for batch in files.read_pieces(settings, part) for line in batch.column(0).to_pylist()]
            assert got == [line.decode() for line in lines], (mark, total, split)


def test_splits_are_planned_by_bytes():
    settings = files.Settings(("r",), "none", b"\n", False, 4 * files.OPEN_COST)
    many = [("r", files.Found(f"_{i}", 10, 0)) for i in range(1000)]
    parts = settings.planned([*many, ("r", files.Found("_big", 40 * files.OPEN_COST, 0)), ("r", files.Found("x.gz", 40 * files.OPEN_COST, 0))])
    sizes = [sum(end - start for _, _, start, end, _ in p.ranges) for p in parts]
    assert 200 <= len(parts) <= 300 and sorted(sizes)[-2] <= 4 * files.OPEN_COST and max(sizes) == 40 * files.OPEN_COST
    assert sum(sizes) == 80 * files.OPEN_COST + 10_000
    assert settings.planned([]) == []


@pytest.mark.parametrize("compression", ["gzip", "lz4"])
def test_large_coded_files_are_streamed(spark, folder, compression, monkeypatch):
    monkeypatch.setattr(names, "LARGE", 3000)
    monkeypatch.setattr("millrace.sources.lines.LARGE", 3000)
    coded = gzip.compress if compression == "gzip" else lz4
    lines = [f"{i * i * 7919 % 100003}" for i in range(40000)]
    put(folder, "many.bin", coded("\n".join(lines).encode())), put(folder, "few", coded(b"small\n")), put(folder, "_few", coded(b"hidden\n"))
    got = [r.data for r in read_raw(spark, str(folder), compression=compression).collect()]
    assert sorted(got) == sorted([*lines, "small", "hidden"])


def test_formats_and_rejects_of_streamed_files(spark, folder):
    put(folder, "l/_a.ldjson", '{"a":1}\n{"a":\n{"a":3}\n'), put(folder, "l/b.ldjson", '{"a":4}\n')
    good, bad = read_ldjson(spark, str(folder / "l"), "a int", rejects=True)
    assert sorted(r.a for r in good.collect()) == [1, 3, 4] and [(r.record, r.path) for r in bad.collect()] == [('{"a":', f"file://{folder}/l/_a.ldjson")]
    put(folder, "j/_a.json", '[{"a":1},{"a":2}]'), put(folder, "j/b.json.gz", '{"a":3}')
    assert sorted(r.a for r in read_json(spark, str(folder / "j"), "a int").collect()) == [1, 2, 3]
    put(folder, "c/_a.csv", "x,y\n1,2\n"), put(folder, "c/b.csv.zst", "3,4\n")
    assert sorted(map(tuple, read_csv(spark, str(folder / "c"), ["x", "y"]).collect())) == [("1", "2"), ("3", "4")]
    with pytest.raises(SourceError, match="_a.ldjson"):
        read_ldjson(spark, str(folder / "l"), "a int", strict=False)


def test_wrong_bytes_fail(spark, folder):
    put(folder, "_x", "no frame at all")
    for compression in ("gzip", "lz4"):
        with pytest.raises(Exception, match="(?i)gzip|lz4"):
            read_raw(spark, str(folder), compression=compression).collect()


def test_stream_sees_late_names_once(spark, folder):
    source, target, marks, log = (str(folder / n) for n in ("in", "out", "marks", "log"))
    options = ReadOptions(path=source, format="ldjson")

    def put_ids(name, ids):
        put(folder, f"in/{name}", "".join(json.dumps({"id": i}) + "\n" for i in ids))

    def run():
        df = read_stream(spark, options, "id bigint", every_name=log, with_source="origin")
        assert df.isStreaming and df.columns == ["id", "origin"]
        query = export_stream(df.select("id"), WriteOptions(target, "ldjson", id="s"), marks)
        query.awaitTermination()
        assert query.exception() is None
        return sorted(r.id for r in read_ldjson(spark, target, "id bigint").collect())

    put_ids("a.json", range(10))
    assert run() == list(range(10))
    put_ids("_late", range(10, 20)), put_ids("b.lz4", range(20, 25)), put_ids("c.json", range(25, 30))
    assert run() == list(range(30))
    assert run() == list(range(30))
    put_ids("sub/_x.ldjson", [30])
    assert run() == list(range(31))
    assert [len(files.Log(log).entry(n)) for n in files.Log(log).numbers()] == [2, 1]
    with pytest.raises(SourceError, match="_late"):
        read_stream(spark, options, "id bigint")


def test_a_batch_that_runs_again_holds_the_same_files(folder):
    root, log = str(folder / "in"), str(folder / "log")
    put(folder, "in/_a", "1\n"), put(folder, "in/_b", "2\n3")
    settings = files.Settings((root,), "none", b"\n", False, 100)
    first = files.FileStream(settings, log)
    offsets = [first.initialOffset(), first.latestOffset()]
    put(folder, "in/_c", "4\n")
    # the driver died before Spark noted the offset; the next one finds the entry and goes on
    second = files.FileStream(settings, log)
    offsets.append(second.latestOffset())
    assert [o["entry"] for o in offsets] == [0, 1, 2] and second.latestOffset() == offsets[2]

    def lines(reader, start, end):
        return sorted(x for part in reader.partitions(start, end) for batch in reader.read(part) for x in batch.column(0).to_pylist())

    assert lines(second, *offsets[:2]) == lines(first, *offsets[:2]) == ["1", "2", "3"]
    assert lines(second, offsets[1], offsets[2]) == ["4"] and lines(second, offsets[2], offsets[2]) == []


def test_large_folders_of_small_files(spark, folder):
    for i in range(300):
        put(folder, f"in/{i % 7}/_{i}", f"{i}\n")
    df = read_raw(spark, str(folder / "in"), size=100_000_000)
    assert sorted(int(r.data) for r in df.collect()) == list(range(300)) and df.rdd.getNumPartitions() < 20
    export(df, str(folder / "out"), "raw", files=1)
    assert read_raw(spark, str(folder / "out")).select(F.sum(F.col("data").cast("int"))).first()[0] == 300 * 299 // 2
