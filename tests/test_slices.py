"""Runs of jobs and the files they replace; files that tasks name themselves."""

import gzip
import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace import OptionError, Sender, WriteOptions, export, export_routed, read_ldjson, send
from millrace.plans import direct
from millrace.plans.slices import Slice, SliceLog, superseded
from millrace.session import Files


def ids(spark, path):
    return sorted(r.id for r in read_ldjson(spark, str(path), "id bigint").collect())


def numbers(folder, id="w"):
    return sorted(int(p.name.split(".")[1]) for p in folder.rglob(f"{id}.*.ldjson*") if not any(x.startswith(".") for x in p.relative_to(folder).parts))


@pytest.mark.parametrize("naming", ["exact", "direct"])
def test_slices_go_on_and_a_rerun_replaces(spark, folder, naming):
    options = WriteOptions(str(folder), "ldjson", id="w", naming=naming)
    first = Sender(options)
    assert [first.send(spark.range(a, a + 10, 1, 3)) for a in (0, 10, 20)] == [10, 10, 10]
    assert ids(spark, folder) == list(range(30)) and len(numbers(folder)) == 9
    if naming == "exact":
        assert numbers(folder) == list(range(9))
    again = Sender(options)
    again.send(spark.range(0, 15, 1, 2))
    assert ids(spark, folder) == list(range(15)) and len(numbers(folder)) == 2
    again.send(spark.range(15, 30, 1, 2))
    assert ids(spark, folder) == list(range(30))
    # calls without a sender are slices of the application
    export(spark.range(5), str(folder), "ldjson", id="w", naming=naming, job="other")
    export(spark.range(5, 9), str(folder), "ldjson", id="w", naming=naming, job="other")
    assert ids(spark, folder) == sorted([*range(30), *range(9)])
    Sender(options).send(spark.range(100, 102))
    assert ids(spark, folder) == [*range(9), 100, 101]
    export(spark.range(3), str(folder), "ldjson", id="w", naming=naming, replace=True)
    assert ids(spark, folder) == [0, 1, 2]


@pytest.mark.parametrize("naming", ["exact", "direct"])
def test_a_run_that_died_leaves_nothing(spark, folder, naming):
    options = WriteOptions(str(folder), "ldjson", id="w", naming=naming)
    (folder / "w.0.ldjson").write_text('{"id":-1}\n')  # no log knows it
    died = Sender(options)
    died.send(spark.range(5))
    log = SliceLog(Files(spark, str(folder)), str(folder), "w")
    done = log.entries()[-1]
    # it noted its next slice, wrote some files of it, and was gone
    log.note(Slice("w", died.run, files=("w.70.ldjson", "w.71.ldjson"), offset=done.offset, low=1 + done.last))
    for n in (70, 72):
        (folder / f"w.{done.last + n if naming == 'direct' else n - (n == 72)}.ldjson").write_text('{"id":7}\n')
    Sender(options).send(spark.range(50, 52))
    assert ids(spark, folder) == [-1, 50, 51] and len(log.entries()) == 1


@pytest.mark.parametrize("naming", ["exact", "direct"])
def test_a_slice_that_fails_is_no_slice(spark, folder, naming):
    options = WriteOptions(str(folder), "ldjson", id="w", naming=naming)
    sender = Sender(options)
    sender.send(spark.range(4))
    bad = spark.range(0, 100, 1, 8).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sender.send(bad)
    sender.send(spark.range(4, 6))
    assert ids(spark, folder) == list(range(6))


def test_what_a_slice_replaces():
    entries = [Slice("a", "1"), Slice("a", "2"), Slice("b", "1"), Slice("a", "1", batch=3), Slice("a", "2", batch=4)]
    assert superseded(entries, "a", "2", None) == entries[:1]
    assert superseded(entries, "a", "9", 3) == [entries[3]] and superseded(entries, "c", "1", None) == []


def test_direct_files_of_every_kind(spark, folder):
    df = spark.range(0, 10, 1, 2).select("id", F.col("id").cast("string").alias("name"))
    kinds = {"csv": "none", "tsv": "gzip", "json": "lz4", "ldjson": "gzip", "raw": "none"}
    for format, codec in kinds.items():
        rows = df.select(F.col("name").alias("data")) if format == "raw" else df
        send(rows, WriteOptions(str(folder / format), format, id="w", naming="direct", compression=codec, include_header=True, records_per_file=3, extension="x" if format == "raw" else None))
    ending = {"csv": ".csv", "tsv": ".tsv.gz", "json": ".json.lz4", "ldjson": ".ldjson.gz", "raw": ".x"}
    for format, codec in kinds.items():
        files = [p for p in (folder / format).iterdir() if p.is_file() and not p.name.startswith(".")]
        assert len(files) == 4 and all(re.fullmatch(r"w\.\d+" + re.escape(ending[format]), p.name) for p in files)
        bodies = [p.read_bytes() for p in files]
        if codec == "gzip":
            bodies = [gzip.decompress(b) for b in bodies]
        if codec == "lz4":
            bodies = [pa.CompressedInputStream(pa.BufferReader(b), "lz4").read() for b in bodies]
        if format in ("csv", "tsv"):
            assert all(b.splitlines()[0].startswith(b'"id"') and 2 <= len(b.splitlines()) <= 4 for b in bodies)
            found = [line for b in bodies for line in b.splitlines()[1:]]
        elif format == "json":
            found = [r["id"] for b in bodies for r in json.loads(b)]
        else:
            found = [line for b in bodies for line in b.splitlines()]
        assert len(found) == len(set(found)) == 10


@pytest.mark.parametrize("layout", ["plain", "hive"])
def test_direct_routes(spark, folder, layout):
    names = {0: "a", 1: "b/c", 2: None, 3: "", 4: "x=1"}
    to = F.element_at(F.create_map(*[F.lit(x) for k, v in names.items() for x in (k, v)]), (F.col("id") % 5).cast("int"))
    df = spark.range(0, 50, 1, 4).withColumn("to", to)
    for gather in (True, False):
        export_routed(df, str(folder / f"{gather}"), "ldjson", "to", naming="direct", layout=layout, gather_routes=gather)
        where = {}
        for p in (folder / f"{gather}").rglob("part.*.ldjson"):
            where.setdefault(str(p.parent.relative_to(folder / f"{gather}")), []).extend(json.loads(x)["id"] for x in p.read_text().splitlines())
        want = {".": [2, 3], "a": [0], "b/c": [1], "x=1": [4]} if layout == "plain" else {".": [2, 3], "to=a": [0], "to=b%2Fc": [1], "to=x%3D1": [4]}
        assert {k: sorted(v) for k, v in where.items()} == {k: sorted(i for i in range(50) if i % 5 in v) for k, v in want.items()}
    with pytest.raises(Exception, match="leaves the target"):
        export_routed(spark.range(1).withColumn("to", F.lit("../out")), str(folder / "bad"), "ldjson", "to", naming="direct", layout="plain")


def test_losers_are_removed_and_others_stay(folder):
    for n in (3, 8, 9, 10, 10 + direct.FURTHER, 12):
        (folder / f"w.{n}.csv").write_text("x")
    (folder / "v.9.csv").write_text("x"), (folder / "w.9.csv.gz").write_text("x")
    direct.remove_unlisted(str(folder), "w", ".csv", range(9, 12), {"w.10.csv"})
    assert sorted(p.name for p in folder.iterdir()) == ["v.9.csv", "w.10.csv", "w.12.csv", "w.3.csv", "w.8.csv", "w.9.csv.gz"]


def test_many_parts_are_not_moved(spark, folder, monkeypatch):
    moved = []
    monkeypatch.setattr(Files, "replace", lambda self, a, b, old=Files.replace: (moved.append(b), old(self, a, b)))
    assert send(spark.range(0, 400, 1, 200), WriteOptions(str(folder), "ldjson", id="w", naming="direct")) == 400
    assert len(numbers(folder)) == 200 and all(".slices/" in name for name in moved) and len(moved) == 2
    assert ids(spark, folder) == list(range(400))


def test_stream_batches_under_final_names(spark, folder):
    options = WriteOptions(str(folder), "ldjson", id="s", naming="direct")
    for batch, rows in ((0, 5), (1, 6), (2, 7), (2, 3), (3, 1)):
        send(spark.range(rows).withColumn("id", F.col("id") + 100 * batch), options, batch=batch)
    assert ids(spark, folder) == sorted([*range(5), *range(100, 106), *range(200, 203), 300])
    log = SliceLog(Files(spark, str(folder)), str(folder), "s")
    assert [e.batch for e in log.entries()] == [2, 3]


def test_layout_that_only_hadoop_cannot_write(spark, folder, monkeypatch):
    monkeypatch.setitem(send.__globals__, "_opens", lambda *_: False)
    with pytest.raises(OptionError):
        export_routed(spark.range(1).withColumn("to", F.lit("a")), str(folder), "ldjson", "to", naming="direct", layout="plain")


def test_names_stay_with_the_tasks(spark, folder):
    options = WriteOptions(str(folder), "ldjson", id="w", naming="direct", records_per_file=1)
    Sender(options).send(spark.range(0, 600, 1, 3))
    log = SliceLog(Files(spark, str(folder)), str(folder), "w")
    (entry,) = log.entries()
    assert entry.files == () and len(entry.numbers) == 3
    assert sorted(log.names(entry)) == sorted(p.name for p in folder.glob("w.*.ldjson")) and len(numbers(folder)) == 600
    assert (folder / ".w.slices" / entry.key).stat().st_size < 1000
    Sender(options).send(spark.range(5))
    assert ids(spark, folder) == [0, 1, 2, 3, 4] and len(numbers(folder)) == 5
    (entry,) = log.entries()
    assert len([p for p in (folder / ".w.slices").glob("*.files")]) == len(entry.numbers)
    # an export of the other kind finds them in the lists
    Sender(WriteOptions(str(folder), "ldjson", id="w")).send(spark.range(7, 9))
    assert ids(spark, folder) == [7, 8]


def test_attempts_without_a_message_are_removed(folder):
    (folder / ".w.slices").mkdir()
    (folder / "a").mkdir()
    for n in (7, 8, 9):
        (folder / f"w.{n}.csv").write_text("x"), (folder / "a" / f"w.{n + direct.FURTHER}.csv").write_text("x")
        if n < 9:
            (folder / ".w.slices" / f"k.{n}.files").write_text(f'"w.{n}.csv"\n')
    kind = dict(id="w", ending=".csv", compression="none", delimiter="\n", array=False, header=None, routed=False, route_prefix="")
    target = direct.Target(path=str(folder), records_per_file=1, bytes_per_file=None, offset=0, low=5, manifest=str(folder / ".w.slices" / "k.files"), **kind)
    direct.DirectWriter(target).commit([direct.Written(7, 2), direct.Written(None, 0), None])
    left = sorted(str(p.relative_to(folder)) for p in folder.rglob("*.csv"))
    assert left == [f"a/w.{7 + direct.FURTHER}.csv", f"a/w.{9 + direct.FURTHER}.csv", "w.7.csv", "w.9.csv"]
    assert json.loads((folder / ".w.slices" / "k.files").read_text()) == {"numbers": [7], "records": 2}
    assert not (folder / ".w.slices" / "k.8.files").exists()
