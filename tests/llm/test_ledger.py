"""The secret ledger: plain scans, and what is scanned again."""

import collections
import dataclasses
import hashlib
import re

from pyspark.sql import functions as F

from millrace.llm import entry, ledger

SF = "/root/testdata/sf0.01"

BASE = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def plain_base(text):
    found = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                found.append((m.start(), place, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def digest_of(doc_id, text):
    spans = plain_base(text)
    count = collections.Counter(kind for kind, _, _ in spans)
    spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return doc_id, count["assign"], count["access"], count["hex"], hashlib.sha256(spelled.encode()).hexdigest()


def check(rows, got):
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    found = got.collect()
    assert collections.Counter(tuple(r)[:5] for r in found) == collections.Counter(digest_of(*r) for r in rows)
    return found


def test_base_kinds_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert any(r.n_assign + r.n_access + r.n_hex for r in check(rows, entry.op12_secret_ledger(spark, SF)))


def test_odd_rows(spark, docs_of):
    aws, digits = "AKIA" + "Q7" * 8, "0123456789abcdef" * 2
    rows = [(1, None), (2, ""), (3, "secret=token: abcdefgh"), (4, f"é😀 Api_Key = '{digits}' {aws}"), (None, f"{aws}AKIA"), (5, f"x{aws[:-1]}")]
    rows += [(6, f"PASSWD:abcde\ntoKen\"  :  \"ab.cd/ef=\" ſecret=abcdefghi {digits[:23]} {digits[:24]}")] * 3 + [(k, "password=hunter22 same") for k in range(300, 900)]
    rows += [(7, "apikey==abcdef -----BEGIN RSA PRIVATE KEY----- https://bob:pw%21x@host/ ghp_" + "a1B2" * 9), (8, ("word " * 20 + "token=longtextvalue ") * 3000)]
    found = {r.doc_id: r.spans for r in check(rows, ledger.secret_digest(docs_of(rows)))}
    assert found[7] == "assign:0:14,pem:15:46,url:47:66,vendor:72:112"
    assert ledger.secret_digest(docs_of([])).collect() == []


def test_only_unseen_pairs_are_scanned(spark, folder):
    book = ledger.Ledger(spark, str(folder / "book"))
    names = "path string, version int, text string, spans string, _blob int, blob int"

    def scan(rows, rules=ledger.RULES):
        got = ledger.scan_versions(book, spark.createDataFrame([(p, v, t, "x", 1, 2) for p, v, t in rows], names), rules)
        assert got.columns == ["path", "version", "text", "_blob", "blob", "spans"]
        return collections.Counter((r.path, r.version, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got.collect())

    def last_run():
        return sorted((len(r.rules), len(r.spans)) for r in spark.read.parquet(book.runs_in_order()[-1]).collect())

    one, two = "password=abcdef12", "token: 0123456789"
    hit = (("assign", 0, 17),)
    assert scan([("a", 1, one), ("b", 1, one), ("c", 1, "clean"), ("c", 2, None)]) == {("a", 1, hit): 1, ("b", 1, hit): 1, ("c", 1, ()): 1, ("c", 2, ()): 1}
    assert last_run() == [(7, 0), (7, 0), (7, 1)]
    assert scan([("d", 1, one), ("a", 2, two), ("e", 1, "")]) == {("d", 1, hit): 1, ("a", 2, hit): 1, ("e", 1, ()): 1}
    assert last_run() == [(7, 1)]
    raised = (dataclasses.replace(ledger.RULES[0], least=9, version=2), *ledger.RULES[1:])
    assert scan([("a", 1, one), ("a", 2, two)], raised) == {("a", 1, ()): 1, ("a", 2, hit): 1}
    assert last_run() == [(1, 0), (1, 1)]
    assert scan([("a", 1, one), ("a", 2, two)], raised[1:]) == {("a", 1, ()): 1, ("a", 2, ()): 1} and last_run() == []
    assert scan([("a", 1, one)]) == {("a", 1, hit): 1}
    assert scan([]) == {}


def test_a_run_that_died_is_no_run(spark, folder):
    book = ledger.Ledger(spark, str(folder / "book"))
    rows = spark.createDataFrame([(1, "secret = abcdefgh")], "doc_id long, text string")
    dead = folder / "book" / "run-000"
    spark.range(3).select(F.lit(b"x").alias("blob")).write.parquet(str(dead))
    (dead / "_SUCCESS").unlink()
    assert [r.n_assign for r in ledger.secret_digest(rows, book).collect()] == [1] and len(book.runs()) == 1
