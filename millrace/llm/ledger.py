"""Secret scans of versioned texts, with a ledger of the blobs and rule versions that were scanned before."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices
from millrace.session import Files, scratch_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost first and without overlap, from which those stay whose
    group ``group`` has ``least`` characters.  Whoever changes a rule raises its version: blobs are scanned anew.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds, in the order in which spans with one start are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds with a shape of their own: private keys, signed web tokens, tokens with a vendor's prefix, and
#: passwords in addresses.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("vendor", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]{1,256}:[A-Za-z0-9._~%!$&*+=-]{1,256}@"),
)
RULES = (*BASE_RULES, *MORE_RULES)

ENTRY = "blob binary, rules array<string>, spans array<struct<rule:string,start:long,end:long>>"


class Ledger:
    """A folder of runs; each is Parquet with a row for each blob: the rules it was scanned by, and their spans.

    A run counts from the moment Spark has marked it as whole, so a run that died leaves nothing behind.
    Runs only add; two that overlap in time may scan a blob twice, which changes no result.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = Files(spark, self.path)

    def runs(self) -> list[str]:
        if not self._files.exists(self.path):
            return []
        return sorted(p.rsplit("/", 1)[0] for p in self._files.glob(f"{self.path}/run-*/_SUCCESS"))

    def runs_in_order(self) -> list[str]:
        """The runs, the last one last."""
        return sorted(self.runs(), key=lambda run: int(run.rsplit("-", 2)[1]))

    def entries(self) -> DataFrame:
        runs = self.runs()
        return self.spark.read.schema(ENTRY).parquet(*runs) if runs else self.spark.createDataFrame([], ENTRY)

    def add(self, entries: DataFrame) -> None:
        entries.write.parquet(f"{self.path}/run-{time.time_ns()}-{uuid.uuid4().hex[:12]}")


def blob_of(text: Column) -> Column:
    """The address of a text, null as empty: its SHA-256, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _scan(blobs: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Ledger entries of blobs (blob, text, todo: the keys of the rules to scan by)."""
    rules = tuple(rules)
    spans_type = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        compiled = [(r.key, re.compile(r.pattern, re.ASCII), r.group, r.least) for r in rules]
        for batch in slices(batches, "text"):
            found = []
            for text, todo in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = []
                for key, pattern, group, least in compiled:
                    if key in todo:
                        spans += [{"rule": key, "start": m.start(), "end": m.end()} for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
                found.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, spans_type)], names=["blob", "rules", "spans"])

    return blobs.select("blob", "text", "todo").mapInArrow(scan, ENTRY)


def unseen(ledger: Ledger, texts: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """(blob, text, todo) of each different text that the ledger has not under all rules; todo are the missing ones.

    Copies are dropped before texts are shuffled, once, to meet what the ledger knows about their blob.
    """
    keys = F.array(*[F.lit(r.key) for r in rules])
    text = F.coalesce("text", F.lit(""))
    blobs = texts.select(blob_of(F.col("text")).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    known = ledger.entries().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
    met = blobs.join(known, "blob", "left")
    todo = F.array_except(keys, F.coalesce("known", F.array().cast("array<string>")))
    return met.select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan_versions(ledger: Ledger, versions: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """All columns of ``versions`` with ``spans``: what the rules find in ``text``, one row per version.

    ``versions`` has a row for each historical version of a path; any columns beside ``text`` say which.  Equal
    texts are one blob, whatever their path, and a blob is scanned once for each version of a rule: in this
    call for what is new in the ledger, never again for the rest.  Findings are then joined back to all rows.
    Spans (kind, start, end) count code points, end exclusive, and are ordered by start, then as ``rules``
    lists the kinds.  Null and empty texts have none; repeated rows and null keys get their spans like others;
    an empty table gives no rows.  A column ``spans`` of the input is replaced.
    """
    rules = tuple(rules)
    ledger.add(_scan(unseen(ledger, versions, rules), rules))
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    # entries may hold rules that this call does not ask for; runs that overlapped may hold a blob twice
    hits = ledger.entries().select("blob", F.explode("spans").alias("s")).where(F.col("s.rule").isin([r.key for r in rules]))
    ranked = F.struct("s.start", place[F.col("s.rule")].alias("place"), "s.end", F.substring_index("s.rule", "@", 1).alias("kind"))
    found = hits.groupBy("blob").agg(F.array_sort(F.collect_set(ranked)).alias("ranked"))
    spans = F.transform("ranked", lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    found = found.select(F.col("blob").alias(key := f"blob_{uuid.uuid4().hex}"), spans.alias(own := f"spans_{uuid.uuid4().hex}"))
    rows = versions.drop("spans")
    rows = rows.withColumn(key, blob_of(F.col("text"))).join(found, key, "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.select(*[F.col(f"`{c}`") for c in versions.drop("spans").columns], F.coalesce(own, none).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def secret_digest(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """Counts and spans of secrets of every row of ``docs`` (doc_id, text); other columns are ignored.

    Without a ledger, a new one is begun.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, scratch_folder(spark, "ledger"))
    found = scan_versions(ledger, docs.select("doc_id", "text")).drop("text")
    kinds = [r.kind for r in BASE_RULES]
    of_kind = F.transform("spans", lambda s: s.kind)
    counts = [F.size(F.filter(of_kind, F.lit(k).eqNullSafe)).cast("long").alias(f"n_{k}") for k in kinds]
    base = F.filter("spans", lambda s: s.kind.isin(kinds))
    return found.select("doc_id", *counts, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


def secrets_sql(rules: Iterable[Rule] = RULES) -> str:
    """The digest in SQL: the starts of matches are the summed lengths of what is between and before them."""
    parts = []
    for place, rule in enumerate(rules):
        pattern = rule.pattern
        for fold in re.findall(r"\(\?i:(.*?)\)", pattern):
            pattern = pattern.replace(f"(?i:{fold})", "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in fold))
        pattern = pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_row, '{rule.kind}' AS kind, {place} AS place, start, start + length(hit) AS stop
  FROM (SELECT doc_row, unnest(hits) AS hit, unnest(held) AS held, unnest(list_transform(range(1, len(hits) + 1), lambda i:
               list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))) AS start
        FROM (SELECT doc_row, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {rule.group}) AS held,
                     string_split_regex(text, '{pattern}') AS gaps FROM docs))
  WHERE length(held) >= {rule.least}""")
    kinds = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"coalesce(sum((kind = '{r.kind}')::int), 0)::bigint AS n_{r.kind}" for r in BASE_RULES)
    spell = "string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' ORDER BY start, place)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS doc_row, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(parts)})
SELECT any_value(doc_id) AS doc_id, {counts}, sha256(coalesce({spell} FILTER (kind IN ({kinds})), '')) AS base_sha256, coalesce({spell}, '') AS spans
FROM docs LEFT JOIN spans USING (doc_row) GROUP BY doc_row
"""
