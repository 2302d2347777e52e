"""What happens to a record that cannot be parsed."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import Column, DataFrame, Observation, functions as F

from millrace.functions.project import column

log = logging.getLogger("millrace")


#: Bad records that the log shows, and characters of each.
SHOWN, SHOWN_CHARS = 10, 500


def _shown_records() -> list[Column]:
    """A few bad records: the smallest of those that share a remainder of their hash, so any tasks may add up."""
    share = F.pmod(F.xxhash64("value"), F.lit(SHOWN))
    return [F.min(F.when(~F.col("ok") & (share == k), F.left("value", F.lit(SHOWN_CHARS)))).alias(f"shown{k}") for k in range(SHOWN)]


def _report(observation: Observation, path: str) -> None:
    def wait() -> None:
        try:
            seen = observation.get
        except Exception:  # the session ended before the frame was used
            return
        if seen.get("rejected"):
            shown = [seen[f"shown{k}"] for k in range(SHOWN) if seen[f"shown{k}"] is not None]
            log.error("%d bad records of %d under %s, among them: %s", seen["rejected"], seen["read"], path, " | ".join(shown))

    threading.Thread(target=wait, daemon=True, name="millrace-rejects").start()


def source_name(with_source: bool | str) -> str | None:
    """``with_source`` is a flag or the name of the provenance column."""
    return "source" if with_source is True else (with_source or None)


def record_columns(parsed: DataFrame, source: str | None) -> list[Column]:
    names = parsed.schema["record"].dataType.names
    if source in names:
        raise ValueError(f"the records have a field {source!r}: name the provenance column differently")
    columns = [column("record").getField(name).alias(name) for name in names]
    return columns + ([F.col("source").alias(source)] if source else [])


def _refuse_or_keep() -> Column:
    complaint = F.concat(F.lit("bad record: "), F.col("value"))
    return F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(complaint).cast("boolean"))


def apply_policy(
    parsed: DataFrame,
    on_reject: str,
    path: str,
    source: str | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """``throw`` fails the query, ``none`` drops, ``log`` counts, reports and drops."""
    columns = record_columns(parsed, source)
    if on_reject == "throw":
        kept = parsed.where(_refuse_or_keep())
    elif on_reject == "none":
        kept = parsed.where("ok")
    else:
        counts = F.count(F.lit(1)).alias("read"), F.count_if(~F.col("ok")).alias("rejected")
        if parsed.isStreaming:
            # the counts of each batch are in the progress of the query
            parsed = parsed.observe("millrace_rejects", *counts)
        elif observation is not None:
            parsed = parsed.observe(observation, *counts)
        else:
            observation = Observation()
            parsed = parsed.observe(observation, *counts, *_shown_records())
            _report(observation, path)
        kept = parsed.where("ok")
    return kept.select(*columns)


def split_rejects(parsed: DataFrame, source: str | None = None, reason: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Good records, and raw text, origin and (if it is told) ``reason`` of the bad ones."""
    good = parsed.where("ok").select(*record_columns(parsed, source))
    bad = parsed.where("NOT ok")
    told = [] if reason is None else [reason.alias("reason")]
    return good, bad.select(F.col("value").alias("record"), F.col("source.path").alias("path"), *told)


def mark_rejects(parsed: DataFrame, source: str | None = None) -> DataFrame:
    """All records in one frame: ``rejected`` holds the raw text of a bad one, else null.

    One scan serves both kinds; route it with ``export_routed`` to write them apart.
    """
    bad = F.when(~F.col("ok"), F.col("value")).alias("rejected")
    return parsed.select(*record_columns(parsed, source), bad)
