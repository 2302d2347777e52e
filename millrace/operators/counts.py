"""Record counts and roll-ups of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.functions.paths import parse_object_path


def counted(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds ``{name: rows}`` after the first action on it.

    The count rides on the work that is done anyway; nothing is read twice.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias(name)), observation


def inventory_summary(objects: DataFrame) -> DataFrame:
    """Files and bytes per bucket, prefix and readability.

    ``objects`` has ``object`` (``bucket/dir/name``), ``size`` and ``readable``; the prefix is
    the folder of the object.
    """
    folder = F.regexp_replace(F.col("object"), r"[^/]*\z", "")
    place = parse_object_path(folder)
    return (
        objects.select(
            place.getField("bucket").alias("bucket"),
            place.getField("prefix").alias("prefix"),
            "readable",
            "size",
        )
        .groupBy("bucket", "prefix", "readable")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    )
