"""The seed log as a table of segments that are only ever added.

A segment is a folder ``<number>-rows`` with the rows one run or reset has made, of as many seeds as it has changed. The
log is the newest row of every seed. Compaction writes ``<number>-base``, the whole log up to and with that number; what
it replaces may be dropped. A segment counts once Spark has written it to its end, so a run that stops in the
middle adds nothing. One run at a time may add to a log.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import SEED_LOG
from . import streams
from .readers import as_saved, typed_log

ROWS, BASE = "rows", "base"
_NAME = re.compile(r"(\d{6,})-(rows|base)")
SEGMENTS = 16
"""Segments beyond the base after which ``append`` makes a new one."""


def segments(folder: str) -> list[tuple[int, str]]:
    """Number and kind of the segments that the log consists of: the last base, if there is one, and what follows it."""
    found = sorted((int(m[1]), m[2]) for m in map(_NAME.fullmatch, streams.child_names(folder)) if m)
    whole = [s for s in found if "_SUCCESS" in streams.child_names(f"{folder}/{_name(*s)}")]
    bases = [number for number, kind in whole if kind == BASE]
    last = max(bases, default=-1)
    return [(number, kind) for number, kind in whole if (kind == BASE and number == last) or (kind == ROWS and number > last)]


def _name(number: int, kind: str) -> str:
    return f"{number:06d}-{kind}"


def newest(folder: str) -> int | None:
    """Number of the last segment; None where there is no log yet."""
    return max((number for number, _ in segments(folder)), default=None)


def _read(spark: SparkSession, folder: str, chosen: list[tuple[int, str]]) -> DataFrame:
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{6,})-(?:rows|base)/[^/]*$", 1).cast("int")
    paths = [f"{folder}/{_name(*s)}" for s in chosen]
    return spark.read.schema(SEED_LOG).parquet(*paths).withColumn("_number", number)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The log: of every seed the rows of the newest segment that has any. Columns that are not asked for are not read.

    The first segment is by far the largest and is not sorted: its rows stay unless a later segment has their seed.
    """
    chosen = segments(folder)
    if not chosen:
        return spark.createDataFrame([], SEED_LOG)
    first = _read(spark, folder, chosen[:1]).drop("_number")
    if len(chosen) == 1:
        return first
    last = F.max("_number").over(Window.partitionBy("Seed_ID"))
    later = _read(spark, folder, chosen[1:]).withColumn("_last", last).filter("_number = _last").drop("_number", "_last")
    changed = _read(spark, folder, chosen[1:]).select("Seed_ID").distinct()
    return first.join(changed, "Seed_ID", "left_anti").select(*SEED_LOG.names).unionByName(later)


def append(rows: DataFrame, folder: str) -> int:
    """Add rows as the newest segment; returns its number. A segment that was not finished is written over."""
    spark = rows.sparkSession
    last = newest(folder)
    number = 0 if last is None else last + 1
    typed_log(as_saved(rows)).write.mode("overwrite").parquet(f"{folder}/{_name(number, ROWS)}")
    if len(segments(folder)) > SEGMENTS:
        compact(spark, folder)
    return number


def compact(spark: SparkSession, folder: str) -> None:
    """Write the whole log as a base, in order of seed id, so that reading need not look at the segments before."""
    chosen = segments(folder)
    if len(chosen) > 1:
        whole = read(spark, folder).repartitionByRange("Seed_ID").sortWithinPartitions("Seed_ID")
        whole.write.mode("overwrite").parquet(f"{folder}/{_name(chosen[-1][0], BASE)}")


def drop_superseded(folder: str) -> list[str]:
    """Delete segments that the last base has replaced; nothing may be reading them."""
    keep = {_name(*s) for s in segments(folder)}
    gone = [name for name in streams.child_names(folder) if _NAME.fullmatch(name) and name not in keep]
    for name in gone:
        streams.remove_folder(folder, name)
    return gone


def export(spark: SparkSession, folder: str, place: str) -> None:
    """The log as CSV, in order of seed id, with the placeholder where a status has no value."""
    from .writers import write_log

    write_log(read(spark, folder).orderBy("Seed_ID"), place)
