"""WARC files: where they are, whether they are unchanged, and what they unpack to."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..sources import streams
from . import grouping

# Bytes of files that one task of a file job should read.
TASK_BYTES = 1024 * 1024 * 1024


def listed_once(listing: DataFrame, order: Sequence[str] = ("page", "position")) -> DataFrame:
    """Download URL and MD5 of each file name: those of its first listing row."""
    return (listing.groupBy("filename")
            .agg(F.min_by(F.struct("url", "md5"), F.struct(*order)).alias("entry"))
            .select("filename", "entry.url", "entry.md5"))


def warc_locations(warcs: DataFrame, listing: DataFrame, order: Sequence[str] = ("page", "position")) -> DataFrame:
    """URL and MD5 for each WARC, or the message that it is not listed. Both have to be there to count."""
    found = warcs.join(listed_once(listing, order), "filename", "left")
    listed = F.col("url").isNotNull() & F.col("md5").isNotNull()
    return (found.withColumn("message", F.when(~listed, C.not_listed(F.col("filename"))))
            .withColumn("url", F.when(listed, F.col("url"))).withColumn("md5", F.when(listed, F.col("md5"))))


def fixity_outcome(listed: Column, actual: Column) -> Column:
    """``verified``, ``changed``, ``not computable``, or ``not listed`` when there is nothing to compare with."""
    return (F.when(listed.isNull(), "not listed").when(actual.isNull(), "not computable")
            .when(actual == listed, "verified").otherwise("changed"))


def verify_fixity(locations: DataFrame, files: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Compare the MD5 of each stored file (``filename, actual_md5``) with the listed one (``filename, md5``).

    Only rows with outcome ``verified`` should go on. Nothing is deleted: ``changed`` rows are the quarantine
    list.
    """
    stamp = F.current_timestamp() if checked_at is None else checked_at
    compared = (locations.join(files.select("filename", "actual_md5"), "filename", "left")
                .withColumn("outcome", fixity_outcome(F.col("md5"), F.col("actual_md5")))
                .withColumn("checked_at", stamp))
    name = F.col("filename")
    message = (F.when(F.col("outcome") == "verified", C.verified(name, F.col("checked_at")))
               .when(F.col("outcome") == "changed", C.fixity_changed(name, F.col("md5"), F.col("actual_md5")))
               .when(F.col("outcome") == "not computable", C.fixity_unknown(name)))
    return compared.withColumn("message", message)


_CHECKED = "path string, filename string, actual_md5 string, size long, unzipped_size long, reason string"


def _results(rows: Iterable[tuple]) -> pd.DataFrame:
    """What was found of the files of a batch, as one table: one for each file costs more than a small file itself."""
    table = pd.DataFrame(rows, columns=["path", "filename", "actual_md5", "size", "unzipped_size", "reason"])
    return table.astype({"size": "Int64", "unzipped_size": "Int64"})


def by_size(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Files dealt to as many tasks as their total size needs, each with about as many bytes. Files are never split.

    The largest come first: each file goes to the task in whose share of the running total its middle lies, so no
    task has more than the mean and one file.
    """
    total, count = files.agg(F.sum(F.greatest("length", F.lit(1))), F.count(F.lit(1))).first()
    if not count:
        return files
    tasks = min(count, max(-(-total // task_bytes), files.sparkSession.sparkContext.defaultParallelism))
    if tasks == 1:
        return files.coalesce(1)
    # A file costs something even if it is empty.
    sized = files.withColumn("_bytes", F.greatest(F.coalesce("length", F.lit(0)), F.lit(1)))
    placed = grouping.running_total(sized, [F.col("_bytes").desc(), F.col("path")], "_bytes", "_total")
    task = F.floor((F.col("_total") - F.col("_bytes") / 2) * tasks / total).cast("int")
    return placed.repartitionById(int(tasks), task).drop("_bytes", "_total")


def hash_files(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """MD5 of files of any size (``path, filename, length``), streamed in chunks; null if it cannot be read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _results((path, name, *streams.check_file(path)) for path, name in zip(batch["path"], batch["filename"]))

    return (by_size(files.select("path", "filename", "length"), task_bytes)
            .mapInPandas(run, _CHECKED).select("path", "filename", "actual_md5", "size"))


def verify_and_unzip(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Hash and unzip each file (``path, filename, length, md5, target``) in one read.

    The unzipped file gets its name only when the MD5 is the listed one, so a lost or repeated task leaves
    either the whole file or none. Rows of the result describe the files; no file content goes through Spark.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Without a listed MD5 there is nothing to verify, so nothing is unzipped.
            yield _results((path, name, *streams.check_file(path, target if md5 else None, md5)) for path, name, md5, target in
                           zip(batch["path"], batch["filename"], batch["md5"], batch["target"]))

    return by_size(files.select("path", "filename", "length", "md5", "target"), task_bytes).mapInPandas(run, _CHECKED)


def with_unzip_message(files: DataFrame) -> DataFrame:
    """Add the log message of unzipping; ``reason`` is null on success."""
    name = F.col("filename")
    return files.withColumn("message", F.when(F.col("reason").isNull(), C.unzipped(name))
                            .otherwise(C.unzip_error(name, F.col("reason"))))


def warc_stage_outcomes(warcs: DataFrame) -> DataFrame:
    """What happened to each WARC: located, downloaded, verified, unzipped, stopping at the first failure.

    Input: ``filename, info_status, url, md5, download_status, actual_md5, reason, checked_at`` (``reason`` is
    why unzipping failed). A stage that was not reached has no message. WARCs do not affect each other.
    """
    name = F.col("filename")
    info_ok = F.col("info_status") == 200
    listed = info_ok & F.col("url").isNotNull() & F.col("md5").isNotNull()
    fetched = listed & (F.col("download_status") == 200)
    hashed = fetched & F.col("actual_md5").isNotNull()
    same = hashed & (F.col("actual_md5") == F.col("md5"))
    unzipped = same & F.col("reason").isNull()
    outcome = (F.when(unzipped, "done").when(same, "not unzipped").when(hashed, "fixity changed")
               .when(fetched, "fixity unknown").when(listed, "not downloaded").otherwise("not located"))
    return warcs.withColumns({
        "outcome": outcome,
        "download_message": F.when(fetched, C.downloaded(name))
        .when(listed, C.download_error(name, F.col("download_status")))
        .when(info_ok, C.not_listed(name)).otherwise(C.info_error(name, F.col("info_status"))),
        "fixity_message": F.when(same, C.verified(name, F.col("checked_at")))
        .when(hashed, C.fixity_changed(name, F.col("md5"), F.col("actual_md5")))
        .when(fetched, C.fixity_unknown(name)),
        "unzip_message": F.when(unzipped, C.unzipped(name)).when(same, C.unzip_error(name, F.col("reason"))),
    })


def stage_events(outcomes: DataFrame) -> DataFrame:
    """Log events of the stages: one per WARC and stage reached. ``ord`` is the place of the WARC in its seed."""
    pairs = ((V.DOWNLOAD_ERRORS, "download_message"), (V.FIXITY_ERRORS, "fixity_message"),
             (V.UNZIP_ERRORS, "unzip_message"))
    events = F.array(*[F.struct(F.lit(column).alias("log_column"), F.col(message).alias("message"))
                       for column, message in pairs])
    return (outcomes.select("seed_id", "ord", F.explode(events).alias("event"))
            .select("seed_id", "ord", "event.log_column", "event.message").filter(F.col("message").isNotNull()))
