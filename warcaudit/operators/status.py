"""The seed log: fold events into it, judge it, resume from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from . import grouping


def fold_log(events: DataFrame, seeds: DataFrame | None = None, order: Sequence[str] = ("ord",),
             columns: Sequence[str] = V.PROGRESS_COLUMNS) -> DataFrame:
    """Messages of each seed joined per log column, in order; the placeholder where there are none.

    ``events`` has ``seed_id``, the order columns, ``log_column`` and ``message``. ``seeds`` adds seeds
    without events. One row per seed.
    """
    rows = events.filter(F.col("log_column").isin(list(columns)) & F.col("message").isNotNull()).select(
        "seed_id", *order, F.col("log_column").alias("cell"), F.col("message").alias("text"))
    folded = grouping.join_texts(rows, "seed_id", order, columns, V.MESSAGE_SEPARATOR)
    if seeds is not None:
        folded = seeds.select("seed_id").distinct().join(folded, "seed_id", "left")
    texts = [F.coalesce(F.col(name), F.lit(V.TBD)).alias(name) for name in columns]
    return folded.select(F.col("seed_id").alias("Seed_ID"), *texts)


def append_message(cell: Column, message: Column) -> Column:
    """One more message in a cell: replaces the placeholder, follows anything else."""
    return F.when(cell == V.TBD, message).otherwise(F.concat(cell, F.lit(V.MESSAGE_SEPARATOR), message))


def finish_report_columns(log: DataFrame) -> DataFrame:
    """Success texts for the two report columns that got no message."""
    texts = {V.METADATA_ERRORS: V.ALL_REPORTS_SAVED, V.METADATA_EMPTY: V.NO_EMPTY_REPORTS}
    return log.withColumns({name: F.when(F.col(name) == V.TBD, text).otherwise(F.col(name))
                            for name, text in texts.items()})


def completeness_status(log: DataFrame) -> DataFrame:
    """Set ``Complete`` to the columns that have errors, or to the success text."""
    found = F.concat_ws(V.MESSAGE_SEPARATOR, *[
        F.when(C.has_error(F.col(name)), F.lit(name)) for name in V.ERROR_COLUMNS])
    return log.withColumn(V.COMPLETE, _judged(F.col(V.COMPLETE), found))


def _judged(complete: Column, found: Column) -> Column:
    current = F.when(C.is_open(complete), V.TBD).otherwise(complete)
    return (F.when(found != "", append_message(current, found))
            .when(current == V.TBD, V.COMPLETED).otherwise(current))


def completeness_of_events(events: DataFrame) -> DataFrame:
    """The same from the events themselves: flags combine on the map side, so no message is shuffled."""
    flags = events.groupBy("seed_id").agg(*[
        F.bool_or((F.col("log_column") == name) & C.has_error(F.col("message"))).alias(name)
        for name in V.ERROR_COLUMNS])
    found = F.concat_ws(V.MESSAGE_SEPARATOR, *[F.when(F.col(name), F.lit(name)) for name in V.ERROR_COLUMNS])
    return flags.select(F.col("seed_id").alias("Seed_ID"), _judged(F.lit(V.TBD), found).alias(V.COMPLETE))


def pending_seeds(log: DataFrame) -> DataFrame:
    """Seeds still to be processed. Seeds that finished with errors are not among them."""
    return log.filter(C.is_open(F.col(V.COMPLETE)))


def pending_batch(log: DataFrame, size: int) -> DataFrame:
    """The next few pending seeds, by seed id, for a run in small batches."""
    return pending_seeds(log).orderBy("Seed_ID").limit(size)


def reset_seeds(log: DataFrame, seeds: DataFrame) -> DataFrame:
    """Put the progress columns of the given seeds (``seed_id``) back to the placeholder."""
    again = seeds.select(F.col("seed_id").alias("Seed_ID"), F.lit(True).alias("_again")).distinct()
    joined = log.join(again, "Seed_ID", "left")
    return joined.select(*[
        F.when(F.col("_again"), V.TBD).otherwise(F.col(name)).alias(name) if name in V.PROGRESS_COLUMNS
        else F.col(name) for name in log.columns])


def success_tally(log: DataFrame) -> DataFrame:
    """Successes per WARC column against the number of WARCs, ignoring case."""
    def successes(name: str) -> Column:
        return F.coalesce(F.regexp_count(F.lower(F.col(name)), F.lit("successfully")), F.lit(0))

    counts = {f"{name}_Successes": successes(name) for name in V.WARC_COLUMNS}
    ok = F.lit(True)
    for name in V.WARC_COLUMNS:
        ok = ok & (successes(name) == F.col("WARCs").cast("long"))
    return log.withColumns({**counts, "All_WARCs_Successful": F.coalesce(ok, F.lit(False))})
