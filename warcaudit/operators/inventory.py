"""Listing rows to seeds: inventory, expected seeds, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from . import grouping

LISTING_ORDER = ("page", "position")


def with_ids(listing: DataFrame) -> DataFrame:
    """Add ``seed_id`` and ``store_date``; null where the name or the time cannot be read."""
    return C.with_first_group(C.with_first_group(listing, "seed_id", "filename", V.SEED_PATTERN),
                              "store_date", "store_time", V.STORE_DATE_PATTERN)


def rejected_rows(listing: DataFrame) -> DataFrame:
    """Listing rows that cannot be placed, with the reason."""
    rows = with_ids(listing)
    reason = (F.when(F.col("seed_id").isNull(), "no seed id in file name")
              .when(F.col("store_date").isNull(), "no date in store time"))
    return rows.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def accepted_rows(listing: DataFrame, strict: bool = False) -> DataFrame:
    """Listing rows with a seed id and a date. ``strict`` stops the job at the first row without."""
    rows = with_ids(listing)
    if strict:
        broken = F.raise_error(F.concat(F.lit("cannot place listing row "), F.col("filename")))
        rows = rows.withColumn("seed_id", F.when(
            F.col("seed_id").isNull() | F.col("store_date").isNull(), broken).otherwise(F.col("seed_id")))
    return rows.filter(F.col("seed_id").isNotNull() & F.col("store_date").isNotNull())


def rows_in_window(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Seed rows stored in the half-open window.

    For ISO times the text comparison of the whole time equals that of its date, so the first filter can
    reach a landed Parquet table; the second one drops rows whose time cannot be read.
    """
    C.check_window(start, end)
    near = listing.filter((F.col("store_time") >= start) & (F.col("store_time") < end))
    return with_ids(near).filter(F.col("seed_id").isNotNull() & C.in_window(F.col("store_date"), start, end))


def seed_jobs(rows: DataFrame, order: Sequence[str] = LISTING_ORDER) -> DataFrame:
    """Each job of each seed once, with the place where it is first listed."""
    return (rows.groupBy("seed_id", F.col("crawl").alias("job_id"))
            .agg(F.min(F.struct(*order)).alias("ord")))


def seed_collections(rows: DataFrame, order: Sequence[str] = LISTING_ORDER) -> DataFrame:
    """Each collection of each seed once, with the place where it is first listed."""
    return rows.groupBy("seed_id", "collection").agg(F.min(F.struct(*order)).alias("ord"))


def seed_totals(rows: DataFrame) -> DataFrame:
    """Bytes, GB and number of WARCs per seed."""
    return (rows.groupBy("seed_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("warcs"))
            .withColumn("size_gb", C.gigabytes(F.col("bytes"))))


def explode_list(df: DataFrame, column: str, value: str, position: str = "position") -> DataFrame:
    """One row per entry of a delimited id list, keeping the place in the list."""
    entries = F.split(F.col(column), r"\|")
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.posexplode(entries).alias(position, value))


def seed_inventory(listing: DataFrame, start: str, end: str, order: Sequence[str] = LISTING_ORDER) -> DataFrame:
    """One row per seed: collections, jobs, GB, WARC count, WARC names and the status columns.

    Lists keep the order in which entries are first listed. Rows are not sorted. The lists of a seed with very many
    rows are made in pieces of its order first.
    """
    fields = [*order, *[c for c in ("filename", "crawl", "collection") if c not in order]]
    rows = rows_in_window(listing, start, end).select("seed_id", "size", *fields)
    small, large = grouping.in_pieces(rows, "seed_id", order, "copies")

    def lists(rows: DataFrame, *keys: str, copied: bool) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct(*fields, *(["copies"] if copied else []))))
        found = rows.groupBy(*keys).agg(
            F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("warcs"), listed.alias("listed"))

        def each(field: str) -> Column:
            return F.transform("listed", lambda x: x[field])

        names = grouping.joined(each("filename"), V.LIST_SEPARATOR, "WARC_Filenames", each("copies") if copied else None)
        return found.select(*keys, "bytes", "warcs", names.alias("names"), F.array_distinct(each("crawl")).alias("jobs"),
                            F.array_distinct(each("collection")).alias("collections"))

    seeds = lists(small, "seed_id", copied=False)
    if large is not None:
        run = F.struct("_piece", "names", "jobs", "collections")
        whole = lists(large, "seed_id", "_piece", copied=True).groupBy("seed_id").agg(
            F.sum("bytes").alias("bytes"), F.sum("warcs").alias("warcs"), F.sort_array(F.collect_list(run)).alias("runs"))

        def every(field: str) -> Column:
            return F.array_distinct(F.flatten(F.transform("runs", lambda x: x[field]))).alias(field)

        names = grouping.joined(F.transform("runs", lambda x: x["names"]), V.LIST_SEPARATOR, "WARC_Filenames")
        seeds = seeds.unionByName(whole.select("seed_id", "bytes", "warcs", names.alias("names"), every("jobs"), every("collections")))

    def text(field: str) -> Column:
        return grouping.joined(F.col(field), V.LIST_SEPARATOR, field)

    return seeds.select(
        F.col("seed_id").alias("Seed_ID"), text("collections").alias("AIT_Collection"), text("jobs").alias("Job_ID"),
        C.gigabytes(F.col("bytes")).alias("Size_GB"), F.col("warcs").alias("WARCs"), F.col("names").alias("WARC_Filenames"),
        *[F.lit(V.TBD).alias(name) for name in V.STATUS_COLUMNS])


def enrich(inventory: DataFrame, aip: DataFrame) -> DataFrame:
    """Add the AIP id of each seed as the first column; null for seeds without one."""
    others = [c for c in inventory.columns if c != "Seed_ID"]
    ids = aip.select(F.col("Folder").alias("Seed_ID"), "AIP_ID")
    return inventory.join(ids, "Seed_ID", "left").select("AIP_ID", "Seed_ID", *others)


def expected_seeds(listing: DataFrame, log: DataFrame, start: str, end: str,
                   order: Sequence[str] = LISTING_ORDER, strict: bool = False) -> DataFrame:
    """Seeds with WARCs in the window that the seed log has exactly once: AIP id and number of WARCs.

    Filters the whole listing and does not use the inventory, so that it can check it.
    """
    rows = accepted_rows(listing, strict).filter(C.in_window(F.col("store_date"), start, end))
    counts = rows.groupBy("seed_id").agg(F.count(F.lit(1)).alias("warcs"), F.min(F.struct(*order)).alias("ord"))
    return counts.join(_logged_once(log), "seed_id").select("seed_id", "aip_id", "warcs", "ord")


def _logged_once(log: DataFrame) -> DataFrame:
    return (log.groupBy(F.col("Seed_ID").alias("seed_id"))
            .agg(F.count(F.lit(1)).alias("_lines"), F.first("AIP_ID").alias("aip_id"))
            .filter(F.col("_lines") == 1).drop("_lines"))


def reconcile(listing: DataFrame, log: DataFrame, start: str, end: str) -> DataFrame:
    """Whether the listing's own total equals the rows that are part of the batch plus those that are not.

    ``listing`` carries the declared total in ``declared``. Rows that cannot be placed are counted apart and
    explain a difference.
    """
    rows = with_ids(listing)
    placed = F.col("seed_id").isNotNull() & F.col("store_date").isNotNull()
    inside = placed & C.in_window(F.col("store_date"), start, end)
    # Counted per seed first, so that the join sees one row per seed.
    per_seed = rows.groupBy("seed_id").agg(
        F.max("declared").alias("declared"), F.count_if(inside).alias("inside"),
        F.count_if(placed & ~inside).alias("outside"), F.count_if(~placed).alias("rejected"))
    known = _logged_once(log).select("seed_id", F.lit(True).alias("known"))
    joined = per_seed.join(known, "seed_id", "left")
    seen = F.coalesce(F.col("known"), F.lit(False))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return joined.agg(
        F.max("declared").alias("declared"),
        total(F.when(seen, F.col("inside")).otherwise(0)).alias("included"),
        total(F.col("outside") + F.when(seen, F.lit(0)).otherwise(F.col("inside"))).alias("excluded"),
        total(F.col("rejected")).alias("rejected"),
    ).withColumn("reconciled", F.col("declared") == F.col("included") + F.col("excluded"))
