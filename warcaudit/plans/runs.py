"""A whole batch from landed responses to an audited store, and the same again after an interruption.

Landed data, below one folder:

* ``listing/`` pages of the WARC listing, JSON
* ``seed_reports/`` one JSON record per line: ``seed_id, status, body``
* ``responses/`` one JSON record per line: ``report_type, entity_id, status, body``; the entity is the seed,
  the collection, the job or the crawl definition that the report is about
* ``warcs/`` the gzip WARC files

Results, below another: ``preservation_download/<seed>/…``, ``listing`` (the pages as one table), ``seeds_log`` (the
segments of the log), ``reports_now`` (what became of each report, by seed), and ``metadata``, ``pending``, ``reports``, ``events``, ``warc_work``, ``warc_results``,
``audit_listing``, ``stored``, ``expected``, ``states``, ``audit``, ``completeness_check``, ``quarantine``, ``rejects``, ``reconcile``, ``success_tally`` and ``qa_review`` with
one folder per run.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators import audit, grouping, identifiers, inventory, reports, status, warcs
from ..sources import readers, seedlog, stores, streams, tables, writers

RESPONSE = "report_type string, entity_id string, status int, body string"
REPORT_STATE = "seed_id string, report_name string, outcome string, redaction string"
# Seeds that may ask for the same answer in one task; an answer that more seeds share is copied once for so many.
SEEDS_AN_ANSWER = 5_000


@dataclass(frozen=True)
class Batch:
    """Where a batch is, its store window, and whether landed data that cannot be read stop it (``strict``)."""

    landed: str
    results: str
    start: str
    end: str
    strict: bool = False

    def __post_init__(self) -> None:
        C.check_window(self.start, self.end)

    @property
    def store(self) -> str:
        return f"{self.results}/preservation_download"

    @property
    def listing(self) -> str:
        return f"{self.results}/listing"

    @property
    def log(self) -> str:
        return f"{self.results}/seeds_log"

    @property
    def reports_now(self) -> str:
        """What became of every report of every seed, as of its last run: a table by seed."""
        return f"{self.results}/reports_now"

    def place(self, table: str, run: str) -> str:
        return f"{self.results}/{table}/{run}"


def _place(step: int, page="", position=0, part: int = 0):
    """Where a message goes in its cell: by step, then by listing place."""
    page, position = (F.lit(v) if isinstance(v, (str, int)) else v for v in (page, position))
    return F.struct(F.lit(step).alias("step"), page.alias("page"), position.alias("position"), F.lit(part).alias("part"))


def prepare_log(spark: SparkSession, batch: Batch, run: str) -> None:
    """Write the metadata file and the first seed log, with AIP ids and nothing done yet."""
    grouping.use_checkpoints(spark)
    # Pages are parsed once: the ranges of store time are cut from a sample, which would read them all before.
    writers.write_listing(readers.read_landed_listing(spark, f"{batch.landed}/listing", batch.strict).checkpoint(), batch.listing)
    listing = readers.read_listing_table(spark, batch.listing)
    names = inventory.rows_in_window(listing, batch.start, batch.end).select("seed_id").distinct()
    landed = readers.read_seed_reports(spark, f"{batch.landed}/seed_reports", batch.strict)
    answers = names.join(landed, "seed_id", "left").withColumn("status", F.coalesce("status", F.lit(404)))
    writers.write_metadata(identifiers.aip_metadata(answers, batch.end), batch.place("metadata", run))
    ids = readers.read_report(spark, batch.place("metadata", run))
    seeds = inventory.seed_inventory(listing, batch.start, batch.end)
    seedlog.append(inventory.enrich(seeds, ids), batch.log)


def quarantine(spark: SparkSession, batch: Batch, landed_listing: DataFrame) -> DataFrame:
    """What of the landed data could not be read: pages, lines and seed reports, with file and digest but without content."""
    seeds = readers.read_answers(spark, f"{batch.landed}/seed_reports", readers.SEED_RESPONSE, ["seed_id"])
    return (readers.broken_pages(landed_listing)
            .unionByName(readers.broken_lines(spark, f"{batch.landed}/seed_reports", readers.SEED_RESPONSE, ["seed_id"], "seed report line"))
            .unionByName(readers.broken_lines(spark, f"{batch.landed}/responses", RESPONSE, ["report_type", "entity_id"], "response line"))
            .unionByName(readers.broken_seed_reports(seeds)))


def process_reports(spark: SparkSession, batch: Batch, seeds: DataFrame, rows: DataFrame, run: str) -> DataFrame:
    """Save and redact the metadata reports of seeds (``seed_id, aip_id``); returns the log events.

    The classified responses are written down once, seed reports already redacted; files and events are both made
    from that table. Answers that very many seeds share, be it those of a collection, a job or a definition, are dealt out by seed.
    """
    landed = readers.read_answers(spark, f"{batch.landed}/responses", RESPONSE, ["report_type", "entity_id"], batch.strict)
    columns = ["seed_id", "aip_id", "report_type", "entity_id", "ord"]
    table = batch.place("reports", run)

    def calls(df: DataFrame, report_type: str, entity: str, place) -> DataFrame:
        return df.select("seed_id", "aip_id", F.lit(report_type).alias("report_type"),
                         F.col(entity).alias("entity_id"), place.alias("ord"))

    def answered(wanted: DataFrame) -> DataFrame:
        joined = grouping.dealt_join(wanted.select(*columns), landed, ["report_type", "entity_id"], "seed_id", SEEDS_AN_ANSWER)
        return reports.classify_reports(joined.withColumn("status", F.coalesce("status", F.lit(404))))

    collections = inventory.seed_collections(rows).join(seeds, "seed_id")
    jobs = inventory.seed_jobs(rows)
    in_listing = (F.col("ord.page"), F.col("ord.position"))
    classified = answered(
        calls(seeds, "seed", "seed_id", _place(1)).unionByName(calls(seeds, "seedscope", "seed_id", _place(2)))
        .unionByName(calls(collections, "collscope", "collection", _place(3, *in_listing)))
        .unionByName(calls(collections, "coll", "collection", _place(4, *in_listing)))
        .unionByName(calls(jobs.join(seeds, "seed_id"), "crawljob", "job_id", _place(5, *in_listing, part=0))))

    # A job has one report, whichever seed asks for it.
    job_reports = (landed.filter((F.col("report_type") == "crawljob") & (F.col("status") == 200))
                   .withColumnRenamed("entity_id", "job_id").join(jobs.select("job_id").distinct(), "job_id", "left_semi"))
    job_rows = readers.parse_reports(job_reports, ["job_id"], first=1).select(
        "job_id", "row", F.try_element_at("fields", F.lit("crawl_definition")).alias("crawl_definition"))
    needed = reports.crawl_definitions(jobs, job_rows).join(seeds, "seed_id").withColumn(
        "place", _place(5, *in_listing, part=1))
    definitions = answered(calls(
        needed.filter(F.col("kind") == "definition"), "crawldef", "crawl_definition", F.col("place")))
    no_report = needed.filter(F.col("kind") == "error").select(
        "seed_id", F.col("place").alias("ord"), F.lit(V.METADATA_ERRORS).alias("log_column"), "message")

    reports.redact_seed_reports(classified.unionByName(definitions)).write.mode("overwrite").parquet(table)
    everything = spark.read.parquet(table)
    writers.write_report_files(reports.saved_reports(everything), batch.store)
    tables.replace_seeds(spark, batch.reports_now, everything, seeds, REPORT_STATE)
    redaction = reports.redaction_events(seeds, everything).select("seed_id", _place(4, part=1).alias("ord"), "log_column", "message")
    return reports.report_events(everything).unionByName(no_report).unionByName(redaction)


def process_warcs(spark: SparkSession, batch: Batch, rows: DataFrame, run: str) -> DataFrame:
    """Verify and unzip the WARCs of the given listing rows; returns the log events.

    The results of the file work are written down before they are used, so that no file is read twice.
    """
    # A name that is listed twice is one file; the rows themselves say where it is.
    names = rows.groupBy("filename").agg(F.min(F.struct("page", "position")).alias("ord"), F.first("seed_id").alias("seed_id"))
    located = warcs.warc_locations(names, rows)
    files = readers.warc_files(readers.list_files(spark, f"{batch.landed}/warcs")).groupBy("filename").agg(
        F.min_by(F.struct("path", "length"), "path").alias("file")).select("filename", "file.path", "file.length")
    target = F.concat(F.lit(f"{batch.store}/"), "seed_id", F.lit("/"), F.expr("left(filename, length(filename) - 3)"))
    todo = located.filter(F.col("md5").isNotNull()).join(files, "filename").withColumn("target", target)
    work, results = batch.place("warc_work", run), batch.place("warc_results", run)
    todo.write.mode("overwrite").parquet(work)
    warcs.verify_and_unzip(spark.read.parquet(work)).write.mode("overwrite").parquet(results)

    done = (spark.read.parquet(results).groupBy("filename")
            .agg(F.min_by(F.struct("actual_md5", "reason"), "path").alias("result"))
            .select("filename", "result.actual_md5", "result.reason", F.lit(200).alias("download_status")))
    outcomes = warcs.warc_stage_outcomes(
        located.join(done, "filename", "left")
        .withColumns({"info_status": F.lit(200), "download_status": F.coalesce("download_status", F.lit(404)),
                      "checked_at": F.current_timestamp()}))
    return warcs.stage_events(outcomes).withColumn("ord", _place(6, F.col("ord.page"), F.col("ord.position")))


def run_batch(spark: SparkSession, batch: Batch, size: int | None = None) -> str:
    """Process the seeds that are still pending, at most ``size`` of them, and audit the store.

    Starts from the seed log, or makes the first one. What an interrupted run left of a pending seed is dropped and made
    again; finished seeds are left alone, also those that finished with errors. The run adds the lines of its own
    seeds to the log. Returns the name of the run.
    """
    batch = _qualified(spark, batch)
    # Report files of an earlier run that were committed but not all moved yet.
    stores.finish_writes(spark, batch.store)
    if seedlog.newest(batch.log) is None:
        prepare_log(spark, batch, "run-0000")
    run = f"run-{seedlog.newest(batch.log) + 1:04d}"
    log = seedlog.read(spark, batch.log)
    chosen = status.pending_seeds(log) if size is None else status.pending_batch(log, size)
    # Written down: the choice is used many times, and the log it comes from can be large.
    chosen.select(F.col("Seed_ID").alias("seed_id"), F.coalesce("AIP_ID", F.lit(V.TBD)).alias("aip_id")).write.mode(
        "overwrite").parquet(batch.place("pending", run))
    seeds = spark.read.parquet(batch.place("pending", run))
    writers.drop_seed_folders(seeds, batch.store).write.mode("overwrite").format("noop").save()

    listing = readers.read_listing_table(spark, batch.listing)
    named = inventory.rows_in_window(listing, batch.start, batch.end).join(
        seeds.select("seed_id"), "seed_id", "left_semi")
    places = [batch.place("events", f"{run}-{part}") for part in ("reports", "warcs")]
    process_reports(spark, batch, seeds, named, run).write.mode("overwrite").parquet(places[0])
    process_warcs(spark, batch, named, run).write.mode("overwrite").parquet(places[1])
    events = spark.read.parquet(*places)

    facts = inventory.seed_inventory(named.drop("seed_id", "store_date"), batch.start, batch.end).drop(*V.STATUS_COLUMNS)
    folded = status.finish_report_columns(status.fold_log(events, seeds.select("seed_id")))
    judged = status.completeness_of_events(events)
    done = (facts.join(folded, "Seed_ID", "full").join(judged, "Seed_ID", "left")
            .withColumn(V.COMPLETE, F.coalesce(V.COMPLETE, F.lit(V.COMPLETED)))
            .join(seeds.select(F.col("seed_id").alias("Seed_ID"), F.col("aip_id").alias("AIP_ID")), "Seed_ID", "left"))
    seedlog.append(done, batch.log)
    write_audit(spark, batch, run)
    return run


def _qualified(spark: SparkSession, batch: Batch) -> Batch:
    """The batch with paths that driver, executors and Spark's readers take for the same place."""
    def place(path: str) -> str:
        if "://" in path or path.startswith("file:"):
            return path
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"'{path}' has no scheme, so every executor would use its own disk")
        return f"file:{os.path.abspath(path)}"

    return replace(batch, landed=place(batch.landed), results=place(batch.results))


def reset_seeds(spark: SparkSession, batch: Batch, seeds: DataFrame) -> None:
    """Put seeds (``seed_id``) back to where nothing was done for them: the next run makes them again.

    Only their lines are added to the log, and only their buckets of the report table are rewritten. Their folders are
    dropped by that run, which is what makes it repeatable.
    """
    batch = _qualified(spark, batch)
    again = seeds.select(F.col("seed_id").alias("Seed_ID")).distinct()
    lines = seedlog.read(spark, batch.log).join(again, "Seed_ID", "left_semi").withColumn(V.COMPLETE, F.lit(V.TBD))
    tables.replace_seeds(spark, batch.reports_now, spark.createDataFrame([], REPORT_STATE), seeds, REPORT_STATE)
    seedlog.append(status.reset_seeds(lines, seeds), batch.log)


def write_audit(spark: SparkSession, batch: Batch, run: str) -> DataFrame:
    """Compare the store with the whole listing, write what was found and return the typed completeness table.

    Reads the landed pages themselves, so that the check does not rest on what the run made of them; they, the store's
    files and folders, and the typed table are each worked out once and written down. What has not changed since the
    last run's audit is taken from there. Also written, one folder per run:
    landed data that could not be read (``quarantine``), rows that could not be placed (``rejects``), whether the
    listing's own total is met (``reconcile``), successes by WARC (``success_tally``) and seeds to look at (``qa_review``).
    """
    def once(rows: DataFrame, table: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(batch.place(table, run))
        return spark.read.parquet(batch.place(table, run))

    log = seedlog.read(spark, batch.log)
    landed = readers.read_landed_listing(spark, f"{batch.landed}/listing", batch.strict)
    landed = once(landed.drop("url", "md5", "collection", "crawl"), "audit_listing")
    listing = readers.listed_rows(landed)
    files = once(stores.list_store(spark, batch.store), "stored")
    expected = inventory.expected_seeds(listing, log, batch.start, batch.end)
    stored, made = readers.files_of(files), readers.folders_of(files)
    expected = once(expected, "expected")
    states = once(audit.folder_states(expected, log, stored, made), "states")
    earlier = [r for r in streams.child_names(f"{batch.results}/audit") if r < run and "_SUCCESS" in streams.child_names(batch.place("audit", r))]
    if earlier:
        before, states_before = (spark.read.parquet(batch.place(table, earlier[-1])) for table in ("audit", "states"))
        store = audit.audit_changes(expected, log, stored, made, states, before, states_before)
    else:
        store = audit.audit_store(expected, log, stored, made)
    store = once(store, "audit")
    writers.write_completeness(audit.completeness_report(store), batch.place("completeness_check", run))
    for table, rows in (("quarantine", quarantine(spark, batch, landed)),
                        ("rejects", inventory.rejected_rows(listing)),
                        ("reconcile", inventory.reconcile(listing, log, batch.start, batch.end)),
                        ("success_tally", status.success_tally(log).drop("WARC_Filenames", *V.PROGRESS_COLUMNS)),
                        ("qa_review", audit.qa_failures(audit.qa_review(log, store)))):
        rows.write.mode("overwrite").parquet(batch.place(table, run))
    return store
