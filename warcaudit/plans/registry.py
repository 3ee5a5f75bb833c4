"""Every operator as a query over the given tables."""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators import audit, grouping, identifiers, inventory, reports, status, warcs
from ..sources import readers, seedlog, stores, streams, tables, writers
from . import runs
from .inputs import CHECKED_AT, END, INPUTS, LISTING_ORDER, START, dealt, derive, listing_between, load

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- sources ------------------------------------------------------------------------------------
@_query
def listing_scan(spark, folder):
    pages = derive(spark, folder, """
        select filename as page, to_json(named_struct('count', 2, 'files', array(
            named_struct('filename', filename, 'collection', cast(collection as int), 'crawl', crawl, 'size', size,
                         'store-time', store_time, 'locations', array(concat('https://example.org/', filename), 'other'),
                         'checksums', map('sha1', crawl, 'md5', md5(filename))),
            named_struct('filename', concat('second-', filename), 'collection', cast(collection as int), 'crawl', crawl,
                         'size', size + 1, 'store-time', store_time, 'locations', cast(array() as array<string>),
                         'checksums', map('sha1', crawl, 'md5', cast(null as string)))))) as body
        from (""" + INPUTS["warc_listing"] + ") w", lineitem=dealt(spark, folder, "lineitem", "l_orderkey"))
    return readers.parse_listing(pages)


@_query
def seed_report_scan(spark, folder):
    responses = derive(spark, folder, """
        select seed_id, status, case when status = 200 then to_json(array(named_struct('metadata', named_struct(
            'Collector', case when collector is not null then array(named_struct('value', collector)) end,
            'Relation', case when relation is not null
                             then array(named_struct('value', relation), named_struct('value', concat('See ', seed_id))) end,
            'Title', case when title is not null then array(named_struct('value', title)) else array() end)))) end as body
        from (""" + INPUTS["seed_reports"] + ") r")
    return readers.parse_seed_reports(responses)


@_query
def report_scan(spark, folder):
    bodies = derive(spark, folder, r"""
        select o_orderkey, case when o_orderkey % 2 = 0
            then concat('id,crawl_definition,note\n', o_orderkey, ',', o_custkey, ',"a, ""b""\nnext"\n', o_orderkey + 1, ',,plain\n')
            else concat('id,login_password\r\n', o_orderkey, ',', o_orderpriority, '\r\n') end as body
        from {orders}""", orders=dealt(spark, folder, "orders", "o_orderkey"))
    rows = readers.parse_reports(bodies, ["o_orderkey"])
    return rows.select("o_orderkey", "row", F.explode("fields").alias("name", "value"))


def _event_log(spark, folder) -> DataFrame:
    """A whole seed log made of the processing messages."""
    events = load(spark, folder, "seed_events")
    totals = events.groupBy(F.col("seed_id").alias("Seed_ID")).agg(
        C.gigabytes(F.sum(F.col("ord") * 1000500)).alias("Size_GB"),
        F.count_if(F.col("log_column") == V.DOWNLOAD_ERRORS).alias("WARCs"))
    folded = status.fold_log(events).withColumn(V.COMPLETE, F.lit(V.TBD)).join(totals, "Seed_ID")
    return status.completeness_status(folded).withColumns({
        "AIP_ID": F.concat(F.lit("aip-"), "Seed_ID"), "AIT_Collection": F.lit("7"),
        "Job_ID": F.lit(None).cast("string"), "WARC_Filenames": F.lit("a|b")})


def _place(spark, name: str) -> str:
    """A new folder below the session's shared one."""
    grouping.use_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _saved_log(spark, folder) -> str:
    """Write the log to the shared folder and return its place."""
    place = _place(spark, "seed-log")
    writers.write_log(_event_log(spark, folder), place)
    return place


@_query
def log_sink(spark, folder):
    return readers.as_saved(readers.read_log(spark, _saved_log(spark, folder)))


@_query
def log_scan(spark, folder):
    return readers.read_log(spark, _saved_log(spark, folder))


@_query
def log_segments(spark, folder):
    """A first log, two runs, a reset, compaction and a third run, each adding only its own lines."""
    log, number = _place(spark, "segments"), F.col("Seed_ID").cast("long")
    _event_log(spark, folder).write.parquet(f"{log}-lines")
    done = spark.read.parquet(f"{log}-lines")
    seedlog.append(done.withColumns({name: F.lit(V.TBD) for name in V.STATUS_COLUMNS}), log)
    seedlog.append(done.filter(number % 2 == 0), log)
    seedlog.append(done.filter(number % 3 == 0), log)
    again = seedlog.read(spark, log).filter(number % 10 == 0)
    seedlog.append(status.reset_seeds(again, again.select(F.col("Seed_ID").alias("seed_id"))).withColumn(V.COMPLETE, F.lit(V.TBD)), log)
    seedlog.compact(spark, log)
    seedlog.append(done.filter(number % 20 == 0), log)
    return readers.as_saved(seedlog.read(spark, log))


@_query
def quarantine(spark, folder):
    """Landed lines and pages: what could be read, and what could not with its digest."""
    landed = _place(spark, "landed")
    load(spark, folder, "landed_lines").select("line").write.text(f"{landed}/responses")
    stores.write_files(load(spark, folder, "landed_pages").withColumn("folder", F.lit("listing")), landed)
    schema, keys = "report_type string, entity_id string, status int, body string", ["report_type", "entity_id"]
    answers = readers.read_answers(spark, f"{landed}/responses", schema, keys)
    pages = readers.read_landed_listing(spark, f"{landed}/listing")
    kept = answers.select(F.lit("answer").alias("source"), F.col("entity_id").alias("name"), F.length("body").cast("bigint").alias("chars"),
                          F.sha2(F.col("body").cast("binary"), 256).alias("sha256"))
    listed = readers.listed_rows(pages).select(F.lit("listed").alias("source"), F.col("filename").alias("name"), F.col("size").alias("chars"),
                                               F.lit(None).cast("string").alias("sha256"))
    lines = readers.broken_lines(spark, f"{landed}/responses", schema, keys, "response line")
    broken = readers.broken_pages(pages).withColumn("name", F.col("file")).unionByName(lines)
    return kept.unionByName(listed).unionByName(broken.select(*kept.columns))


def _empty_folders(names: DataFrame, root: str) -> None:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["folder"]:
                place, inner = streams.open_path(f"{root}/{name}")
                place.create_dir(inner, recursive=True)
            yield batch

    names.mapInPandas(run, "folder string").write.format("noop").mode("overwrite").save()


@_query
def file_listing(spark, folder):
    root = _place(spark, "store #1%")
    files = load(spark, folder, "store_paths").select("folder", "name", "body")
    stores.write_files(files.filter("name is not null"), root)
    _empty_folders(files.filter("name is null").select("folder"), root)
    return readers.below_root(stores.list_store(spark, root).select("path", "length", "is_folder"), root).select(
        "folder", "name", "length", "is_folder")


@_query
def metadata_sink(spark, folder):
    place = _place(spark, "metadata")
    writers.write_metadata(aip_metadata(spark, folder), place)
    return readers.read_report_lines(spark, place)


@_query
def completeness_sink(spark, folder):
    place = _place(spark, "completeness")
    writers.write_completeness(audit_csv(spark, folder), place)
    return readers.read_report_lines(spark, place)


@_query
def report_sink(spark, folder):
    place = _place(spark, "store")
    saved = reports.saved_reports(reports.classify_reports(load(spark, folder, "report_responses")))
    writers.write_report_files(saved.withColumnRenamed("report_name", "kept").withColumn(
        "report_name", F.concat("ord", F.lit(" #"), "kept")), place)
    files = readers.list_files(spark, place)
    return files.select("folder", F.substring_index("name", "#", -1).alias("name"), "length")


# ---- listing rows -------------------------------------------------------------------------------
@_query
def seed_id_extract(spark, folder):
    rows = load(spark, folder, "warc_listing")
    return rows.select("filename", C.seed_id(F.col("filename")).alias("seed_id"))


@_query
def store_date(spark, folder):
    rows = load(spark, folder, "warc_listing")
    return rows.select("filename", C.store_date(F.col("store_time")).alias("store_date"))


@_query
def date_window(spark, folder):
    rows = inventory.rows_in_window(listing_between(spark, folder, START, END), START, END)
    return rows.select("filename", "seed_id", "store_date")


@_query
def rejects(spark, folder):
    return inventory.rejected_rows(load(spark, folder, "warc_listing")).select("filename", "store_date", "reason")


@_query
def seed_sizes(spark, folder):
    return inventory.seed_totals(inventory.accepted_rows(load(spark, folder, "warc_listing")))


@_query
def seed_inventory(spark, folder):
    return inventory.seed_inventory(listing_between(spark, folder, START, END), START, END, LISTING_ORDER)


@_query
def explode_lists(spark, folder):
    every = inventory.seed_inventory(load(spark, folder, "warc_listing"), "0001-01-01", "9999-12-31", LISTING_ORDER)
    seeds = every.select("Seed_ID", "Job_ID")
    return inventory.explode_list(seeds, "Job_ID", "job_id")


@_query
def expected_seeds(spark, folder):
    return _expected(spark, folder).drop("ord")


@_query
def reconcile(spark, folder):
    listing = derive(spark, folder, "select *, (select count(*) from {lineitem}) as declared from ("
                     + INPUTS["warc_listing"] + ") w")
    return inventory.reconcile(listing, load(spark, folder, "audit_log"), START, END)


# ---- identifiers --------------------------------------------------------------------------------
def _parsed_reports(spark, folder) -> DataFrame:
    return (load(spark, folder, "seed_reports")
            .withColumn("relation_first", F.col("relation")).withColumnRenamed("relation", "relation_last"))


@_query
def departments(spark, folder):
    rows = identifiers.with_departments(_parsed_reports(spark, folder))
    return rows.select("seed_id", "department", "aip_title")


@_query
def collections(spark, folder):
    rows = identifiers.with_departments(_parsed_reports(spark, folder))
    return rows.select("seed_id", "archival_collection")


@_query
def sequence(spark, folder):
    rows = identifiers.with_sequence(identifiers.with_departments(_parsed_reports(spark, folder)))
    return rows.select("seed_id", "archival_collection", "sequence", "sequence_text")


@_query
def aip_metadata(spark, folder):
    return identifiers.aip_metadata(_parsed_reports(spark, folder), END)


@_query
def enrich(spark, folder):
    return inventory.enrich(seed_inventory(spark, folder), aip_metadata(spark, folder))


# ---- reports ------------------------------------------------------------------------------------
@_query
def classify_reports(spark, folder):
    rows = reports.classify_reports(load(spark, folder, "report_responses"))
    return rows.select("seed_id", "report_name", "outcome", "log_column", "message")


@_query
def report_names(spark, folder):
    rows = reports.with_report_name(load(spark, folder, "report_responses"))
    return rows.select("entity_id", "report_type", "report_name")


@_query
def reports_by_seed(spark, folder):
    """Outcomes of all reports by seed, then some seeds made again and some reset without rows."""
    place, number = _place(spark, "reports-now"), F.col("seed_id").cast("long")
    found = reports.classify_reports(load(spark, folder, "report_responses")).withColumn("redaction", F.lit(None).cast("string"))
    tables.replace_seeds(spark, place, found, found.select("seed_id"), runs.REPORT_STATE, buckets=32)
    again = found.filter(number % 7 == 0).withColumn("redaction", F.lit("again"))
    tables.replace_seeds(spark, place, again, again.select("seed_id"), runs.REPORT_STATE, buckets=32)
    dropped = found.filter(number % 11 == 0)
    tables.replace_seeds(spark, place, dropped.limit(0), dropped.select("seed_id"), runs.REPORT_STATE, buckets=32)
    return tables.read(spark, place, runs.REPORT_STATE)


@_query
def crawl_definitions(spark, folder):
    listed = inventory.accepted_rows(load(spark, folder, "warc_listing"))
    return reports.crawl_definitions(
        inventory.seed_jobs(listed, LISTING_ORDER), load(spark, folder, "crawl_jobs"),
        load(spark, folder, "held_definitions")).drop("ord")


@_query
def redact(spark, folder):
    responses = load(spark, folder, "seed_responses", customer=dealt(spark, folder, "customer", "c_custkey"))
    safe = reports.redact_seed_reports(reports.classify_reports(responses))
    events = reports.redaction_events(responses, safe)
    return events.join(safe.select("seed_id", "report_name", "body"), "seed_id").select("seed_id", "report_name", "body", "message")


# ---- WARCs --------------------------------------------------------------------------------------
@_query
def warc_locations(spark, folder):
    names = load(spark, folder, "warc_listing").select("filename")
    return warcs.warc_locations(names, load(spark, folder, "warc_index"), ("url",))


LANDED_FOLDERS = 64


def _files(rows: DataFrame, root: str) -> DataFrame:
    """Write ``content`` (bytes) of each ``filename`` below the root; adds ``path`` and ``length``. Null is no file.

    Files are dealt out over ``LANDED_FOLDERS`` folders: tasks that make files in the same folder wait for each other, and one task lists it.
    """
    kept = [f for f in rows.schema if f.name != "content"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = [f"{root}/some files #{zlib.crc32(str(name).encode()) % LANDED_FOLDERS}/{name}" for name in batch["filename"]]
            for path, content in zip(paths, batch["content"]):
                if content is not None:
                    streams.write_file(path, bytes(content))
            lengths = [len(c) if c is not None else 0 for c in batch["content"]]
            yield batch.drop(columns="content").assign(path=paths, length=lengths)

    place = f"{root}/table"
    rows.mapInPandas(run, f"{schema}, path string, length long").write.parquet(place)
    return rows.sparkSession.read.parquet(place)


@_query
def fixity(spark, folder):
    payloads = load(spark, folder, "payloads", pages=dealt(spark, folder, "pages", "page_id"))
    content = F.when(F.col("page_id") % 10 != 3, F.col("content").cast("binary"))
    stored = _files(payloads.select("filename", content.alias("content")), _place(spark, "payloads"))
    listed = payloads.select("filename", F.col("listed_md5").alias("md5"))
    checked = warcs.verify_fixity(listed, warcs.hash_files(stored), F.lit(CHECKED_AT).cast("timestamp_ntz"))
    return checked.select("filename", "md5", "actual_md5", "outcome", "message")


@F.pandas_udf(BinaryType())
def _zipped(content: pd.Series) -> pd.Series:
    """As gzip, long contents in two members."""
    def members(text: bytes) -> bytes:
        parts = [text[:1000], text[1000:]] if len(text) > 1000 else [text]
        return b"".join(gzip.compress(part, mtime=0) for part in parts)

    return content.map(lambda text: members(bytes(text)))


@_query
def decompress(spark, folder):
    root, number = _place(spark, "warcs"), F.col("page_id")
    rows = load(spark, folder, "payloads", pages=dealt(spark, folder, "pages", "page_id")).select("filename", "page_id", F.col("content").cast("binary").alias("content"))
    zipped = rows.withColumn("zipped", _zipped("content"))
    stored = (F.when(number % 19 == 0, F.lit(None))
              .when(number % 13 == 0, F.col("zipped").substr(F.lit(1), F.length("zipped") - 5))
              .when(number % 17 == 0, F.col("content")).otherwise(F.col("zipped")))
    todo = zipped.withColumn("content", stored).drop("zipped").withColumn(
        "md5", F.when(number % 7 == 0, F.repeat(F.lit("x"), F.lit(32))).otherwise(F.md5("content")))
    files = _files(todo, root).withColumn("target", F.concat(F.lit(f"{root}/unzipped #2/"), "filename"))
    place = f"{root}/results"
    warcs.verify_and_unzip(files).write.parquet(place)
    done = spark.read.parquet(place).join(files.select("filename", "md5", "target"), "filename")
    made = warcs.hash_files(done.filter(F.col("unzipped_size").isNotNull()).select(
        F.col("target").alias("path"), "filename", F.col("unzipped_size").alias("length")))
    tried = warcs.with_unzip_message(done.filter(F.col("actual_md5") == F.col("md5")).select("filename", "reason"))
    return (done.select("filename", "unzipped_size").join(made.select("filename", F.col("actual_md5").alias("unzipped_md5")), "filename", "left")
            .join(tried.select("filename", "message"), "filename", "left")
            .select("filename", "unzipped_md5", "unzipped_size", "message"))


@_query
def whole_run(spark, folder):
    """A batch landed as files, run from its listing to its audit: the seed log without the column that tells the time."""
    landed = _place(spark, "landed")
    listed, zipped = load(spark, folder, "batch_warcs", pages=dealt(spark, folder, "pages", "page_id")), F.col("zipped")
    content = F.when(zipped, _zipped(F.col("content").cast("binary"))).otherwise(F.col("content").cast("binary"))
    warc_rows = listed.withColumn("content", content).withColumn(
        "md5", F.when(F.col("same"), F.md5("content")).otherwise(F.repeat(F.lit("x"), F.lit(32))))
    # Zipped once: what follows takes the rows as written with the files.
    listed = _files(warc_rows.withColumn("content", F.expr("case when landed then content end")), f"{landed}/warcs")
    entry = F.struct("page_id", "filename", F.col("collection").cast("int").alias("collection"), F.col("job").cast("string").alias("crawl"), "size",
                     F.col("store_time").alias("store-time"), F.array(F.concat(F.lit("https://example.org/"), "filename")).alias("locations"),
                     F.create_map(F.lit("md5"), F.col("md5")).alias("checksums"))
    pages = listed.groupBy(F.lit("listing").alias("folder"), F.col("page").alias("name")).agg(F.array_agg(entry).alias("files"))
    ordered = F.array_sort("files", lambda a, b: F.signum(a["page_id"] - b["page_id"]).cast("int"))
    total = F.lit(listed.count()).alias("count")
    stores.write_files(pages.withColumn("body", F.to_json(F.struct(total, ordered.alias("files")))), landed)
    report = F.to_json(F.array(F.struct(F.struct(
        F.array(F.struct(F.when(F.col("seed") % 4 == 0, "Other").otherwise(V.DEPARTMENTS[0].collector).alias("value"))).alias("Collector"),
        F.array(F.struct(F.concat(F.lit("Title "), "seed").alias("value"))).alias("Title")).alias("metadata"))))
    seeds = listed.select("seed").distinct().select(F.col("seed").cast("string").alias("seed_id"), F.lit(200).alias("status"), report.alias("body"))
    seeds.write.json(f"{landed}/seed_reports")
    load(spark, folder, "batch_answers").write.json(f"{landed}/responses")
    batch = runs.Batch(landed, f"{landed}-results", "2023-04-01", "2023-05-02")
    runs.run_batch(spark, batch)
    return readers.as_saved(seedlog.read(spark, batch.log)).drop(V.FIXITY_ERRORS)


@_query
def warc_stage_outcomes(spark, folder):
    rows = load(spark, folder, "payloads").select(
        "filename", F.expr("case when page_id % 23 = 0 then 503 else 200 end").alias("info_status"),
        F.concat(F.lit("https://example.org/"), "filename").alias("url"), F.col("listed_md5").alias("md5"),
        F.expr("case when page_id % 13 = 0 then 404 else 200 end").alias("download_status"),
        F.expr("case when page_id % 17 = 0 then null else md5(content) end").alias("actual_md5"),
        F.expr("case when page_id % 19 = 0 then 'unexpected end of file' end").alias("reason"),
        F.lit(CHECKED_AT).cast("timestamp_ntz").alias("checked_at"))
    return warcs.warc_stage_outcomes(rows).select(
        "filename", "outcome", "download_message", "fixity_message", "unzip_message")


# ---- log ----------------------------------------------------------------------------------------
@_query
def fold_log(spark, folder):
    return status.fold_log(load(spark, folder, "seed_events"))


@_query
def completeness_status(spark, folder):
    folded = status.fold_log(load(spark, folder, "seed_events"))
    earlier = F.when(F.col("Seed_ID").cast("long") % 5 == 0, "Looked at by hand").otherwise(V.TBD)
    return status.completeness_status(folded.withColumn(V.COMPLETE, earlier)).select("Seed_ID", V.COMPLETE)


@_query
def completeness_events(spark, folder):
    return status.completeness_of_events(load(spark, folder, "seed_events"))


def _half_done_log(spark, folder) -> DataFrame:
    number = F.col("Seed_ID").cast("long") % 5
    complete = (F.when(number == 0, V.TBD).when(number == 1, F.lit(None)).when(number == 2, "  ")
                .otherwise("WARC_Download_Errors"))
    return status.fold_log(load(spark, folder, "seed_events")).withColumn(V.COMPLETE, complete)


@_query
def pending(spark, folder):
    return status.pending_seeds(_half_done_log(spark, folder)).select("Seed_ID", V.COMPLETE)


@_query
def pending_batch(spark, folder):
    return status.pending_batch(_half_done_log(spark, folder), 10).select("Seed_ID")


@_query
def reset(spark, folder):
    log = _half_done_log(spark, folder)
    return status.reset_seeds(log, status.pending_seeds(log).select(F.col("Seed_ID").alias("seed_id")))


@_query
def success_tally(spark, folder):
    rows = status.success_tally(_event_log(spark, folder))
    return rows.select("Seed_ID", "WARCs", *[f"{name}_Successes" for name in V.WARC_COLUMNS], "All_WARCs_Successful")


# ---- audit --------------------------------------------------------------------------------------
def _expected(spark, folder) -> DataFrame:
    return inventory.expected_seeds(load(spark, folder, "warc_listing"), load(spark, folder, "audit_log"),
                                    START, END, LISTING_ORDER)


def _typed_audit(spark, folder):
    return audit.audit_completeness(_expected(spark, folder), load(spark, folder, "stored_files")).drop("ord")


# The module of the audit operators has the name that its query has to have.
_QUERIES["audit"] = _typed_audit


@_query
def extra_folders(spark, folder):
    return audit.extra_folders(load(spark, folder, "audit_log"), load(spark, folder, "stored_files"))


def _audited_store(spark, folder) -> DataFrame:
    return audit.audit_store(_expected(spark, folder), load(spark, folder, "audit_log"),
                             load(spark, folder, "stored_files"))


@_query
def audit_again(spark, folder):
    """A second audit that takes from the first what has not changed since."""
    place, log = _place(spark, "audit"), load(spark, folder, "audit_log")

    def once(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{place}/{name}")
        return spark.read.parquet(f"{place}/{name}")

    expected = once(_expected(spark, folder), "expected")
    first, second = load(spark, folder, "earlier_files"), load(spark, folder, "stored_files")
    before = once(audit.audit_store(expected, log, first), "first")
    states_before = once(audit.folder_states(expected, log, first), "first-states")
    states = once(audit.folder_states(expected, log, second), "states")
    return audit.audit_changes(expected, log, second, None, states, before, states_before).drop("ord")


@_query
def audit_csv(spark, folder):
    return audit.completeness_report(_audited_store(spark, folder))


@_query
def qa_review(spark, folder):
    return audit.qa_failures(audit.qa_review(load(spark, folder, "audit_log"), _audited_store(spark, folder)))
