"""Single cases of each operator, with invented values."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from warcaudit.functions import columns as C
from warcaudit.functions import fixed_values as V
from warcaudit.operators import audit, identifiers, inventory, reports, status, warcs

LISTING = "page string, position int, filename string, collection string, crawl string, size long, store_time string"
MAGIL, HARGRETT, RUSSELL = (d.collector for d in V.DEPARTMENTS)


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# ---- listing rows -------------------------------------------------------------------------------
def test_seed_id_and_date(spark):
    names = ["A-SEED12-x", "A-SEED12-SEED34-x", "A-SEED-1", "SEED5-x", "A-seed5-x", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in values(df, C.seed_id(F.col("n")))] == ["12", "34", None, None, None, None]
    times = spark.createDataFrame([("2023-04-05T01:02:03Z",), ("2023-04-05",), ("x2023-04-05T",)], "t string")
    assert [r[0] for r in values(times, C.store_date(F.col("t")))] == ["2023-04-05", None, None]


def test_gigabytes_round_half_to_even(spark):
    sizes = [0, 499_999, 500_000, 500_001, 1_500_000, 2_500_000, 3_055_499_999, 8_200_500_000]
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    assert [r[0] for r in values(df, C.gigabytes(F.col("s")))] == [0.0, 0.0, 0.0, 0.001, 0.002, 0.002, 3.055, 8.2]


def test_padding_never_cuts(spark):
    df = spark.createDataFrame([(1,), (9999,), (12345,)], "n int")
    assert [r[0] for r in values(df, C.padded(F.col("n")))] == ["0001", "9999", "12345"]


def listing(spark):
    rows = [("p1", 0, "A-JOB9-SEED20-b.gz", "5", "9", 400_000, "2023-01-31T23:00:00Z"),
            ("p1", 1, "A-JOB2-SEED100-a.gz", "5", "2", 1, "2023-01-01T00:00:00Z"),
            ("p2", 0, "A-JOB3-SEED20-a.gz", "4", "3", 200_000, "2023-01-02T00:00:00Z"),
            ("p2", 1, "A-JOB9-SEED20-a.gz", "5", "9", 1, "2023-02-01T00:00:00Z"),
            ("p2", 2, "A-JOB9-NOSEED-a.gz", "5", "9", 1, "2023-01-01T00:00:00Z"),
            ("p2", 3, "A-JOB9-SEED30-a.gz", "5", "9", 1, "2023-01-01 00:00:00")]
    return spark.createDataFrame(rows, LISTING)


def test_inventory_keeps_listing_order_and_window(spark):
    got = inventory.seed_inventory(listing(spark), "2023-01-01", "2023-02-01").orderBy("Seed_ID").collect()
    assert [r.Seed_ID for r in got] == ["100", "20"]        # sorted as text
    twenty = got[1]
    assert (twenty.AIT_Collection, twenty.Job_ID, twenty.Size_GB, twenty.WARCs, twenty.WARC_Filenames) == (
        "5|4", "9|3", 0.001, 2, "A-JOB9-SEED20-b.gz|A-JOB3-SEED20-a.gz")
    assert all(twenty[c] == "TBD" for c in V.STATUS_COLUMNS)
    assert inventory.seed_inventory(listing(spark), "2023-01-01", "2023-01-01").count() == 0
    long = inventory.explode_list(spark.createDataFrame(got).select("Seed_ID", "Job_ID"), "Job_ID", "job_id")
    assert sorted(values(long)) == [("100", 0, "2"), ("20", 0, "9"), ("20", 1, "3")]


def test_rows_that_cannot_be_placed(spark):
    assert sorted(values(inventory.rejected_rows(listing(spark)), "filename", "reason")) == [
        ("A-JOB9-NOSEED-a.gz", "no seed id in file name"), ("A-JOB9-SEED30-a.gz", "no date in store time")]
    assert inventory.accepted_rows(listing(spark)).count() == 4
    with pytest.raises(Exception, match="cannot place listing row"):
        inventory.accepted_rows(listing(spark), strict=True).collect()


def test_expected_seeds_need_exactly_one_log_line(spark):
    log = spark.createDataFrame([("20", "aip-20"), ("100", "aip-1"), ("100", "aip-2"), ("999", "aip-9")], "Seed_ID string, AIP_ID string")
    expected = inventory.expected_seeds(listing(spark), log, "2023-01-01", "2023-02-01")
    assert values(expected, "seed_id", "aip_id", "warcs") == [("20", "aip-20", 2)]
    rows = listing(spark).withColumn("declared", F.lit(6))
    assert values(inventory.reconcile(rows, log, "2023-01-01", "2023-02-01")) == [(6, 2, 2, 2, False)]
    placed = rows.filter("position < 2").withColumn("declared", F.lit(4))
    assert values(inventory.reconcile(placed, log, "2023-01-01", "2023-02-01")) == [(4, 2, 2, 0, True)]
    assert values(inventory.reconcile(placed.limit(0), log, "2023-01-01", "2023-02-01")) == [(None, 0, 0, 0, None)]


# ---- identifiers --------------------------------------------------------------------------------
def test_aip_metadata(spark):
    rows = [("10", 200, RUSSELL, "RBRL/999", "RBRL/741: x", "T10"), ("11", 200, HARGRETT, "Hargrett box7: q: c", "no", "T11"),
            ("12", 200, MAGIL, None, None, "T12"), ("13", 500, None, None, None, None), ("14", 200, None, None, None, None),
            ("15", 200, "Other", None, None, "T15"), ("16", 200, RUSSELL, "RBRL/741: x", "RBRL/74", "T16"),
            ("17", 200, HARGRETT, None, None, "T17"), ("18", 200, RUSSELL, None, "RBRL/741", "T18"),
            ("19", 200, HARGRETT, "Hargrett :", None, "T19")]
    frame = spark.createDataFrame(rows, "seed_id string, status int, collector string, relation_first string, relation_last string, title string")
    assert values(identifiers.aip_metadata(frame.repartition(4), "2031-08-09")) == [
        ("magil", "magil-0000", "12", "magil-ggp-12-2031-08", "T12", "1"),
        ("russell", "rbrl-741", "10", "rbrl-741-web-203108-0001", "T10", "1"),
        ("hargrett", "harg-box7: q", "11", "harg-box7: q-web-203108-0001", "T11", "1"),
        ("russell", "rbrl-000", "16", "rbrl-000-web-203108-0001", "T16", "1"),
        ("hargrett", "harg-0000", "17", "harg-0000-web-203108-0001", "T17", "1"),
        ("russell", "rbrl-741", "18", "rbrl-741-web-203108-0002", "T18", "1"),
        ("hargrett", "harg-", "19", "harg--web-203108-0001", "T19", "1"),
        ("TBD: API error 500", "TBD", "13", "TBD", "TBD", "1"),
        ("TBD: no collector in Archive-It", "TBD: unexpected department value", "14", "TBD", "TBD: could not get title from Archive-It", "1"),
        ("TBD: unexpected collector value", "TBD: unexpected department value", "15", "TBD", "T15", "1")]
    with pytest.raises(ValueError):
        identifiers.aip_metadata(frame, "2031-8-9")


def test_enrich_keeps_every_seed(spark):
    seeds = spark.createDataFrame([("1", 5), ("2", 6)], "Seed_ID string, WARCs int")
    ids = spark.createDataFrame([("1", "aip-1")], "Folder string, AIP_ID string")
    joined = inventory.enrich(seeds, ids)
    assert joined.columns == ["AIP_ID", "Seed_ID", "WARCs"]
    assert sorted(values(joined), key=lambda r: r[1]) == [("aip-1", "1", 5), (None, "2", 6)]


# ---- reports ------------------------------------------------------------------------------------
def test_classify_reports(spark):
    rows = [("1", "a", "seed", "1", 1, 200, "x"), ("1", "a", "seedscope", "1", 2, 200, ""), ("1", "a", "collscope", "7", 3, 200, None),
            ("1", "a", "coll", "7", 4, 404, "x"), ("1", "a", "crawljob", "55", 5, 500, ""), ("1", "a", "crawldef", "66", 6, 200, "x")]
    frame = reports.classify_reports(spark.createDataFrame(
        rows, "seed_id string, aip_id string, report_type string, entity_id string, ord int, status int, body string"))
    assert values(reports.report_events(frame).orderBy("ord"), "log_column", "message") == [
        (V.METADATA_EMPTY, "a_seedscope.csv"), (V.METADATA_EMPTY, "a_collscope.csv"),
        (V.METADATA_ERRORS, "a_coll.csv API Error 404"), (V.METADATA_ERRORS, "a_55_crawljob.csv API Error 500")]
    assert values(reports.saved_reports(frame).orderBy("ord"), "report_name") == [("a_seed.csv",), ("a_66_crawldef.csv",)]


def test_crawl_definitions(spark):
    jobs = spark.createDataFrame([("1", "j1", 1), ("1", "j2", 2), ("1", "j3", 3), ("2", "j1", 4), ("2", "j4", 5)], "seed_id string, job_id string, ord int")
    rows = spark.createDataFrame([("j1", 0, "d1"), ("j1", 1, "d9"), ("j2", 0, "d1"), ("j4", 0, "d4")], "job_id string, row int, crawl_definition string")
    got = reports.crawl_definitions(jobs, rows).orderBy("seed_id", "ord")
    assert values(got, "seed_id", "kind", "crawl_definition", "message", "ord") == [
        ("1", "definition", "d1", None, 1),
        ("1", "error", None, "Error: crawl job j3 was not downloaded so can't get crawl definition id", 3),
        ("2", "definition", "d1", None, 4), ("2", "definition", "d4", None, 5)]
    held = spark.createDataFrame([("2", "d1"), ("3", "d4")], "seed_id string, crawl_definition string")
    left = reports.crawl_definitions(jobs, rows, held)
    assert sorted(values(left, "seed_id", "crawl_definition"), key=str) == [("1", "d1"), ("1", None), ("2", "d4")]


BODIES = {
    "both": ('url,login_username,login_password,private\nu,USER,PASS,t\nv,,,s\n',
             "url,login_username,login_password,private\nu,REDACTED,REDACTED,t\nv,REDACTED,REDACTED,s\n", "Successfully redacted"),
    "password": ('url,login_password\n"a, ""b""",P\nc\n',
                 'url,login_password,login_username\n"a, ""b""",REDACTED,REDACTED\nc,REDACTED,REDACTED\n', "Successfully redacted"),
    "user": ("url,login_username\na,U\n", "url,login_username\na,U\n", "No login columns to redact"),
    "none": ("url\na\n", "url\na\n", "No login columns to redact"), "empty": ("", "", "No login columns to redact"), "null": (None, None, None)}


def test_redacted_bodies(spark):
    frame = spark.createDataFrame([(k, v[0]) for k, v in BODIES.items()], "name string, body string")
    got = frame.select("name", reports.redacted(F.col("body")).alias("r")).select("name", "r.body", "r.message")
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {k: v[1:] for k, v in BODIES.items()}
    strict = frame.filter("name = 'user'").select(reports.redacted(F.col("body"), strict=True).alias("r")).first().r
    assert strict.message == "Successfully redacted" and "U\n" not in strict.body
    extra = frame.filter("name = 'none'").select(reports.redacted(F.col("body"), extra=["url", "absent"]).alias("r")).first().r
    assert tuple(extra) == ("url\nREDACTED\n", "No login columns to redact")


def test_seed_reports_are_safe_to_write(spark):
    rows = [("1", "seed", 200, BODIES["both"][0]), ("2", "seed", 200, BODIES["user"][0]), ("3", "seed", 500, "login_password\nP\n"),
            ("1", "coll", 200, "id\n7\n"), ("4", "seed", 200, "")]
    frame = spark.createDataFrame([(s, f"aip-{s}", t, s, 1, c, b) for s, t, c, b in rows],
                                  "seed_id string, aip_id string, report_type string, entity_id string, ord int, status int, body string")
    safe = reports.redact_seed_reports(reports.classify_reports(frame))
    assert sorted(values(safe, "seed_id", "report_type", "body", "redaction"), key=str) == sorted([
        ("1", "seed", BODIES["both"][1], "Successfully redacted"), ("2", "seed", BODIES["user"][0], "No login columns to redact"),
        ("3", "seed", None, None), ("1", "coll", "id\n7\n", None), ("4", "seed", None, None)], key=str)
    seeds = spark.createDataFrame([(s,) for s in "12345"], "seed_id string")
    assert dict(values(reports.redaction_events(seeds, safe), "seed_id", "message")) == {
        "1": "Successfully redacted", "2": "No login columns to redact", **{s: "No seeds.csv to redact" for s in "345"}}



# ---- WARCs --------------------------------------------------------------------------------------
def test_locations_come_from_the_first_listing_row(spark):
    rows = spark.createDataFrame([("a", "u2", "m2", 2), ("a", "u1", "m1", 1), ("b", None, "m", 1), ("c", "u", None, 1)],
                                 "filename string, url string, md5 string, position int")
    names = spark.createDataFrame([(n,) for n in "abcd"], "filename string")
    got = warcs.warc_locations(names, rows, ["position"]).orderBy("filename")
    missing = "Index Error: cannot get the WARC URL or MD5 for "
    assert values(got, "filename", "url", "md5", "message") == [
        ("a", "u1", "m1", None), ("b", None, None, missing + "b"), ("c", None, None, missing + "c"), ("d", None, None, missing + "d")]


def test_verify_fixity(spark):
    listed = spark.createDataFrame([("a", "m"), ("b", "x"), ("c", "m"), ("d", None)], "filename string, md5 string")
    files = spark.createDataFrame([("a", "m"), ("b", "y"), ("d", "m")], "filename string, actual_md5 string")
    at = F.lit("2031-08-09 10:11:12.131415").cast("timestamp")
    got = warcs.verify_fixity(listed, files, at).orderBy("filename")
    assert values(got, "outcome", "message") == [
        ("verified", "Successfully verified a fixity on 2031-08-09 10:11:12.131415"),
        ("changed", "Error: fixity for b changed and it was deleted: x before, y after"),
        ("not computable", "Error: fixity for c cannot be extracted from md5deep output: b''"), ("not listed", None)]


def test_stages_stop_at_the_first_failure(spark):
    at = datetime.datetime(2023, 1, 2, 3, 4, 5, 6)
    rows = [("s", 1, "a", 500, "u", "m", 200, "m", None, at), ("s", 2, "b", 200, None, None, 200, "m", None, at),
            ("s", 3, "c", 200, "u", "m", 404, "m", None, at), ("s", 4, "d", 200, "u", "m", 200, None, None, at),
            ("s", 5, "e", 200, "u", "m", 200, "n", None, at), ("s", 6, "f", 200, "u", "m", 200, "m", "bad", at),
            ("s", 7, "g", 200, "u", "m", 200, "m", None, at)]
    outcomes = warcs.warc_stage_outcomes(spark.createDataFrame(
        rows, "seed_id string, ord int, filename string, info_status int, url string, md5 string, download_status int, "
              "actual_md5 string, reason string, checked_at timestamp"))
    assert values(outcomes.orderBy("ord"), "outcome") == [
        ("not located",), ("not located",), ("not downloaded",), ("fixity unknown",), ("fixity changed",), ("not unzipped",), ("done",)]
    folded = status.fold_log(warcs.stage_events(outcomes)).first()
    assert folded[V.DOWNLOAD_ERRORS] == (
        "API Error 500: can't get info about a; Index Error: cannot get the WARC URL or MD5 for b; API Error 404: can't download c; "
        "Successfully downloaded d; Successfully downloaded e; Successfully downloaded f; Successfully downloaded g")
    assert folded[V.FIXITY_ERRORS] == (
        "Error: fixity for d cannot be extracted from md5deep output: b''; Error: fixity for e changed and it was deleted: m before, n after; "
        "Successfully verified f fixity on 2023-01-02 03:04:05.000006; Successfully verified g fixity on 2023-01-02 03:04:05.000006")
    assert folded[V.UNZIP_ERRORS] == "Error unzipping f: bad; Successfully unzipped g"
    assert folded[V.METADATA_ERRORS] == "TBD"


# ---- log ----------------------------------------------------------------------------------------
def log_frame(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("Seed_ID", *V.STATUS_COLUMNS)))


def test_completeness_status(spark):
    ok = ("Successfully x",) * 6
    log = log_frame(
        spark, ("1", *ok, "TBD"), ("2", "a API Error 404", "Error", "Error", "Index Error: b; Successfully c", "Error: d", "Error e", "TBD"),
        ("3", "API error 404", *ok[:5], "TBD"), ("4", *ok[:4], "Error", "x", "By hand"), ("5", *ok, "By hand"), ("6", *ok, None),
        ("7", None, *ok[:5], " "))
    got = dict(values(status.completeness_status(log), "Seed_ID", "Complete"))
    assert got == {
        "1": "Successfully completed", "2": "Metadata_Report_Errors; WARC_Download_Errors; WARC_Fixity_Errors; WARC_Unzip_Errors",
        "3": "Successfully completed", "4": "By hand; WARC_Fixity_Errors", "5": "By hand", "6": "Successfully completed",
        "7": "Successfully completed"}


def test_append_message(spark):
    df = spark.createDataFrame([("TBD",), ("first",), ("TBD; x",)], "c string")
    assert [r[0] for r in values(df, status.append_message(F.col("c"), F.lit("new")))] == ["new", "first; new", "TBD; x; new"]


def test_report_columns_without_messages(spark):
    log = log_frame(spark, ("1", "TBD", "TBD", "TBD", "TBD", "TBD", "TBD", "TBD"), ("2", "x", "y", "TBD", "TBD", "TBD", "TBD", "TBD"))
    got = values(status.finish_report_columns(log).orderBy("Seed_ID"), V.METADATA_ERRORS, V.METADATA_EMPTY)
    assert got == [("Successfully downloaded all metadata reports", "No empty reports"), ("x", "y")]


def test_pending_and_reset(spark):
    t = ("TBD",) * 6
    log = log_frame(spark, ("10", *("x",) * 6, "TBD"), ("2", *("x",) * 6, None), ("30", *t, " "), ("4", *t, "Successfully completed"),
                    ("5", *("x",) * 6, "WARC_Fixity_Errors"))
    assert sorted(r.Seed_ID for r in status.pending_seeds(log).collect()) == ["10", "2", "30"]
    assert [r.Seed_ID for r in status.pending_batch(log, 2).collect()] == ["10", "2"]
    again = spark.createDataFrame([("2",), ("2",), ("absent",)], "seed_id string")
    got = {r.Seed_ID: tuple(r)[1:] for r in status.reset_seeds(log, again).collect()}
    assert got["2"] == (*t, None) and got["10"] == (*("x",) * 6, "TBD") and len(got) == 5


def test_success_tally(spark):
    log = spark.createDataFrame([("1", "2", "Successfully a; successfully b", "SUCCESSFULLY a; Successfully b", "Successfully a; Successfully b"),
                                 ("2", "2", "Successfully a; Error b", "Successfully a", None)],
                                f"Seed_ID string, WARCs string, {', '.join(c + ' string' for c in V.WARC_COLUMNS)}")
    got = status.success_tally(log).orderBy("Seed_ID").collect()
    assert [tuple(r)[-4:] for r in got] == [(2, 2, 2, True), (1, 1, 0, False)]


# ---- audit --------------------------------------------------------------------------------------
EXPECTED = "seed_id string, aip_id string, warcs long, ord int"
REPORTS = ("coll", "collscope", "seed", "seedscope")


def folder(seed, aip, kinds=REPORTS, definitions=1, jobs=1, count=1, extra=()):
    names = [f"{aip}_{kind}.csv" for kind in kinds]
    names += [f"{aip}_{i}_crawldef.csv" for i in range(definitions)] + [f"{aip}_{i}_crawljob.csv" for i in range(jobs)]
    names += [f"AIT-SEED{seed}-{i}.warc" for i in range(count)]
    return [(seed, name) for name in [*names, *extra]]


def audit_tables(spark):
    expected = spark.createDataFrame([("3", "aip-3", 1, 1), ("1", "aip-1", 2, 2), ("2", "aip-2", 1, 3), ("4", "aip-4", 2, 4),
                                      ("5", "aip-5", 1, 5), ("6", "aip-6", 1, 6)], EXPECTED)
    files = [*folder("1", "aip-1", count=2), *folder("2", "aip-2", kinds=REPORTS[:3], definitions=2, jobs=3, extra=["aip-2_new-log.csv"]),
             *folder("3", "aip-3", kinds=(), definitions=0, jobs=0), *folder("4", "aip-9"), *folder("5", "aip-5", extra=["sub/x.warc"]),
             ("extra1", "x.warc"), ("8", "aip-8_coll.csv"), ("stray.txt", None), ("metadata.csv", None)]
    log = spark.createDataFrame([(str(i), f"aip-{i}") for i in (1, 2, 3, 4, 5, 6, 8)], "Seed_ID string, AIP_ID string")
    return expected, spark.createDataFrame(files, "folder string, name string").repartition(3), log


def test_completeness_report(spark):
    expected, files, log = audit_tables(spark)
    report = audit.completeness_report(audit.audit_store(expected, log, files))
    assert tuple(report.columns) == V.COMPLETENESS_HEADER
    assert values(report) == [
        ("3", "aip-3", "True", "False", "False", "False", "False", "0", "0", "True", "True"),
        ("1", "aip-1", "True", "True", "True", "True", "True", "1", "1", "True", "True"),
        ("2", "aip-2", "True", "True", "True", "True", "False", "2", "3", "True", "False"),
        ("4", "aip-4", "True", "False", "False", "False", "False", "1", "1", "False", "True"),
        ("5", "aip-5", "True", "True", "True", "True", "True", "1", "1", "True", "False"),
        ("6", "aip-6", "False", *["missing"] * 8),
        ("extra1", *["Not expected"] * 10), ("stray.txt", *["Not expected"] * 10)]
    alone = audit.audit_completeness(expected, files)
    assert values(audit.completeness_report(alone)) == values(report)[:6]
    assert sorted(values(audit.extra_folders(log, files))) == [("extra1",), ("stray.txt",)]


def test_empty_folders_come_from_their_own_table(spark):
    expected, files, log = audit_tables(spark)
    folders = spark.createDataFrame([("6",), ("1",), ("empty-extra",)], "folder string")
    row = audit.audit_completeness(expected, files, folders).filter("seed_id = '6'").first()
    assert (row.folder_made, row.has_coll, row.crawldef_count, row.warc_count_correct, row.file_types_expected) == (True, False, 0, False, True)
    assert "empty-extra" in [r.folder for r in audit.extra_folders(log, files, folders).collect()]
    assert audit.audit_completeness(expected, files, folders).filter("seed_id = '1'").first().warc_count_correct
    states = {r.seed_id: r.state for r in audit.audit_store(expected, log, files, folders).collect()}
    assert (states["6"], states["empty-extra"], states["extra1"], "8" in states) == ("present", "unexpected", "unexpected", False)


def test_only_what_changed_is_audited_again(spark):
    expected, files, log = audit_tables(spark)
    folders = spark.createDataFrame([("6",), ("empty-extra",)], "folder string")
    states = audit.folder_states(expected, log, files, folders)
    assert sorted(values(states)) == sorted(values(audit.folder_states(expected, log.repartition(4), files.orderBy("name").repartition(5), folders)))
    before = audit.audit_store(expected, log, files, folders)
    # A mark that only rows taken from the earlier audit can carry.
    marked = before.withColumn("crawldef_count", F.lit(77).cast("long"))
    added = spark.createDataFrame([("1", "aip-1_2_crawldef.csv"), ("new", "y.warc")], "folder string, name string")
    later = files.filter("not (folder = '5' and name = 'sub/x.warc') and folder <> 'extra1'").unionByName(added)
    wanted = expected.withColumn("warcs", F.when(F.col("seed_id") == "4", 1).otherwise(F.col("warcs")).cast("long"))
    now = audit.folder_states(wanted, log, later, folders)
    got = {r.seed_id: r for r in audit.audit_changes(wanted, log, later, folders, now, marked, states).collect()}
    want = {r.seed_id: r for r in audit.audit_store(wanted, log, later, folders).collect()}
    fresh = {"1", "4", "5", "new"}
    assert got.keys() == want.keys() and "extra1" not in got and {s for s, r in got.items() if r.crawldef_count != 77} == fresh
    for seed, row in got.items():
        assert {**row.asDict(), "crawldef_count": 0} == {**want[seed].asDict(), "crawldef_count": 0}
    none = audit.audit_changes(expected, log, files, folders, states, marked, states)
    assert {r.crawldef_count for r in none.collect()} == {77}


def test_qa_review(spark):
    expected, files, log = audit_tables(spark)
    typed = audit.audit_store(expected, log, files)
    two, one = "Successfully a; Successfully b", "Successfully a"
    empty = {"2": "aip-2_seedscope.csv", "3": "aip-3_seedscope.csv; aip-3_collscope.csv; aip-3_coll.csv"}
    lines = [(f"aip-{s}", s, n, V.ALL_REPORTS_SAVED if s != "5" else "x API Error 1", empty.get(s, V.NO_EMPTY_REPORTS),
              V.REDACTION_NO_REPORT if s == "4" else V.REDACTION_DONE, m, m, m)
             for s, n, m in (("1", 2, two), ("2", 1, one), ("3", 1, one), ("4", 2, one), ("5", 1, one), ("6", 1, one))]
    table = spark.createDataFrame(lines, "AIP_ID string, Seed_ID string, WARCs int, " + ", ".join(f"{c} string" for c in V.PROGRESS_COLUMNS))
    failed = {r.seed_id: {c for c in r.asDict() if c.endswith("_ok") and not r[c]} for r in audit.qa_review(table, typed).collect()}
    assert failed["1"] == set()
    assert failed["2"] == {"file_types_ok"}
    assert failed["3"] == {"reports_ok", "other_reports_ok"}
    assert failed["4"] == {"reports_ok", "scopes_ok", "warc_count_ok", "redaction_ok", "warc_messages_ok"}
    assert failed["5"] == {"file_types_ok", "report_errors_ok"}
    assert {"folder_ok", "reports_ok"} <= failed["6"] and "folder_ok" in failed["extra1"]
    assert "1" not in [r.seed_id for r in audit.qa_failures(audit.qa_review(table, typed)).collect()]
