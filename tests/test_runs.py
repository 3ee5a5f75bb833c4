"""Whole runs on a small landed batch: first run, batches, interruption, audit."""

from __future__ import annotations

import gzip
import hashlib
import json
import os

import pytest

from warcaudit.operators import inventory, warcs
from warcaudit.plans import runs
from warcaudit.sources import readers, seedlog, tables

MAGIL = "Map and Government Information Library"
RUSSELL = "Richard B. Russell Library for Political Research and Studies"


def warc(seed, job, number):
    return f"AIT-77-TEST-JOB{job}-SEED{seed}-2023041{number}000000-0000{number}-h3.warc.gz"


def write_lines(path, records):
    os.makedirs(path)
    with open(os.path.join(path, "part.json"), "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)


@pytest.fixture()
def landed(tmp_path):
    """Three seeds: one complete, one with a damaged and an unlisted WARC, one without usable reports."""
    root = str(tmp_path / "landed")
    content = {warc(11, 501, 1): gzip.compress(b"one") + gzip.compress(b" two"), warc(11, 502, 2): gzip.compress(b"x" * 99),
               warc(22, 503, 1): b"damaged", warc(22, 503, 2): gzip.compress(b"fine"), warc(33, 504, 1): gzip.compress(b"z")}
    listed = {name: hashlib.md5(data).hexdigest() for name, data in content.items()}
    listed[warc(22, 503, 1)] = "x" * 32
    listed[warc(22, 503, 3)] = "y" * 32          # listed but not landed
    files = []
    for name, md5 in listed.items():
        seed, job = name.split("SEED")[1].split("-")[0], name.split("JOB")[1].split("-")[0]
        files.append({"filename": name, "collection": 77, "crawl": int(job), "size": 500_000, "store-time": "2023-04-20T01:02:03Z",
                      "locations": [f"https://example.org/{name}"], "checksums": {"md5": md5}, "seed": seed})
    files.append({**files[0], "filename": warc(44, 505, 1), "store-time": "2023-07-01T00:00:00Z"})
    os.makedirs(f"{root}/listing")
    for page, part in enumerate([files[:3], files[3:]]):
        with open(f"{root}/listing/page-{page:04d}.json", "w") as out:
            json.dump({"count": len(files), "files": part}, out, indent=1)

    def report(collector, title, *relations):
        fields = {"Collector": [{"value": collector}], "Title": [{"value": title}]}
        if relations:
            fields["Relation"] = [{"value": r} for r in relations]
        return json.dumps([{"metadata": fields}])

    write_lines(f"{root}/seed_reports", [
        {"seed_id": "11", "status": 200, "body": report(MAGIL, "Eleven")},
        {"seed_id": "22", "status": 200, "body": report(RUSSELL, "Twenty-two", "Other", "RBRL/123: papers")},
        {"seed_id": "33", "status": 500, "body": ""}])
    csv = "id,crawl_definition\n{},{}\n".format
    responses = [
        ("seed", "11", 200, "url,login_username,login_password\nhttp://a,USER,PASS\n"), ("seedscope", "11", 200, ""),
        ("collscope", "77", 200, "scope\nall\n"), ("coll", "77", 200, "id,name\n77,\"A, B\"\n"),
        ("crawljob", "501", 200, csv(501, 9001)), ("crawljob", "502", 200, csv(502, 9001)), ("crawldef", "9001", 200, "id\n9001\n"),
        ("seed", "22", 200, "url\nhttp://b\n"), ("seedscope", "22", 200, "scope\nnone\n"), ("crawljob", "503", 500, ""),
        ("seed", "33", 404, ""), ("seedscope", "33", 200, ""), ("crawljob", "504", 200, csv(504, 9002)), ("crawldef", "9002", 200, "id\n9002\n")]
    write_lines(f"{root}/responses", [dict(zip(("report_type", "entity_id", "status", "body"), r)) for r in responses])
    os.makedirs(f"{root}/warcs/in")
    for name, data in content.items():
        with open(f"{root}/warcs/in/{name}", "wb") as out:
            out.write(data)
    return root


def by_seed(spark, batch):
    return {r.Seed_ID: r for r in seedlog.read(spark, batch.log).collect()}


def stored(batch):
    return {seed: sorted(n for n in os.listdir(f"{batch.store}/{seed}") if not n.startswith("."))
            for seed in sorted(os.listdir(batch.store))}


def check_finished(spark, batch, run):
    log = by_seed(spark, batch)
    eleven, two, three = log["11"], log["22"], log["33"]
    assert eleven.AIP_ID == "magil-ggp-11-2023-05" and eleven.Job_ID == "501|502" and eleven.Size_GB == 0.001
    assert eleven.Metadata_Report_Errors == "Successfully downloaded all metadata reports"
    assert eleven.Metadata_Report_Empty == "magil-ggp-11-2023-05_seedscope.csv"
    assert eleven.Seed_Report_Redaction == "Successfully redacted"
    assert eleven.WARC_Unzip_Errors == f"Successfully unzipped {warc(11, 501, 1)}; Successfully unzipped {warc(11, 502, 2)}"
    assert eleven.Complete == "Successfully completed"
    assert two.AIP_ID == "rbrl-123-web-202305-0001" and two.WARCs == 3
    assert two.Metadata_Report_Errors == (
        "rbrl-123-web-202305-0001_503_crawljob.csv API Error 500; "
        "Error: crawl job 503 was not downloaded so can't get crawl definition id")
    assert two.Metadata_Report_Empty == "No empty reports"
    assert two.Seed_Report_Redaction == "No login columns to redact"
    assert two.WARC_Download_Errors == (
        f"Successfully downloaded {warc(22, 503, 1)}; Successfully downloaded {warc(22, 503, 2)}; "
        f"API Error 404: can't download {warc(22, 503, 3)}")
    assert two.WARC_Fixity_Errors.startswith(f"Error: fixity for {warc(22, 503, 1)} changed and it was deleted: {'x' * 32} before, ")
    assert two.WARC_Unzip_Errors == f"Successfully unzipped {warc(22, 503, 2)}"
    assert two.Complete == "Metadata_Report_Errors; WARC_Download_Errors; WARC_Fixity_Errors"
    assert three.AIP_ID == "TBD" and three.Seed_Report_Redaction == "No seeds.csv to redact"
    assert stored(batch) == {
        "11": sorted([warc(11, 501, 1)[:-3], warc(11, 502, 2)[:-3], "magil-ggp-11-2023-05_501_crawljob.csv",
                      "magil-ggp-11-2023-05_502_crawljob.csv", "magil-ggp-11-2023-05_9001_crawldef.csv",
                      "magil-ggp-11-2023-05_coll.csv", "magil-ggp-11-2023-05_collscope.csv", "magil-ggp-11-2023-05_seed.csv"]),
        "22": sorted([warc(22, 503, 2)[:-3], "rbrl-123-web-202305-0001_coll.csv", "rbrl-123-web-202305-0001_collscope.csv",
                      "rbrl-123-web-202305-0001_seed.csv", "rbrl-123-web-202305-0001_seedscope.csv"]),
        "33": sorted([warc(33, 504, 1)[:-3], "TBD_504_crawljob.csv", "TBD_9002_crawldef.csv", "TBD_coll.csv", "TBD_collscope.csv"])}
    with open(f"{batch.store}/11/{warc(11, 501, 1)[:-3]}", "rb") as file:
        assert file.read() == b"one two"
    with open(f"{batch.store}/11/magil-ggp-11-2023-05_seed.csv") as file:
        assert file.read() == "url,login_username,login_password\nhttp://a,REDACTED,REDACTED\n"
    report = readers.read_report(spark, batch.place("completeness_check", run)).collect()
    assert [tuple(r) for r in report] == [
        ("11", "magil-ggp-11-2023-05", "True", "True", "True", "True", "False", "1", "2", "True", "True"),
        ("22", "rbrl-123-web-202305-0001", "True", "True", "True", "True", "True", "0", "0", "False", "True"),
        ("33", "TBD", "True", "True", "True", "False", "False", "1", "1", "True", "True")]


def test_whole_run(spark, landed, tmp_path):
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    run = runs.run_batch(spark, batch)
    check_finished(spark, batch, run)
    metadata = readers.read_report(spark, batch.place("metadata", "run-0000")).collect()
    assert [tuple(r)[2:4] for r in metadata] == [("11", "magil-ggp-11-2023-05"), ("22", "rbrl-123-web-202305-0001"), ("33", "TBD")]


def test_pages_are_parsed_once_for_the_listing(spark, landed, tmp_path, monkeypatch):
    """What is cut into ranges is read twice, once for a sample: that must not be the pages."""
    plans, write = [], runs.writers.write_listing

    def spy(listing, path):
        plans.append(listing._jdf.queryExecution().executedPlan().toString())
        write(listing, path)

    monkeypatch.setattr(runs.writers, "write_listing", spy)
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    runs.prepare_log(spark, batch, "run-0000")
    assert len(plans) == 1 and "json" not in plans[0].lower()
    assert readers.read_listing_table(spark, batch.listing).count() == readers.read_listing(spark, f"{landed}/listing").count() > 0


def test_nothing_is_kept_or_lost_silently(spark, landed, tmp_path):
    """No password in any result; doubled answers and listing rows change nothing; unplaceable rows are a table."""
    with open(f"{landed}/responses/part.json") as lines:
        first = lines.readline()
    with open(f"{landed}/responses/part.json", "a") as lines:
        lines.write(first)
    with open(f"{landed}/listing/page-0000.json") as page:
        pages = json.load(page)
    odd = [{**pages["files"][0]}, {**pages["files"][0], "filename": "AIT-77-no-seed.warc.gz"}]
    with open(f"{landed}/listing/page-0002.json", "w") as page:
        json.dump({"count": pages["count"], "files": odd}, page)
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    run = runs.run_batch(spark, batch)
    for folder, _, names in os.walk(tmp_path / "out"):
        for name in names:
            with open(os.path.join(folder, name), "rb") as file:
                assert b"PASS" not in file.read(), name
    # Parquet may hide a text from a search of the bytes, so the tables are searched as well.
    bodies = [r.body or "" for r in spark.read.parquet(batch.place("reports", run)).collect()]
    assert any("REDACTED" in b for b in bodies) and not any("PASS" in b for b in bodies)
    assert stored(batch)["11"][:2] == sorted([warc(11, 501, 1)[:-3], warc(11, 502, 2)[:-3]])
    table = {t: spark.read.parquet(batch.place(t, run)).collect() for t in ("rejects", "reconcile", "success_tally", "qa_review")}
    assert [(r.filename, r.reason) for r in table["rejects"]] == [("AIT-77-no-seed.warc.gz", "no seed id in file name")]
    assert table["reconcile"][0].rejected == 1 and {r.Seed_ID for r in table["success_tally"]} == {"11", "22", "33"}
    assert {r.seed_id for r in table["qa_review"]} >= {"22"}
    log = sorted(by_seed(spark, batch).items())
    again = runs.run_batch(spark, batch)
    assert again != run and sorted(by_seed(spark, batch).items()) == log


def test_damaged_landed_data_is_set_aside(spark, landed, tmp_path):
    """The run goes on without it, and the quarantine says which it was; a strict run stops."""
    cut = '{"report_type": "seed", "entity'
    with open(f"{landed}/responses/part.json", "a") as lines:
        lines.write(cut)
    with open(f"{landed}/listing/page-0009.json", "w") as page:
        page.write("<html>busy</html>")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        runs.run_batch(spark, runs.Batch(landed, str(tmp_path / "strict"), "2023-04-01", "2023-05-02", strict=True))
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    run = runs.run_batch(spark, batch)
    check_finished(spark, batch, run)
    rows = spark.read.parquet(batch.place("quarantine", run)).collect()
    assert sorted((r.source, r.file, r.chars) for r in rows) == [("listing page", "page-0009.json", 17), ("response line", "part.json", len(cut))]
    assert {r.sha256 for r in rows} == {hashlib.sha256(x.encode()).hexdigest() for x in (cut, "<html>busy</html>")}


def test_seeds_that_are_reset_are_made_again(spark, landed, tmp_path):
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    runs.run_batch(spark, batch)
    state = lambda: {(r.seed_id, r.report_name.rsplit("_", 1)[1], r.outcome) for r in tables.read(spark, batch.reports_now, runs.REPORT_STATE).collect()}
    before_reset = state()
    assert ("11", "seed.csv", "saved") in before_reset and ("22", "crawljob.csv", "error") in before_reset and ("33", "seedscope.csv", "empty") in before_reset
    runs.reset_seeds(spark, batch, spark.createDataFrame([("22",)], "seed_id string"))
    assert state() == {r for r in before_reset if r[0] != "22"}
    log = by_seed(spark, batch)
    assert log["22"].Complete == "TBD" and log["22"].WARC_Unzip_Errors == "TBD" and log["11"].Complete == "Successfully completed"
    before = os.stat(f"{batch.store}/11/{warc(11, 501, 1)[:-3]}").st_mtime_ns
    os.makedirs(f"{batch.store}/empty")
    run = runs.run_batch(spark, batch)
    assert state() == before_reset
    assert run == "run-0003" and spark.read.parquet(f"{batch.log}/000003-rows").count() == 1
    assert os.stat(f"{batch.store}/11/{warc(11, 501, 1)[:-3]}").st_mtime_ns == before
    report = {r[0]: r[1] for r in readers.read_report(spark, batch.place("completeness_check", run)).collect()}
    assert report["empty"] == "Not expected"
    os.rmdir(f"{batch.store}/empty")
    check_finished(spark, batch, runs.run_batch(spark, batch))


def test_a_run_reads_only_its_window(spark, landed, tmp_path):
    """URL and MD5 come with the rows of the window; the whole listing is not shuffled for them."""
    listing = readers.read_listing(spark, f"{landed}/listing")
    rows = inventory.rows_in_window(listing, "2023-04-01", "2023-05-02")
    names = rows.select("seed_id", "filename")
    text = warcs.warc_locations(names, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("store_time") and text.count("2023-04-01") >= 2


def test_small_batches_and_interruption(spark, landed, tmp_path):
    """One seed at a time, with what an interrupted run left behind, ends like one run over everything."""
    batch = runs.Batch(landed, str(tmp_path / "out"), "2023-04-01", "2023-05-02")
    runs.run_batch(spark, batch, size=1)
    log = by_seed(spark, batch)
    assert log["11"].Complete == "Successfully completed" and log["22"].Complete == "TBD" and log["33"].WARC_Download_Errors == "TBD"
    os.makedirs(f"{batch.store}/22")
    with open(f"{batch.store}/22/left-over.txt", "w") as file:
        file.write("half done")
    before = os.stat(f"{batch.store}/11/{warc(11, 501, 1)[:-3]}").st_mtime_ns
    check_finished(spark, batch, runs.run_batch(spark, batch))
    assert os.stat(f"{batch.store}/11/{warc(11, 501, 1)[:-3]}").st_mtime_ns == before


def test_dates_are_checked(tmp_path):
    for start, end in (("2023-1-01", "2023-02-01"), ("2023-01-01x", "2023-02-01"), ("2023-03-01", "2023-02-01")):
        with pytest.raises(ValueError):
            runs.Batch(str(tmp_path), str(tmp_path), start, end)
    runs.Batch(str(tmp_path), str(tmp_path), "2023-01-01", "2023-01-01")
