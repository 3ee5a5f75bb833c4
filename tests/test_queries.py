"""Every registered query against its SQL on the smallest data set, and the plans that matter."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from check_queries import compare, connect
from warcaudit.plans import oracles, registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", registry.all_queries())
def test_query(spark, con, name):
    difference, rows = compare(spark, con, FOLDER, name)
    assert difference is None and rows > 0


def test_every_query_has_sql():
    assert set(registry.all_queries()) == set(oracles.all_oracles())
    assert set(registry.all_queries()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_reaches_the_scan(spark):
    text = plan(registry.date_window(spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "l_extendedprice" not in text.split("ReadSchema")[1].split("\n")[0]


def test_inventory_shuffles_once_and_does_not_sort_the_whole(spark):
    text = plan(registry.seed_inventory(spark, FOLDER))
    assert text.count("Exchange hashpartitioning(seed_id") == 1 and text.count("Exchange") == 1


def test_messages_are_folded_in_one_shuffle(spark):
    text = plan(registry.fold_log(spark, FOLDER))
    assert text.count("Exchange hashpartitioning(seed_id") == 1 and text.count("Exchange") == 1


def test_reports_are_read_and_redacted_without_python(spark):
    for name in ("report_scan", "redact", "crawl_definitions", "listing_scan"):
        text = plan(registry.all_queries()[name](spark, FOLDER))
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text, name


def test_nothing_is_broadcast_by_order(spark):
    """Only the one-row total is broadcast by a hint; everything else is left to Spark's own size check."""
    for name in ("audit", "enrich", "crawl_definitions", "warc_locations", "expected_seeds"):
        assert "strategy=broadcast" not in registry.all_queries()[name](spark, FOLDER)._jdf.queryExecution().logical().toString()


def test_landed_files_are_dealt_over_folders(spark, tmp_path):
    rows = [(f"f{k}.gz", k, None if k % 7 == 0 else bytearray(b"x" * k)) for k in range(300)] + [(None, 300, None)]
    files = registry._files(spark.createDataFrame(rows, "filename string, k int, content binary"), str(tmp_path)).collect()
    assert {(r.filename, r.k, r.length) for r in files} == {(name, k, len(body or b"")) for name, k, body in rows}
    assert {r.k for r in files if os.path.exists(r.path)} == {k for _, k, body in rows if body is not None}
    assert len({os.path.dirname(r.path) for r in files}) > 30
