"""Tables by seed: a change rewrites the buckets of its seeds only, and survives being stopped anywhere."""

from __future__ import annotations

import json
import os

import pytest

from warcaudit.sources import tables

SCHEMA = "seed_id string, note string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def seeds(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "seed_id string")


def now(spark, path):
    return sorted(tuple(r) for r in tables.read(spark, path, SCHEMA).collect())


def times(path):
    return {n: os.stat(f"{path}/{n}").st_mtime_ns for n in os.listdir(path) if n.startswith("bucket=")}


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(str(k), f"first {i}", i) for k in range(200) for i in range(2)]
    tables.replace_seeds(spark, path, frame(spark, rows), seeds(spark, *map(str, range(200))), SCHEMA, buckets=64)
    return path, rows


def test_a_reset_of_ten_seeds_rewrites_their_buckets_only(spark, table):
    path, rows = table
    assert now(spark, path) == sorted(rows)
    before, again = times(path), [str(k) for k in range(0, 200, 20)]
    changed = tables.replace_seeds(spark, path, frame(spark, [(s, "again", 7) for s in again[:9]]), seeds(spark, *again), SCHEMA, buckets=64)
    assert len(changed) <= 10 and {n for n, t in times(path).items() if before.get(n) != t} <= {f"bucket={n}" for n in changed}
    kept = [r for r in rows if r[0] not in again]
    assert now(spark, path) == sorted(kept + [(s, "again", 7) for s in again[:9]])
    assert not os.path.exists(f"{path}/{tables.NEXT}")


def test_seeds_without_rows_leave_no_bucket(spark, table):
    path, rows = table
    everyone = seeds(spark, *map(str, range(200)))
    tables.replace_seeds(spark, path, frame(spark, []), everyone, SCHEMA, buckets=64)
    assert now(spark, path) == [] and not [n for n in os.listdir(path) if n.startswith("bucket=")]
    assert tables.replace_seeds(spark, path, frame(spark, []), everyone.limit(0), SCHEMA) == []
    assert tables.read(spark, f"{path}-none", SCHEMA).count() == 0


def test_a_change_that_stops_in_the_middle_still_happens(spark, table, monkeypatch):
    """Stopped after it was whole: readers see it at once, the next change puts it in place. Before that: nothing."""
    path, rows = table
    real = tables.finish
    calls = []

    def stopped(*args):
        calls.append(args)
        if len(calls) > 1:
            raise KeyboardInterrupt
        real(*args)

    monkeypatch.setattr(tables, "finish", stopped)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_seeds(spark, path, frame(spark, [("5", "new", 1)]), seeds(spark, "5", "6"), SCHEMA, buckets=64)
    monkeypatch.setattr(tables, "finish", real)
    want = sorted([r for r in rows if r[0] not in ("5", "6")] + [("5", "new", 1)])
    assert now(spark, path) == want
    # Half of it in place, as an executor that is lost may leave it.
    folder, touched = tables._ready(path)
    for n in os.listdir(f"{path}/bucket={touched[0]}"):
        os.replace(f"{path}/bucket={touched[0]}/{n}", f"{folder}/.left-{n}")
    assert now(spark, path) == want
    tables.replace_seeds(spark, path, frame(spark, [("7", "more", 2)]), seeds(spark, "7"), SCHEMA, buckets=64)
    want = sorted([r for r in want if r[0] != "7"] + [("7", "more", 2)])
    assert now(spark, path) == want and tables._ready(path) is None


def test_a_change_that_never_became_whole_is_dropped(spark, table):
    path, rows = table
    os.makedirs(f"{path}/{tables.NEXT}/half/bucket=3")
    with open(f"{path}/{tables.NEXT}/half/.{tables.READY}", "w") as mark:
        json.dump([3], mark)
    assert now(spark, path) == sorted(rows)
    tables.finish(spark, path, SCHEMA)
    assert now(spark, path) == sorted(rows) and not os.path.exists(f"{path}/{tables.NEXT}")
