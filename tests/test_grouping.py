"""Groups too large for one cell or one task give the same results as small ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from warcaudit.functions import fixed_values as V
from warcaudit.operators import grouping, inventory, status, warcs

START, END = "2020-01-01", "2020-02-01"


def listing_rows():
    """Seed 7 has most rows, with many copies of one row; a few other seeds are small."""
    random.seed(5)
    rows = []
    for i in range(600):
        seed = "7" if i % 3 else str(i % 17)
        rows.append((f"page-{i // 50:02d}", i % 50, f"A-JOB{i % 40}-SEED{seed}-{i:04d}.warc.gz", f"c{random.randrange(5)}",
                     f"j{random.randrange(30)}", i * 1000, f"2020-01-{i % 28 + 1:02d}T00:00:00Z"))
    rows += [("page-99", 1, "A-JOB1-SEED7-copy.warc.gz", "c9", "j99", 5, "2020-01-05T00:00:00Z")] * 300
    return rows


COLUMNS = "page string, position int, filename string, collection string, crawl string, size long, store_time string"


def expected_lists(rows):
    seeds = {}
    for page, position, name, collection, job, size, _ in sorted(rows):
        seed = name.split("SEED")[1].split("-")[0]
        lists = seeds.setdefault(seed, ([], [], [], []))
        for values, value in zip(lists, (collection, job)):
            if value not in values:
                values.append(value)
        lists[2].append(name)
        lists[3].append(size)
    return seeds


def test_one_row_for_each_seed_in_listing_order(spark):
    """Also for the seed that has most of the rows, on many pages and as many copies of one row."""
    rows = listing_rows()
    random.shuffle(shuffled := list(rows))
    result = inventory.seed_inventory(spark.createDataFrame(shuffled, COLUMNS).repartition(7), START, END)
    got = {r.Seed_ID: r for r in result.collect()}
    want = expected_lists(rows)
    assert got.keys() == want.keys() and result.count() == len(want)
    for seed, (collections, jobs, names, sizes) in want.items():
        assert got[seed].AIT_Collection == "|".join(collections) and got[seed].Job_ID == "|".join(jobs)
        assert got[seed].WARC_Filenames == "|".join(names) and got[seed].WARCs == len(names)
        assert got[seed].Size_GB == round(sum(sizes) / 1e9, 3)
    places = inventory.explode_list(result.filter("Seed_ID = '7'").select("Seed_ID", "Job_ID"), "Job_ID", "job_id").collect()
    assert [(r.position, r.job_id) for r in sorted(places, key=lambda r: r.position)] == list(enumerate(want["7"][1]))


@pytest.mark.parametrize("piece_rows", [7, 100, 10_000])
def test_a_large_seed_is_joined_in_pieces(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(grouping, "PIECE_ROWS", piece_rows)
    test_one_row_for_each_seed_in_listing_order(spark)


def test_pieces_are_alike_wherever_the_rows_are(spark):
    """One page holds nine tenths of a seed, another place a third of all rows as copies of one row."""
    rows = [("hot", "page-1", k, f"name {k}") for k in range(9_000)] + [("hot", f"page-{k}", 0, f"other {k}") for k in range(2, 1_002)]
    rows += [("copies", "page-5", 5, "same")] * 5_000 + [("small", "page-1", k, "x") for k in range(100)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "key string, page string, position int, text string").repartition(6)
    small, large = grouping.in_pieces(frame, "key", ["page", "position"], "copies", 1_000)
    assert small.groupBy("key").count().collect() == [("small", 100)]
    sizes = {(r.key, r._piece): r.n for r in large.groupBy("key", "_piece").agg(F.sum("copies").alias("n"), F.count(F.lit(1))).collect()}
    hot = [n for (key, _), n in sizes.items() if key == "hot"]
    assert sum(hot) == 10_000 and len(hot) >= 8 and max(hot) <= 2 * sum(hot) / len(hot) and max(hot) <= 2 * sorted(hot)[1]
    assert large.filter("key = 'copies'").collect()[0].copies == 5_000
    items = frame.withColumn("cell", F.lit("c"))
    order = lambda r: (r[1], r[2], r[3])
    want = {key: "|".join(r[3] for r in sorted((r for r in rows if r[0] == key), key=order)) for key in ("hot", "copies", "small")}
    for piece_rows in (1_000, 10**9):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(grouping, "PIECE_ROWS", piece_rows)
            got = grouping.join_texts(items, "key", ["page", "position"], ["c"], "|")
            assert {r.key: r.c for r in got.collect()} == want


def test_a_shared_answer_is_copied_as_often_as_needed(spark):
    """One definition for all seeds, a job for some, others for one each: joined rows, and copies of each body."""
    wanted = [("crawldef", "9", f"s{k}") for k in range(100)] + [("crawljob", "5", f"s{k}") for k in range(25)]
    wanted += [("seed", str(k), f"s{k}") for k in range(40)] + [("coll", "gone", f"s{k}") for k in range(30)] + [("seed", None, "s1")]
    bodies = [("crawldef", "9", "d"), ("crawljob", "5", "j"), *[("seed", str(k), f"b{k}") for k in range(60)]]
    rows = spark.createDataFrame(wanted, "kind string, entity string, seed string").repartition(5)
    shared = spark.createDataFrame(bodies, "kind string, entity string, body string")
    joined = grouping.dealt_join(rows, shared, ["kind", "entity"], "seed", 10)
    known = {(k, e): b for k, e, b in bodies}
    assert sorted(((r.kind, r.entity, r.seed, r.body) for r in joined.collect()), key=str) == sorted(((k, e, s, known.get((k, e))) for k, e, s in wanted), key=str)
    hot = {(r.kind, r.entity): r._weight for r in grouping.large_groups(rows, ["kind", "entity"], F.lit(1), 10).collect()}
    assert hot == {("crawldef", "9"): 100, ("crawljob", "5"): 25, ("coll", "gone"): 30}
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode") == 1 and "_parts" in text
    plain = grouping.dealt_join(rows, shared, ["kind", "entity"], "seed", 1_000)
    assert "explode" not in plain._jdf.queryExecution().optimizedPlan().toString() and plain.count() == len(wanted)


def test_running_totals_over_all_rows(spark):
    rows = [(k % 13, f"p{k:04d}", k % 7 + 1) for k in range(2_000)]
    frame = spark.createDataFrame(rows, "a int, path string, size long").repartition(9)
    got = {r.path: r.total for r in grouping.running_total(frame, [F.col("a").desc(), F.col("path")], "size", "total").collect()}
    total, want = 0, {}
    for _, path, size in sorted(rows, key=lambda r: (-r[0], r[1])):
        total += size
        want[path] = total
    assert got == want


@pytest.mark.parametrize("sizes", [[100] * 50 + [1] * 500, [1] * 1_000, list(range(1, 400)), [1000] + [1] * 3_000])
def test_files_are_dealt_by_size(spark, sizes):
    files = spark.createDataFrame([(f"f{k}", n) for k, n in enumerate(sizes)], "path string, length long").repartition(4)
    dealt = warcs.by_size(files, sum(sizes) // 10)
    loads = [r.n for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("length").alias("n")).collect()]
    assert sum(loads) == sum(sizes) and dealt.columns == files.columns
    assert max(loads) <= max(1.5 * sum(sizes) / 10, max(sizes) + 1)
    assert warcs.by_size(files.limit(0)).count() == 0
    assert warcs.by_size(spark.createDataFrame([("a", None), ("b", 0), ("c", 5)], "path string, length long"), 1).count() == 3


@pytest.mark.parametrize("piece_rows", [7, 10_000])
def test_messages_fold_to_one_row(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(grouping, "PIECE_ROWS", piece_rows)
    events = [("1" if i % 4 else "2", i, V.STATUS_COLUMNS[i % 3], f"Error: {i}" if i == 77 else f"message {i}") for i in range(400)]
    events.append(("2", 500, V.STATUS_COLUMNS[0], None))
    seeds = spark.createDataFrame([("1",), ("2",), ("3",)], "seed_id string")
    frame = spark.createDataFrame(events, "seed_id string, ord int, log_column string, message string").repartition(5)
    placed = frame.withColumn("ord", F.struct(F.lit(1).alias("step"), (F.col("ord") / 50).cast("int").alias("page"), F.col("ord").alias("position")))
    for log in (status.fold_log(frame, seeds), status.fold_log(placed, seeds)):
        got = {r.Seed_ID: r for r in log.collect()}
        assert set(got) == {"1", "2", "3"} and log.count() == 3
        for seed, row in got.items():
            for column in V.PROGRESS_COLUMNS:
                messages = [m for s, _, c, m in events if s == seed and c == column and m is not None]
                assert row[column] == ("; ".join(messages) or "TBD")
    judged = {r.Seed_ID: r.Complete for r in status.completeness_of_events(frame).collect()}
    assert judged == {"1": V.STATUS_COLUMNS[77 % 3] if V.STATUS_COLUMNS[77 % 3] in V.ERROR_COLUMNS else V.COMPLETED, "2": V.COMPLETED}


def test_a_cell_that_no_value_can_hold_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(grouping, "CELL_LIMIT", 100)
    rows = spark.createDataFrame([("s", i, "cell", "text") for i in range(60)], "k string, o int, cell string, text string")
    with pytest.raises(Exception, match="too long"):
        grouping.join_texts(rows, "k", ["o"], ["cell"], "|").collect()
    assert grouping.join_texts(rows.limit(5), "k", ["o"], ["cell", "other"], "|").first().asDict() == {
        "k": "s", "cell": "text|text|text|text|text", "other": None}


@pytest.mark.parametrize("group_rows", [None, 10_000, 50])
def test_numbers_are_the_same_for_every_group_size(spark, group_rows):
    rows = [("big" if i % 3 else f"small{i % 5}", f"{i * 7919 % 1000:04d}") for i in range(1000)]
    frame = spark.createDataFrame(rows, "key string, id string").repartition(6)
    got = grouping.number_rows(frame, "key", ["id"], "n", group_rows).collect()
    want, counters = {}, {}
    for key, value in sorted(rows):
        counters[key] = counters.get(key, 0) + 1
        want[key, value] = counters[key]
    assert {(r.key, r.id): r.n for r in got} == want


def test_size_check_finds_only_the_large_groups(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 60, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    small, large, total = grouping.split_by_size(rows, ["k"], F.lit(1), 10)
    assert (small.count(), large.count(), total) == (40, 60, 60)
    assert grouping.split_by_size(rows, ["k"], F.lit(1), 60)[1] is None


def test_checkpoints_use_the_folder_of_the_session(spark):
    grouping.use_checkpoints(spark)
    folder = spark.sparkContext.getCheckpointDir()
    grouping.use_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir() == folder
