"""Ordered work inside groups of any size, and work that one key or one file must not hold up.

Joining texts into one cell and numbering rows need the rows of a group in order. One pass that only counts, with sums on
the map side, finds the groups that are too large for one task. All others take one shuffle. The rows of the
large ones are cut by Spark's range partitioner: its sampled splitters follow the order of the rows themselves, so pieces
are alike in size wherever in the order the rows are; copies of one row are counted first, since no splitter
can part them. Joins with a key that very many rows share are dealt out in the same way, as far as the count says.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Joined text that one cell may have. Beyond it the job stops with an error; no cell is cut.
CELL_LIMIT = 1_000_000_000
# Rows a group may have before its texts are joined in pieces of about so many.
PIECE_ROWS = 200_000
# Rows a single group may have before it is numbered in pieces.
GROUP_ROWS = 2_000_000
# Text of a list of keys that is still sent to every executor; a longer list is joined by shuffling.
BROADCAST_CHARS = 16 * 1024 * 1024


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure reliable checkpoints have a folder: the session's own, or a scratch one in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="warcaudit-checkpoints-")
    context.setCheckpointDir(folder)


def large_groups(rows: DataFrame, keys: Sequence[str], weight, limit: int) -> DataFrame | None:
    """Keys and ``_weight`` of the groups whose summed weight is over the limit: at most total / limit rows.

    None when there are none. The list is read more than once and must not be worked out again, so it is written down;
    it is sent to every executor only where its text is short.
    """
    over = rows.groupBy(*keys).agg(F.sum(weight).alias("_weight")).filter(F.col("_weight") > F.lit(limit))
    use_checkpoints(rows.sparkSession)
    over = over.checkpoint()
    names = F.length(F.concat_ws("", *[F.col(k).cast("string") for k in keys]))
    chars = over.agg(F.sum(names + 64)).first()[0]
    if chars is None:
        return None
    return F.broadcast(over) if chars <= BROADCAST_CHARS else over


def split_by_size(rows: DataFrame, keys: Sequence[str], weight, limit: int | None):
    """Rows of groups within the limit, and rows and total weight of the groups over it.

    The second part is None when no group is over the limit, which one pass with map-side sums finds out.
    ``limit=None`` skips the pass: the caller knows that the groups are small.
    """
    over = None if limit is None else large_groups(rows, keys, weight, limit)
    if over is None:
        return rows, None, 0
    total = over.agg(F.sum("_weight")).first()[0]
    over = over.drop("_weight")
    return rows.join(over, list(keys), "left_anti"), rows.join(over, list(keys), "left_semi"), total


def _pieces_wanted(spark: SparkSession, total: int, size: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-total // size))


def in_pieces(rows: DataFrame, key: str, order: Sequence[str], copies: str,
              piece_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups that fit a piece, and those of larger ones with the piece each is in, by ``_piece``.

    Both have ``copies``, how many equal rows a row stands for: one in the first part, counted in the second.
    """
    piece_rows = PIECE_ROWS if piece_rows is None else piece_rows
    small, large, total = split_by_size(rows, [key], F.lit(1), piece_rows)
    once = small.withColumn(copies, F.lit(1).cast("long"))
    if large is None:
        return once, None
    counted = large.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(copies))
    ranges = _pieces_wanted(rows.sparkSession, total, piece_rows)
    others = [c for c in rows.columns if c != key and c not in order]
    return once, counted.repartitionByRange(ranges, key, *order, *others).withColumn("_piece", F.spark_partition_id())


def joined(texts: Column, separator: str, what: str, copies: Column | None = None) -> Column:
    """One text of an array of texts, each as often as ``copies`` says; an error if it is longer than a value may be."""
    if copies is None:
        chars = F.aggregate(texts, F.lit(0).cast("long"), lambda n, x: n + F.length(x) + len(separator))
        whole = texts
    else:
        pairs = F.arrays_zip(texts.alias("text"), copies.alias("copies"))
        chars = F.aggregate(pairs, F.lit(0).cast("long"), lambda n, x: n + (F.length(x["text"]) + len(separator)) * x["copies"])
        whole = F.flatten(F.transform(pairs, lambda x: F.array_repeat(x["text"], x["copies"].cast("int"))))
    return F.when(chars > CELL_LIMIT, F.raise_error(F.lit(f"{what} of one group is too long for a value"))).otherwise(
        F.array_join(whole, separator))


def join_texts(items: DataFrame, key: str, order: Sequence[str], cells: Sequence[str], separator: str) -> DataFrame:
    """Texts of each key joined in order, one row per key with a column for each cell, null where it has no text.

    ``items`` has the key, the order columns, ``cell`` (the name of the result column a text belongs to) and ``text``.
    """
    def whole(name: str, fields: Sequence[str], copies: str | None) -> Column:
        here = F.struct(*fields, "_text", *([copies] if copies else []))
        found = F.sort_array(F.collect_list(F.when(F.col("cell") == name, here)))
        text = joined(F.transform(found, lambda x: x["_text"]), separator, name,
                      F.transform(found, lambda x: x[copies]) if copies else None)
        return F.when(F.size(found) > 0, text).alias(name)

    small, large = in_pieces(items.select(key, *order, "cell", F.col("text").alias("_text")), key, order, "_copies")
    done = small.groupBy(key).agg(*[whole(name, order, None) for name in cells])
    if large is None:
        return done
    pieces = large.groupBy(key, "_piece", "cell").agg(F.sort_array(F.collect_list(F.struct(*order, "_text", "_copies"))).alias("_run"))
    texts = pieces.select(key, "_piece", "cell", joined(
        F.transform("_run", lambda x: x["_text"]), separator, "a piece", F.transform("_run", lambda x: x["_copies"])).alias("_text"))
    return done.unionByName(texts.groupBy(key).agg(*[whole(name, ["_piece"], None) for name in cells]))


def number_rows(rows: DataFrame, key: str, order: Sequence[str], name: str,
                group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Number the rows of each key from 1 in the given order, which has to be total within a key."""
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    small, large, total = split_by_size(rows, [key], F.lit(1), group_rows)
    if large is None:
        return rows.withColumn(name, plain)
    spark = rows.sparkSession
    # The ranges are used twice (sizes and rows) and have to be the same both times: checkpoint them.
    ranged = (large.repartitionByRange(_pieces_wanted(spark, total, group_rows), key, *order)
              .withColumn("_range", F.spark_partition_id()).checkpoint())
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_size"))
               .select(key, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")))
    local = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order))
    numbered = (ranged.withColumn("_local", local).join(offsets, [key, "_range"])
                .withColumn(name, (F.col("_offset") + F.col("_local")).cast("int"))
                .drop("_range", "_local", "_offset"))
    return small.withColumn(name, plain).unionByName(numbered.select(*rows.columns, name))


def dealt_join(rows: DataFrame, shared: DataFrame, keys: Sequence[str], spread: str, limit: int) -> DataFrame:
    """Left join of rows to the one row for their key in ``shared``, for keys that very many rows have.

    A key that more than ``limit`` rows have is dealt out by a hash of the column ``spread``, to so many parts that each has
    about ``limit`` of them, and only its row is copied, once a part. Keys below the limit are joined as they are.
    """
    keys = list(keys)
    hot = large_groups(rows, keys, F.lit(1), limit)
    if hot is None:
        return rows.join(shared, keys, "left")
    parts = hot.select(*keys, F.ceil(F.col("_weight") / limit).cast("int").alias("_parts"))
    part = F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int"), F.lit(0))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    dealt = rows.join(parts, keys, "left").withColumn("_part", part).drop("_parts")
    copied = shared.join(parts, keys, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return dealt.join(copied, [*keys, "_part"], "left").drop("_part")


def running_total(rows: DataFrame, order: Sequence[Column], weight: str, name: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to and with each, in the given order, without one task seeing all.

    Rows are cut into ranges of the order; what lies before a range is the sum of the sums of the ranges before.
    """
    spark = rows.sparkSession
    use_checkpoints(spark)
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Used twice, and the ranges have to be the same both times.
    ranged = rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each range.
    return (ranged.withColumn("_inside", F.sum(weight).over(inside)).join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before"))
