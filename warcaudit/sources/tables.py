"""Tables by seed that are changed a few seeds at a time.

A table is Parquet in folders ``bucket=<n>``, the bucket of a seed being a hash of its id. What is to become of the buckets
that a change touches is written beside the table first; a small file then says that it is whole. From there on the
change happens, whatever stops it: readers take the touched buckets from the new rows, and the next change, or
``finish``, puts them in place. Buckets that no seed of the change is in are neither read nor written.
"""

from __future__ import annotations

import json
import posixpath
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .streams import child_names, open_path, remove_folder

BUCKETS = 256
NEXT, READY = ".next", "_ready"


def bucket(seed: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(seed), F.lit(buckets)).cast("int")


def _ready(path: str) -> tuple[str, list[int]] | None:
    """Folder and buckets of a change that is whole but not yet in place."""
    for name in child_names(f"{path}/{NEXT}"):
        place, mark = open_path(f"{path}/{NEXT}/{name}/{READY}")
        if place.get_file_info(mark).type == fs.FileType.File:
            with place.open_input_stream(mark, compression=None) as text:
                return f"{path}/{NEXT}/{name}", json.loads(text.read())
    return None


def _buckets_of(path: str) -> list[int]:
    return [int(name.split("=")[1]) for name in child_names(path) if name.startswith("bucket=")]


def _rows(spark: SparkSession, path: str, wanted: list[int], schema: str) -> DataFrame:
    found = [f"{path}/bucket={n}" for n in sorted(set(wanted) & set(_buckets_of(path)))]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table as it is after the last change, also when that is not in place yet."""
    change = _ready(path)
    if change is None:
        return _rows(spark, path, _buckets_of(path), schema)
    folder, touched = change
    untouched = [n for n in _buckets_of(path) if n not in set(touched)]
    return _rows(spark, path, untouched, schema).unionByName(_rows(spark, folder, touched, schema))


def replace_seeds(spark: SparkSession, path: str, rows: DataFrame, seeds: DataFrame, schema: str, buckets: int = BUCKETS) -> list[int]:
    """Replace all rows of some seeds (``seed_id``) by the given ones, which may be none; returns the buckets written.

    ``rows`` must be of these seeds. One change at a time may be made to a table, and ``buckets`` must stay the same.
    """
    finish(spark, path, schema)
    chosen = seeds.select("seed_id").distinct()
    touched = sorted(r[0] for r in chosen.select(bucket(F.col("seed_id"), buckets)).distinct().collect())
    if not touched:
        return []
    kept = _rows(spark, path, touched, schema).join(chosen, "seed_id", "left_anti")
    new = kept.unionByName(rows.select(*kept.columns)).withColumn("bucket", bucket(F.col("seed_id"), buckets))
    folder = f"{path}/{NEXT}/{uuid.uuid4().hex}"
    # A bucket is one task's work, but a large one is dealt out by further columns when Spark finds it skewed.
    new.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    place, mark = open_path(f"{folder}/{READY}")
    part = posixpath.join(posixpath.dirname(mark), f".{READY}")
    with place.open_output_stream(part, compression=None) as out:
        out.write(json.dumps(touched).encode())
    place.move(part, mark)
    finish(spark, path, schema)
    return touched


def finish(spark: SparkSession, path: str, schema: str) -> None:
    """Put a change in place that is whole, and drop what never became whole. Can be repeated at any point."""
    change = _ready(path)
    if change is not None:
        folder, touched = change
        filled = _buckets_of(folder)
        if filled:
            rows = spark.read.schema(f"{schema}, bucket int").option("basePath", folder).parquet(*[f"{folder}/bucket={n}" for n in filled])
            # Spark replaces the folders of the buckets that have rows, and no others.
            (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
        for n in set(touched) - set(filled):
            remove_folder(path, f"bucket={n}")
    remove_folder(path, NEXT)
