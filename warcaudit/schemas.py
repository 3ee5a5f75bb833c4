"""Schemas of the landed inputs and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

from .functions import fixed_values as V


def _texts(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# One page of the WARC listing. Ids are text whatever the JSON type.
LISTING_FILE = T.StructType([
    *_texts(["filename", "collection", "crawl"]),
    T.StructField("size", T.LongType()),
    T.StructField("store-time", T.StringType()),
    T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("checksums", T.MapType(T.StringType(), T.StringType())),
])
LISTING_PAGE = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("files", T.ArrayType(LISTING_FILE)),
])

# Seed report: metadata field -> list of values.
SEED_REPORT = T.ArrayType(T.StructType([
    T.StructField("metadata", T.MapType(
        T.StringType(), T.ArrayType(T.StructType([T.StructField("value", T.StringType())])))),
]))

# One line of the seed log.
SEED_LOG = T.StructType([
    *_texts(["AIP_ID", "Seed_ID", "AIT_Collection", "Job_ID"]),
    T.StructField("Size_GB", T.DoubleType()),
    T.StructField("WARCs", T.LongType()),
    *_texts(["WARC_Filenames", *V.STATUS_COLUMNS]),
])

AIP_METADATA = T.StructType(_texts(["Department", "Collection", "Folder", "AIP_ID", "Title", "Version"]))

# Completeness report, typed. The sentinel words exist only in its CSV form.
COMPLETENESS = T.StructType([
    *_texts(["seed_id", "aip_id"]),
    T.StructField("folder_made", T.BooleanType()),
    *[T.StructField(f"has_{kind}", T.BooleanType()) for kind in V.ONCE_PER_SEED],
    *[T.StructField(f"{kind}_count", T.LongType()) for kind in V.REPEATABLE],
    T.StructField("warc_count_correct", T.BooleanType()),
    T.StructField("file_types_expected", T.BooleanType()),
    T.StructField("state", T.StringType()),
])
