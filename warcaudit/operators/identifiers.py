"""Departments, archival collections and AIP ids from seed reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from . import grouping


def department(status: Column, collector: Column, departments: Sequence[V.Department] = V.DEPARTMENTS) -> Column:
    """Department code of a collector. The list is a handful of fixed names, so it is a literal map, not a join."""
    codes = F.create_map(*[F.lit(text) for d in departments for text in (d.collector, d.code)])
    return (F.when(status != 200, F.concat(F.lit("TBD: API error "), status.cast("string")))
            .when(collector.isNull(), V.NO_COLLECTOR)
            .otherwise(F.coalesce(F.try_element_at(codes, collector), F.lit(V.OTHER_COLLECTOR))))


def collection(status: Column, code: Column, relation_first: Column, relation_last: Column,
               departments: Sequence[V.Department] = V.DEPARTMENTS) -> Column:
    """Archival collection of a seed, from its relation where the department uses one."""
    value = F.lit(V.OTHER_DEPARTMENT)
    for d in departments:
        number = F.lit(d.prefix + d.default_number)
        if d.relation_pattern:
            relation = relation_first if d.relation == "first" else relation_last
            number = F.when(relation.rlike(d.relation_pattern),
                            F.concat(F.lit(d.prefix), F.regexp_extract(relation, d.relation_pattern, 1))
                            ).otherwise(number)
        value = F.when(code == d.code, number).otherwise(value)
    return F.when(status != 200, V.TBD).otherwise(value)


def with_departments(reports: DataFrame, departments: Sequence[V.Department] = V.DEPARTMENTS) -> DataFrame:
    """Add ``department``, ``archival_collection`` and ``aip_title`` to parsed seed reports."""
    return (reports
            .withColumn("department", department(F.col("status"), F.col("collector"), departments))
            .withColumn("archival_collection", collection(
                F.col("status"), F.col("department"), F.col("relation_first"), F.col("relation_last"), departments))
            .withColumn("aip_title", F.when(F.col("status") != 200, V.TBD)
                        .otherwise(F.coalesce(F.col("title"), F.lit(V.NO_TITLE)))))


def with_sequence(reports: DataFrame, order: Sequence[str] = ("seed_id",),
                  departments: Sequence[V.Department] = V.DEPARTMENTS,
                  group_rows: int | None = grouping.GROUP_ROWS) -> DataFrame:
    """Number the seeds of each archival collection in input order; rows of numbered departments only.

    Departments that do not use the number are left out: their one collection can hold most of the seeds.
    """
    codes = [d.code for d in departments if d.numbered]
    numbered = reports.filter(F.col("department").isin(codes))
    return (grouping.number_rows(numbered, "archival_collection", order, "sequence", group_rows)
            .withColumn("sequence_text", C.padded(F.col("sequence"))))


def aip_metadata(reports: DataFrame, date_end: str, order: Sequence[str] = ("seed_id",),
                 departments: Sequence[V.Department] = V.DEPARTMENTS,
                 group_rows: int | None = grouping.GROUP_ROWS) -> DataFrame:
    """One row per seed with department, collection, folder, AIP id, title and version.

    Unnumbered departments come first, then the numbered ones, then rows that need more work; each in input
    order.
    """
    C.check_window(date_end, date_end)
    year, month, _ = date_end.split("-")
    known = with_departments(reports, departments)
    numbered_codes = [d.code for d in departments if d.numbered]

    numbered = with_sequence(known, order, departments, group_rows).withColumn("aip_id", F.concat(
        F.col("archival_collection"), F.lit(f"-web-{year}{month}-"), F.col("sequence_text"))
    ).withColumn("bucket", F.lit(2)).drop("sequence", "sequence_text")

    plain_id, bucket = F.lit(V.TBD), F.lit(3)
    for d in departments:
        if not d.numbered:
            here = F.col("department") == d.code
            plain_id = F.when(here, F.concat(F.lit(d.id_prefix), F.col("seed_id"), F.lit(f"-{year}-{month}"))
                              ).otherwise(plain_id)
            bucket = F.when(here, 1).otherwise(bucket)
    plain = (known.filter(~F.col("department").isin(numbered_codes))
             .withColumn("aip_id", plain_id).withColumn("bucket", bucket))

    return (plain.unionByName(numbered).orderBy("bucket", *order)
            .select(F.col("department").alias("Department"), F.col("archival_collection").alias("Collection"),
                    F.col("seed_id").alias("Folder"), F.col("aip_id").alias("AIP_ID"),
                    F.col("aip_title").alias("Title"), F.lit("1").alias("Version")))
