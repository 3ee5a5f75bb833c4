"""Column expressions shared by the operators. Everything here stays inside Catalyst."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as V


def _first_group(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def seed_id(filename: Column) -> Column:
    """Seed id inside a WARC file name; null when there is none."""
    return F.try_element_at(_first_group(filename, V.SEED_PATTERN), F.lit(1))


def store_date(store_time: Column) -> Column:
    """Date part of an ISO store time, as text; null when it cannot be read."""
    return F.try_element_at(_first_group(store_time, V.STORE_DATE_PATTERN), F.lit(1))


def with_first_group(df: DataFrame, name: str, text: str, pattern: str) -> DataFrame:
    """Add what a pattern finds as a column that later filters do not work out again.

    A filter on an ordinary column is pushed below it and repeats its expression; the output of a generator
    is computed once per row whatever is done with it.
    """
    return df.select("*", F.explode_outer(_first_group(F.col(text), pattern)).alias(name))


def check_window(start: str, end: str) -> None:
    """Refuse dates that are not YYYY-MM-DD or are in the wrong order. Equal dates are an empty window."""
    for name, value in (("start", start), ("end", end)):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
            raise ValueError(f"{name} date '{value}' must be formatted YYYY-MM-DD")
    if start > end:
        raise ValueError(f"start date '{start}' must not be after end date '{end}'")


def in_window(date: Column, start: str, end: str) -> Column:
    """Half-open window: the start date is included and the end date is not."""
    check_window(start, end)
    return (date >= start) & (date < end)


def gigabytes(size: Column) -> Column:
    """Bytes as GB with three decimals, half-even, from exact integers."""
    whole, rest = F.call_function("div", size, F.lit(1000000)), size % F.lit(1000000)
    up = (rest > 500000) | ((rest == 500000) & (whole % F.lit(2) == 1))
    return (whole + F.when(up, 1).otherwise(0)).cast("double") / F.lit(1000.0)


def padded(number: Column, width: int = 4) -> Column:
    """Zero-pad to at least ``width`` digits; longer numbers keep every digit."""
    return F.format_string(f"%0{width}d", number)


def report_name(aip_id: Column, report_type: Column, entity_id: Column) -> Column:
    """File name of a metadata report; only the repeatable types carry the job or definition id."""
    name = F.lit(None).cast("string")
    for kind, suffix in V.REPORT_SUFFIXES.items():
        parts = [aip_id, F.lit("_"), entity_id] if kind in V.REPEATABLE else [aip_id]
        name = F.when(report_type == kind, F.concat(*parts, F.lit(suffix))).otherwise(name)
    return name


def is_open(complete: Column) -> Column:
    """True for a seed that still has to be processed: no value, a blank or the placeholder."""
    return complete.isNull() | F.trim(complete).isin("", V.TBD)


def has_error(message: Column) -> Column:
    """Case-sensitive search for the word that marks a failed step."""
    return F.coalesce(message.contains("Error"), F.lit(False))


# ---- message templates (fixed values) -----------------------------------------------------------
def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def report_error(name: Column, status: Column) -> Column:
    return _text(name, " API Error ", status)


def no_job_report(job_id: Column) -> Column:
    return _text("Error: crawl job ", job_id, " was not downloaded so can't get crawl definition id")


def info_error(warc: Column, status: Column) -> Column:
    return _text("API Error ", status, ": can't get info about ", warc)


def not_listed(warc: Column) -> Column:
    return _text("Index Error: cannot get the WARC URL or MD5 for ", warc)


def downloaded(warc: Column) -> Column:
    return _text("Successfully downloaded ", warc)


def download_error(warc: Column, status: Column) -> Column:
    return _text("API Error ", status, ": can't download ", warc)


def verified(warc: Column, checked_at: Column) -> Column:
    return _text("Successfully verified ", warc, " fixity on ",
                 F.date_format(checked_at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def fixity_changed(warc: Column, before: Column, after: Column) -> Column:
    return _text("Error: fixity for ", warc, " changed and it was deleted: ", before, " before, ", after, " after")


def fixity_unknown(warc: Column) -> Column:
    return _text("Error: fixity for ", warc, " cannot be extracted from md5deep output: b''")


def unzipped(warc: Column) -> Column:
    return _text("Successfully unzipped ", warc)


def unzip_error(warc: Column, reason: Column) -> Column:
    return _text("Error unzipping ", warc, ": ", reason)
