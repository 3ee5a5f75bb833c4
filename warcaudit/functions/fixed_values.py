"""Texts, patterns and names that results must carry unchanged."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: placeholder and separators ---------------------------------------------------
TBD = "TBD"
LIST_SEPARATOR = "|"
MESSAGE_SEPARATOR = "; "

# ---- fixed values: file name and date patterns --------------------------------------------------
SEED_PATTERN = r"^.*-SEED(\d+)-"
STORE_DATE_PATTERN = r"^(\d{4}-\d{2}-\d{2})T"

# ---- fixed values: column names of the seed log -------------------------------------------------
METADATA_ERRORS = "Metadata_Report_Errors"
METADATA_EMPTY = "Metadata_Report_Empty"
REDACTION = "Seed_Report_Redaction"
DOWNLOAD_ERRORS = "WARC_Download_Errors"
FIXITY_ERRORS = "WARC_Fixity_Errors"
UNZIP_ERRORS = "WARC_Unzip_Errors"
COMPLETE = "Complete"

PROGRESS_COLUMNS = (METADATA_ERRORS, METADATA_EMPTY, REDACTION, DOWNLOAD_ERRORS, FIXITY_ERRORS, UNZIP_ERRORS)
STATUS_COLUMNS = PROGRESS_COLUMNS + (COMPLETE,)
ERROR_COLUMNS = (METADATA_ERRORS, DOWNLOAD_ERRORS, FIXITY_ERRORS, UNZIP_ERRORS)
WARC_COLUMNS = (DOWNLOAD_ERRORS, FIXITY_ERRORS, UNZIP_ERRORS)

# ---- fixed values: message texts ----------------------------------------------------------------
ALL_REPORTS_SAVED = "Successfully downloaded all metadata reports"
NO_EMPTY_REPORTS = "No empty reports"
COMPLETED = "Successfully completed"
REDACTED = "REDACTED"
REDACTION_DONE = "Successfully redacted"
REDACTION_NOT_NEEDED = "No login columns to redact"
REDACTION_NO_REPORT = "No seeds.csv to redact"

# ---- fixed values: texts for missing seed report data -------------------------------------------
NO_COLLECTOR = "TBD: no collector in Archive-It"
OTHER_COLLECTOR = "TBD: unexpected collector value"
OTHER_DEPARTMENT = "TBD: unexpected department value"
NO_TITLE = "TBD: could not get title from Archive-It"

# ---- fixed values: report types and the end of their file names ---------------------------------
REPORT_SUFFIXES = {
    "seed": "_seed.csv",
    "seedscope": "_seedscope.csv",
    "collscope": "_collscope.csv",
    "coll": "_coll.csv",
    "crawljob": "_crawljob.csv",
    "crawldef": "_crawldef.csv",
}
WARC_SUFFIX = ".warc"
ONCE_PER_SEED = ("coll", "collscope", "seed", "seedscope")
REPEATABLE = ("crawldef", "crawljob")

# ---- fixed values: header of the completeness report --------------------------------------------
COMPLETENESS_HEADER = (
    "Seed", "AIP", "Seed Folder Made", "coll.csv", "collscope.csv", "seed.csv", "seedscope.csv",
    "crawldef.csv count", "crawljob.csv count", "WARC Count Correct", "All Expected File Types",
)
MISSING = "missing"
NOT_EXPECTED = "Not expected"
FOLDER_LEVEL_FILES = ("metadata.csv",)


@dataclass(frozen=True)
class Department:
    """How one department's collections and identifiers are named.

    ``relation_pattern`` has one group, the collection number, looked for in the first or last relation
    of the seed report; without a pattern the collection is always ``prefix + default_number``. Numbered
    departments count their seeds per collection; the others carry the seed id itself.
    """

    code: str
    collector: str
    prefix: str
    default_number: str
    relation_pattern: str | None = None
    relation: str = "first"
    numbered: bool = True
    id_prefix: str = ""


# ---- fixed values: departments, in the order of the metadata file -------------------------------
DEPARTMENTS = (
    Department("magil", "Map and Government Information Library", "magil-", "0000",
               numbered=False, id_prefix="magil-ggp-"),
    Department("hargrett", "Hargrett Rare Book & Manuscript Library", "harg-", "0000",
               relation_pattern=r"^Hargrett (.*):", relation="first"),
    Department("russell", "Richard B. Russell Library for Political Research and Studies", "rbrl-", "000",
               relation_pattern=r"^RBRL/(\d{3})", relation="last"),
)
