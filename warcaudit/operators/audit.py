"""What should have been stored against what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..schemas import COMPLETENESS

PRESENT, MISSING, UNEXPECTED = "present", "missing", "unexpected"


# What a row of the joint table of ``_by_seed`` stands for, besides the report types.
_WARC, _OTHER, _FOLDER, _STRAY, _WANTED, _LOGGED = "warc", "other", "folder", "stray", "wanted", "logged"
_FILES = (*V.ONCE_PER_SEED, *V.REPEATABLE, _WARC, _OTHER)


def _stored(files: DataFrame) -> DataFrame:
    """What each stored file is, and for a once-per-seed report the id that it claims to belong to.

    A ``/`` in the name is a subfolder and a file without name lies beside the seed folders; neither is expected.
    """
    name = F.col("name")
    ending = F.regexp_extract(name, r"_([a-z]+)\.csv$", 1)
    kind = (F.when(name.isNull(), F.when(F.col("folder").isin(list(V.FOLDER_LEVEL_FILES)), None).otherwise(_STRAY))
            .when(name.contains("/"), _OTHER).when(name.endswith(V.WARC_SUFFIX), _WARC)
            .when(~name.endswith(".csv"), _OTHER)
            .when(ending.isin(list(V.REPORT_SUFFIXES)), ending).otherwise(_OTHER))
    kinds = files.select(F.col("folder").alias("seed_id"), "name", kind.alias("kind"))
    claimed = F.when(F.col("kind").isin(list(V.ONCE_PER_SEED)),
                     F.expr("left(name, length(name) - length(kind) - length('_.csv'))"))
    return kinds.select("seed_id", claimed.alias("aip_id"), "kind")


def _by_seed(expected: DataFrame, files: DataFrame, folders: DataFrame | None, log: DataFrame | None) -> DataFrame:
    """Everything that is known of a seed or folder in one row.

    Files are counted by kind first. The counts, expected seeds and log lines are then one table, summed by
    seed and claimed id and then by seed. Every step combines on the map side, so a folder with most of the
    files is no large task, and the files are read once. A report is the right one if it claims the id that
    the expected seed has. Only counts are summed, which Spark does by hash; what else is known of an expected
    seed is joined to its one row at the end.
    """
    def marked(df: DataFrame, seed: str, mark: str, *more: str) -> DataFrame:
        return df.select(F.col(seed).alias("seed_id"), F.lit(1).cast("long").alias(mark), *more)

    # Nothing but counts here: with numbers only, Spark aggregates by hash in generated code.
    rows = _stored(files).groupBy("seed_id", "aip_id").agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in (*_FILES, _STRAY)])
    rows = rows.unionByName(marked(expected, "seed_id", _WANTED, "aip_id"), allowMissingColumns=True)
    if folders is not None:
        rows = rows.unionByName(marked(folders, "folder", _FOLDER), allowMissingColumns=True)
    if log is not None:
        rows = rows.unionByName(marked(log, "Seed_ID", _LOGGED), allowMissingColumns=True)

    counts = [c for c in (*_FILES, _STRAY, _FOLDER, _WANTED, _LOGGED) if c in rows.columns]
    shared = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
    by_id = rows.groupBy("seed_id", "aip_id").agg(*shared)
    # Only the once-per-seed reports have to be in the row of the wanted id.
    here = F.col(_WANTED) > 0
    by_seed = by_id.groupBy("seed_id").agg(
        *[F.sum(F.when(here, F.col(k)).otherwise(0)).alias(f"right_{k}") for k in V.ONCE_PER_SEED], *shared)
    made = F.lit(False)
    for count in (*_FILES, _FOLDER):
        if count in counts:
            made = made | (F.col(count) > 0)
    known = expected.select(F.col("seed_id").alias("_seed"), "aip_id", "warcs", "ord")
    return by_seed.withColumn("folder_made", made).join(known, F.col("seed_id") == F.col("_seed"), "left").drop("_seed")


def _typed(by_seed: DataFrame) -> DataFrame:
    """The completeness table, and ``ord`` for its order. Tests that could not be made are null."""
    wanted = F.col(_WANTED) > 0
    tested = wanted & F.col("folder_made")

    def test(value, name: str):
        return F.when(tested, value).alias(name)

    return by_seed.select(
        "seed_id", "aip_id", F.when(wanted, F.col("folder_made")).alias("folder_made"),
        *[test(F.col(f"right_{kind}") > 0, f"has_{kind}") for kind in V.ONCE_PER_SEED],
        *[test(F.col(kind), f"{kind}_count") for kind in V.REPEATABLE],
        test(F.col(_WARC) == F.col("warcs"), "warc_count_correct"),
        test(F.col(_OTHER) == 0, "file_types_expected"),
        F.when(tested, PRESENT).when(wanted, MISSING).otherwise(UNEXPECTED).alias("state"), "ord")


def audit_completeness(expected: DataFrame, files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """One row per expected seed (``seed_id, aip_id, warcs, ord``) with the typed results of every test.

    ``files`` has ``folder`` and ``name``; ``folders`` adds folders that may be empty, which a listing of
    files cannot show.
    """
    return _typed(_by_seed(expected, files, folders, None).filter(F.col(_WANTED) > 0))


def audit_store(expected: DataFrame, log: DataFrame, files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """The same and, in state ``unexpected``, every folder or file beside them that no log line accounts for."""
    extra = (F.col("folder_made") | (F.col(_STRAY) > 0)) & (F.col(_LOGGED) == 0)
    return _typed(_by_seed(expected, files, folders, log).filter((F.col(_WANTED) > 0) | extra))


def folder_states(expected: DataFrame, log: DataFrame, files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Everything that the audit of a seed or folder rests on as one digest: ``seed_id, digest``.

    Of the names in a folder only numbers are summed, on the map side and in any order: how many there are, and sums
    and exclusive ors of their hashes. Nothing is parsed or compared.
    """
    name = F.coalesce("name", F.lit("/"))
    rows = files.select(F.col("folder").alias("seed_id"), F.xxhash64(name).alias("h"), F.xxhash64(F.lit(7), name).alias("x"))
    low = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    names = rows.groupBy("seed_id").agg(F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"),
                                        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.bit_xor("x").alias("x"))
    seen = (names if folders is None else names.join(folders.select(F.col("folder").alias("seed_id"), F.lit(True).alias("made")).distinct(), "seed_id", "full"))
    lines = log.groupBy(F.col("Seed_ID").alias("seed_id")).agg(F.count(F.lit(1)).alias("lines"))
    wanted = expected.select("seed_id", F.col("aip_id").alias("aip"), "warcs", F.xxhash64("ord").alias("ord"))
    known = seen.join(wanted, "seed_id", "full").join(lines, "seed_id", "left")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in known.columns if c != "seed_id"]
    return known.select("seed_id", F.md5(F.concat_ws("/", *fields).cast("binary")).alias("digest"))


def audit_changes(expected: DataFrame, log: DataFrame, files: DataFrame, folders: DataFrame | None,
                  states: DataFrame, before: DataFrame, states_before: DataFrame) -> DataFrame:
    """What ``audit_store`` gives, with the rows of seeds and folders whose state is the same as before taken from ``before``.

    ``before`` is an earlier result and ``states_before`` its states. Only files of seeds and folders whose names,
    expectations or log lines have changed since are classified and compared again. The states are read several times
    and should be a written table.
    """
    same = states.join(states_before, ["seed_id", "digest"], "left_semi").select("seed_id")
    changed = states.join(states_before, ["seed_id", "digest"], "left_anti").select("seed_id")

    def of(rows: DataFrame | None, column: str) -> DataFrame | None:
        return None if rows is None else rows.join(changed.withColumnRenamed("seed_id", column), column, "left_semi")

    again = audit_store(of(expected, "seed_id"), of(log, "Seed_ID"), of(files, "folder"), of(folders, "folder"))
    return again.unionByName(before.join(same, "seed_id", "left_semi").select(*again.columns))


def extra_folders(log: DataFrame, files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Folders that belong to no seed of the log."""
    names = files.select("folder")
    if folders is not None:
        names = names.union(folders.select("folder"))
    return (names.filter(~F.col("folder").isin(list(V.FOLDER_LEVEL_FILES))).distinct()
            .join(log.select(F.col("Seed_ID").alias("folder")), "folder", "left_anti"))


def completeness_report(audit: DataFrame) -> DataFrame:
    """The completeness report as text, with its words for tests that could not be made.

    Seeds come in listing order, then the unexpected folders by name.
    """
    unexpected, missing = F.col("state") == UNEXPECTED, F.col("state") == MISSING
    fields = [f for f in COMPLETENESS if f.name not in ("seed_id", "state")]
    shown = [F.col("seed_id").alias(V.COMPLETENESS_HEADER[0])]
    for header, field in zip(V.COMPLETENESS_HEADER[1:], fields):
        text = F.col(field.name).cast("string")
        if field.dataType.typeName() == "boolean":
            text = F.initcap(text)
        if field.name not in ("aip_id", "folder_made"):
            text = F.when(missing, V.MISSING).otherwise(text)
        shown.append(F.when(unexpected, V.NOT_EXPECTED).otherwise(text).alias(header))
    return audit.orderBy(unexpected, "ord", "seed_id").select(*shown)


def qa_review(log: DataFrame, audit: DataFrame) -> DataFrame:
    """The review rules on the seed log and the completeness report, one boolean per rule.

    ``audit`` is the typed table with extras or without. A missing scope report is only wrong when the log
    does not say that it was empty. ``passed`` is true when every rule holds.
    """
    logged = log.select(
        F.col("Seed_ID").alias("seed_id"), F.col("AIP_ID").alias("log_aip_id"), F.col("WARCs").cast("long").alias("WARCs"),
        *V.PROGRESS_COLUMNS)
    rows = audit.join(logged, "seed_id", "left")

    def yes(test):
        return F.coalesce(test, F.lit(False))

    def logged_empty(kind: str):
        name = F.concat("log_aip_id", F.lit(V.REPORT_SUFFIXES[kind]))
        return F.array_contains(F.split(F.col(V.METADATA_EMPTY), V.MESSAGE_SEPARATOR), name)

    scopes = [F.concat("log_aip_id", F.lit(V.REPORT_SUFFIXES[kind])) for kind in ("collscope", "seedscope")]
    other_empty = F.array_except(F.split(F.col(V.METADATA_EMPTY), V.MESSAGE_SEPARATOR),
                                 F.array(*scopes, F.lit(V.NO_EMPTY_REPORTS)))
    rules = {
        "folder_ok": yes(F.col("folder_made") & (F.col("state") == PRESENT)),
        "reports_ok": yes(F.col("has_coll") & F.col("has_seed")),
        "scopes_ok": yes(F.col("has_collscope") | logged_empty("collscope"))
        & yes(F.col("has_seedscope") | logged_empty("seedscope")),
        "warc_count_ok": yes(F.col("warc_count_correct")),
        "file_types_ok": yes(F.col("file_types_expected")),
        "redaction_ok": yes(F.col(V.REDACTION).isin(V.REDACTION_DONE, V.REDACTION_NOT_NEEDED)),
        "report_errors_ok": yes(F.col(V.METADATA_ERRORS) == V.ALL_REPORTS_SAVED),
        "other_reports_ok": yes(F.size(other_empty) == 0),
        "warc_messages_ok": F.lit(True),
    }
    for name in V.WARC_COLUMNS:
        rules["warc_messages_ok"] = rules["warc_messages_ok"] & yes(
            F.regexp_count(F.lower(F.col(name)), F.lit("successfully")) == F.col("WARCs"))
    passed = F.lit(True)
    for test in rules.values():
        passed = passed & test
    return rows.select("seed_id", "state", *[test.alias(name) for name, test in rules.items()], passed.alias("passed"))


def qa_failures(review: DataFrame) -> DataFrame:
    """Seeds and folders that somebody has to look at."""
    return review.filter(~F.col("passed"))
