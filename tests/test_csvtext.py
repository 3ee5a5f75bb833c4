"""CSV texts in columns, against the standard library's reader and writer."""

from __future__ import annotations

import csv
import io
import random

from pyspark.sql import functions as F

from warcaudit.functions import csvtext
from warcaudit.functions import fixed_values as V
from warcaudit.operators import reports
from warcaudit.sources import readers

TEXTS = ["", "\n", "a", "a\n", "a,b\r\nc,d\r\n", "a,b\rc,d", ",", ",\n,x", "\n\na,b\n\n1,2\n\n", '"a","b ""q"""\n"x\ny",z', '"a"b"c,d\ne',
         'a"b"c,d "e"\n5" pipe,x', '"never closed,\nstill it\n', '""\n"",""', "x" * 20_000 + ",y", '"' + '""' * 20_000 + '",z\nq', "\u2028é,\u0085\n日本,x",
         "a\n" + "1,2,3,4,5\n" * 50, ",".join("abc" * 3_000) + "\n1"]


def some_texts():
    pick = random.Random(4)
    return TEXTS + ["".join(pick.choice('ab,,""\n\r') for _ in range(pick.randint(0, 25))) for _ in range(3_000)]


def read(text):
    return [row for row in csv.reader(io.StringIO(text, newline="")) if row]


def test_rows_are_those_of_the_standard_library(spark):
    texts = some_texts()
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None)], "k int, body string").repartition(8)
    got = {r.k: r.rows for r in frame.select("k", csvtext.rows(F.col("body")).alias("rows")).collect()}
    assert got.pop(-1) is None
    for k, text in enumerate(texts):
        assert got[k] == read(text), text[:100]


def test_lines_are_those_of_the_standard_library(spark):
    pick = random.Random(5)
    rows = [["".join(pick.choice('ab," \n\r') for _ in range(pick.randint(0, 4))) for _ in range(pick.randint(1, 4))] for _ in range(2_000)] + [[""], ["", ""]]
    frame = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, cells array<string>")
    for r in frame.select("k", csvtext.line(F.col("cells")).alias("line")).collect():
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="").writerow(rows[r.k])
        assert r.line == out.getvalue()


def test_fields_by_name(spark):
    texts = some_texts() + ["a,b,a\n1,2,3\n4\n5,6,7,8\n", "a,a\n1\n"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, body string").repartition(8)
    got = {}
    for r in readers.parse_reports(frame, ["k"]).collect():
        got.setdefault(r.k, {})[r.row] = r.fields
    for k, text in enumerate(texts):
        rows = read(text)
        want = {i: {name: (row[j] or None) if j < len(row) else None for j, name in enumerate(rows[0])} for i, row in enumerate(rows[1:])}
        assert got.get(k, {}) == want, text[:100]


def masked(body, strict, extra):
    """What redaction has to give, worked out row by row."""
    rows = read(body)
    header = rows[0] if rows else []
    login = list(reports.LOGIN_COLUMNS)
    hide = [c for c in login if reports.LOGIN_TRIGGER in header or (strict and set(login) & set(header))] + [c for c in extra if c in header]
    if not hide:
        return body, V.REDACTION_NOT_NEEDED
    names = header + [c for c in dict.fromkeys(hide) if c not in header]
    out = io.StringIO(newline="")
    write = csv.writer(out, lineterminator="\n").writerow
    write(names)
    for row in rows[1:]:
        write([V.REDACTED if name in hide else row[k] if k < len(row) else "" for k, name in enumerate(names)])
    return out.getvalue(), V.REDACTION_DONE if set(login) & set(hide) else V.REDACTION_NOT_NEEDED


def test_redaction_against_the_standard_library(spark):
    pick = random.Random(7)
    heads = [["id", "login_username", "login_password"], ["login_password"], ["login_username", "a,b"], ["id", "token"], ["token", "login_password", "x"], []]
    texts = ["login_password", "login_password\n", 'id,"login_password"\n5" pipe,"se""cret\nx",more\n\nshort\n']
    for _ in range(600):
        out = io.StringIO(newline="")
        write = csv.writer(out, lineterminator=pick.choice(["\n", "\r\n"])).writerow
        head = pick.choice(heads)
        write(head)
        for _ in range(pick.randint(0, 4)):
            write(["".join(pick.choice('ab,"\n é') for _ in range(pick.randint(0, 5))) for _ in range(max(0, len(head) + pick.randint(-1, 1)))])
        texts.append(out.getvalue())
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None)], "k int, body string").repartition(8)
    for strict, extra in ((False, ()), (True, ()), (False, ("token",)), (True, ("token", "login_username"))):
        safe = frame.select("k", reports.redacted(F.col("body"), strict, extra).alias("safe"))
        assert "Python" not in safe._jdf.queryExecution().executedPlan().toString()
        for r in safe.collect():
            assert (r.safe is None) if r.k < 0 else (tuple(r.safe) == masked(texts[r.k], strict, extra)), texts[r.k]
