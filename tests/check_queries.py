"""Compare every query with its SQL: python tests/check_queries.py [sf folder] [names…]"""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from warcaudit.plans import inputs, oracles, registry  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in inputs.TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    return bytes(value) if isinstance(value, bytearray) else value


def normalised(columns, rows):
    """Columns by name and rows in a fixed order, so that only names and values count."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=lambda r: [(v is not None, str(v)) for v in r])


def compare(spark, con, folder: str, name: str):
    """None when the query and its SQL agree, else what differs; and the number of rows."""
    frame = registry.all_queries()[name](spark, folder)
    got = normalised(frame.columns, [tuple(r) for r in frame.collect()])
    sql = oracles.all_oracles().get(name)
    if sql is None:
        return None, len(got[1])
    answer = con.execute(sql)
    want = normalised([d[0] for d in answer.description], answer.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}", len(got[1])
    if got[1] != want[1]:
        only = list(set(got[1]) - set(want[1]))[:2], list(set(want[1]) - set(got[1]))[:2]
        return f"rows {len(got[1])} against {len(want[1])}, only here {only[0]}, only there {only[1]}", len(got[1])
    return None, len(got[1])


if __name__ == "__main__":
    from conftest import session

    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    connection, live = connect(data), session()
    for query in sys.argv[2:] or registry.all_queries():
        begin = time.time()
        difference, rows = compare(live, connection, data, query)
        print(f"{query:22} {rows:7} rows {time.time() - begin:6.2f} s  {'ok' if difference is None else str(difference)[:1500]}",
              flush=True)
