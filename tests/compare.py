"""Run registered queries next to their oracle SQL and compare the results."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from tidewater.plans.tables import TABLE_NAMES

DATA = os.environ.get("TIDEWATER_DATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = [[_plain(v) for v in frame[c].astype(object)] for c in frame.columns]
    return sorted(zip(*columns), key=repr) if columns else []


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> list[str]:
    found = []
    if sorted(actual.columns) != sorted(expected.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"]
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows != {len(expected)}")
    a, b = rows_of(actual), rows_of(expected)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, e.g. {wrong[0][0]} != {wrong[0][1]}")
    types = {c: (str(actual[c].dtype), str(expected[c].dtype)) for c in actual.columns}
    odd = {c: t for c, t in types.items() if t[0] != t[1] and not _close_types(*t)}
    if odd and len(actual):
        found.append(f"types {odd}")
    return found


def _close_types(a: str, b: str) -> bool:
    return a.startswith("datetime") and b.startswith("datetime") or {a, b} <= {"object", "str", "string"}
