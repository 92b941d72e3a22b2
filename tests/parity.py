"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(frame) -> tuple[list[str], list[tuple]]:
    columns = sorted(frame.columns)
    rows = [tuple(None if v != v else v for v in row) for row in frame[columns].itertuples(index=False, name=None)]
    return columns, sorted(rows, key=repr)


def compare(spark, con, folder: str, name: str, query, sql: str) -> int:
    """Number of equal rows; raises on any difference."""
    ours = query(spark, folder).toPandas()
    theirs = con.execute(sql).df()
    columns, got = normal(ours)
    expected_columns, expected = normal(theirs)
    assert columns == expected_columns, f"{name}: {columns} != {expected_columns}"
    types = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in columns if ours[c].dtype != theirs[c].dtype}
    assert not types, f"{name}: {types}"
    assert len(got) == len(expected), f"{name}: {len(got)} rows, expected {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not wrong, f"{name}: {len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    return len(got)
