"""Runs a registered query and its SQL side by side, as the driver does."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    have_cols, have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}"
    wrong = [(a, b) for a, b in zip(have, want) if a != b]
    return f"{len(wrong)} of {len(have)} rows differ, first {wrong[0]}" if wrong else None


def over_series(series, sql):
    """A pandas frame named ``series`` queried in DuckDB; rows as a pandas frame."""
    con = duckdb.connect()
    con.register("frame", series)
    columns = ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" if series[c].dtype.kind == "f" else c for c in series)
    con.execute(f"CREATE TABLE series AS SELECT {columns} FROM frame")
    return con.execute(sql).df()
