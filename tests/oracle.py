"""Side-by-side comparison of a query and its SQL twin."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is not None else "", v if v is not None else 0) for v in row)


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


# Type families that must agree.
FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences; empty if row count, column names, types and values all agree."""
    problems = []
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expected = rel.fetchall()
    types = {d[0]: str(d[1]) for d in rel.description}
    cols = sorted(df.columns)
    if cols != sorted(names):
        return [f"columns {cols} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if FAMILY.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    got = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=_key)
    pos = [names.index(c) for c in cols]
    want = sorted((tuple(_plain(r[p]) for p in pos) for r in expected), key=_key)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {dict(zip(cols, bad[0][0]))} != {dict(zip(cols, bad[0][1]))}")
    if not want and not got:
        problems.append("empty on both sides")
    return problems
