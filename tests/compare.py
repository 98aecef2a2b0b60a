"""Run a registered query and its SQL side by side and describe any difference."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        value = 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df, con, sql) -> str | None:
    relation = con.sql(sql)
    wanted_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    found_types = {c: KINDS.get(t, t) for c, t in df.dtypes}
    if wanted_types != found_types:
        odd = set(wanted_types.items()) ^ set(found_types.items())
        return f"schema: {sorted(odd)}"
    wanted = _normal(relation.columns, relation.fetchall())
    found = _normal(df.columns, [tuple(r) for r in df.collect()])
    if wanted == found:
        return None
    extra, missing = sorted(set(found) - set(wanted)), sorted(set(wanted) - set(found))
    return f"rows {len(found)} vs {len(wanted)}; only spark {extra[:2]}; only sql {missing[:2]}"
