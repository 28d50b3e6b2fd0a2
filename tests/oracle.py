"""Runs a registered query and its SQL counterpart side by side and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(d: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "DATE": "date",
}


def compare(spark, query, sql: str, d: str) -> list[str]:
    """Differences as text; empty when both agree."""
    df = query(spark, d)
    con = duck(d)
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    got_types = dict(df.dtypes)
    problems = []
    if sorted(want_types) != sorted(got_types):
        return [f"columns differ: spark {sorted(got_types)} sql {sorted(want_types)}"]
    for c, t in want_types.items():
        if _KINDS.get(t, t) != got_types[c].replace("_ntz", ""):
            problems.append(f"type of {c}: spark {got_types[c]} sql {t}")
    names = sorted(got_types)
    got = Counter(tuple(_plain(v) for v in r) for r in df.select(*names).toLocalIterator())
    quoted = ", ".join(f'"{n}"' for n in names)
    want = Counter(tuple(_plain(v) for v in r) for r in con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if got != want:
        a, b = got - want, want - got
        problems.append(f"rows: spark {sum(got.values())} sql {sum(want.values())}; only spark {sum(a.values())} "
                        f"e.g. {list(a)[:2]}; only sql {sum(b.values())} e.g. {list(b)[:2]} columns {names}")
    return problems
