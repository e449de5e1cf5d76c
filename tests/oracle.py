"""Compare registered queries with their SQL on DuckDB."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols = sorted(df.columns)
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if got_cols != sorted(want_names):
        return f"columns {got_cols} != {sorted(want_names)}"
    order = [want_names.index(c) for c in got_cols]
    want_rows = sorted((tuple(plain(r[i]) for i in order) for r in want), key=key)
    got_rows = sorted((tuple(plain(r[c]) for c in got_cols) for r in df.collect()), key=key)
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} != {len(want_rows)}; e.g. {got_rows[:2]} vs {want_rows[:2]}"
    bad = [(a, b) for a, b in zip(got_rows, want_rows, strict=True) if a != b]
    if bad:
        return f"{len(bad)} of {len(want_rows)} rows differ on {got_cols}, e.g. {bad[0]}"
    types = [(a, type(a[i]).__name__, type(b[i]).__name__) for a, b in zip(got_rows[:200], want_rows, strict=False)
             for i in range(len(got_cols)) if type(a[i]) is not type(b[i])]
    if types:
        return f"types differ {types[0]} on {got_cols}"
    return None if want_rows else "no rows"
