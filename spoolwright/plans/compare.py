"""Holding a query against its SQL in DuckDB, as the driver does."""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

from spoolwright.session import TABLES


def duck(sf_dir: str):
    """A DuckDB connection with the folder's tables as views."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 4})
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def _plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None if x is None else "nan"
    if isinstance(x, float):
        return round(x, 6) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, _plain(v)) for k, v in x.items()))
    return x if isinstance(x, (int, str, bool)) else str(x)


def _bag(names: list[str], rows: Iterable) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con, sql: str, shown: int = 3) -> str:
    """Empty if columns and rows (as a bag) agree, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, cur.fetchall())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only here {list((ours - theirs).items())[:shown]}; only there {list((theirs - ours).items())[:shown]}"
