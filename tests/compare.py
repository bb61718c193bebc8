"""Spark result against DuckDB result: columns, types and all rows."""

import math
import re
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def difference(frame, con, sql):
    """None when equal, else a short account of the first difference."""
    found = con.sql(sql)
    theirs = dict(zip(found.columns, map(str, found.types)))
    ours = {name: KINDS.get(kind, kind) for name, kind in frame.dtypes}
    if ours != theirs:
        return f"columns differ: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    names = sorted(ours)
    left = [repr(tuple(_plain(r[n]) for n in names)) for r in frame.collect()]
    at = [found.columns.index(n) for n in names]
    right = [repr(tuple(_plain(r[i]) for i in at)) for r in found.fetchall()]
    # Where the query itself orders, the order counts.
    if not re.search(r"ORDER BY[^()]*$", sql):
        left, right = sorted(left), sorted(right)
    if left != right:
        extra, missing = set(left) - set(right), set(right) - set(left)
        if sorted(left) == sorted(right):
            return "the order differs"
        return (f"{len(left)} rows against {len(right)}; "
                f"only here {sorted(extra)[:2]}; only there {sorted(missing)[:2]}")
    return None
