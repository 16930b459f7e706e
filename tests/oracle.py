"""Compare a Spark result with a DuckDB result: names, kinds of types and all rows."""

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER",
}


def compare(df, con, sql):
    """None when equal, else a text that says what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    for f in df.schema.fields:
        mine, theirs = f.dataType.simpleString(), kinds[f.name]
        if KINDS.get(mine, mine) != theirs:
            return f"type of {f.name}: {mine} / {theirs}"
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b = _rows(names, cursor.fetchall())
    if a != b:
        return (f"rows {sum(a.values())} / {sum(b.values())}; only Spark {list((a - b))[:3]}; "
                f"only SQL {list((b - a))[:3]}")
    return None
