"""Compare a Spark result with a DuckDB oracle result: column names and types, row count, and an
order-insensitive digest of the values (floats rounded to 6 places)."""

from __future__ import annotations

import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest(), keyed


# Spark type -> the DuckDB type an equivalent SQL result must have.
SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                   "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


def type_mismatches(df, description) -> list[str]:
    duck = {d[0]: str(d[1]) for d in description}
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if SPARK_TO_DUCKDB.get(t, t) != duck.get(f.name):
            out.append(f"{f.name}: spark {t} vs sql {duck.get(f.name)}")
    return out


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    cur = con.execute(sql)
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {sorted(cols)} vs {sorted(ocols)}"
    bad_types = type_mismatches(df, cur.description)
    if bad_types:
        return False, "types differ: " + "; ".join(bad_types)
    if len(rows) != len(orows):
        return False, f"row counts differ: {len(rows)} vs {len(orows)}"
    h1, k1 = digest(rows, cols)
    h2, k2 = digest(orows, ocols)
    if h1 != h2:
        return False, f"values differ, e.g. spark {sorted(set(k1) - set(k2))[:2]} sql {sorted(set(k2) - set(k1))[:2]}"
    return True, f"{len(rows)} rows"
