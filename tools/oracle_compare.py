"""Order-insensitive comparison of a Spark result with a DuckDB result (driver-style)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in v.items()}
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    hs = sorted(hashlib.sha1(json.dumps([norm(r[i]) for i in order], default=str).encode()).hexdigest()
                for r in rows)
    return [cols[i] for i in order], hashlib.sha1("".join(hs).encode()).hexdigest()



def register_views(con, sf_dir: str, names) -> None:
    for t in names:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    sc, sh = digest(cols, rows)
    oc, oh = digest(ocols, orows)
    ok = len(rows) == len(orows) and sc == oc and sh == oh
    return ok, f"rows {len(rows)} vs {len(orows)}, cols_eq={sc == oc}, hash_eq={sh == oh}"


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(spark_df, con, sql: str) -> list[tuple[str, str, str]]:
    """(column, spark type, duckdb type) where the two engines' column types differ."""
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        dt = duck.get(f.name)
        if dt is None or SPARK_TO_DUCK.get(st, st.upper()) != dt:
            out.append((f.name, st, dt))
    return out
