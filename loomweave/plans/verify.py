"""Local oracle check: a Spark query against its DuckDB statement.

Mirrors the driver's comparison (row count, column names, order-insensitive
value hash) so a mismatch is caught before a round ends.
"""

from __future__ import annotations

import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 6)
    if hasattr(value, "item") and not isinstance(value, (str, bytes)):
        return _norm(value.item())
    return value


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        out.append(repr(tuple(_norm(row[i]) for i in order)))
    return sorted(out)


def digest(lines) -> str:
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def compare(spark, name: str, sf_dir: str) -> dict:
    from loomweave.plans.catalog import QUERIES
    from loomweave.plans.oracle import ORACLE

    s_cols, s_rows = spark_rows(QUERIES[name](spark, sf_dir))
    result = {"query": name, "spark_rows": len(s_rows), "columns_spark": sorted(s_cols)}
    if name not in ORACLE:
        result["oracle"] = None
        return result
    o_cols, o_rows = duckdb_rows(ORACLE[name], sf_dir)
    a, b = canonical(s_rows, s_cols), canonical(o_rows, o_cols)
    result.update({
        "oracle_rows": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
        "values_match": digest(a) == digest(b),
    })
    if not result["values_match"]:
        sa, sb = set(a), set(b)
        result["only_spark"] = sorted(sa - sb)[:3]
        result["only_oracle"] = sorted(sb - sa)[:3]
    if not result["columns_match"]:
        result["columns_oracle"] = sorted(o_cols)
    return result
