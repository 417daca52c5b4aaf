"""Driver-style comparison of a Spark query with its DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, bytes, bytearray)):
        return v.isoformat() if isinstance(v, dt.date) else bytes(v).hex()
    if isinstance(v, bool):
        return bool(v)
    return v


def _rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(normed).encode()).hexdigest(), normed


# Spark type → the DuckDB type the same values arrive as
TYPE_MAP = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "double": "DOUBLE", "binary": "BLOB",
            "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def compare(spark_df, con, sql):
    s_types = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    s_hash, s_norm = _rows_hash(s_cols, s_rows)
    d_hash, d_norm = _rows_hash(d_cols, d_rows)
    result = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
              "columns_match": sorted(s_cols) == sorted(d_cols), "hash_match": s_hash == d_hash,
              "spark_cols": s_cols, "oracle_cols": d_cols,
              "type_mismatches": {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}}
    if not result["hash_match"]:
        sd, dd = set(s_norm), set(d_norm)
        result["only_spark"] = sorted(sd - dd)[:5]
        result["only_oracle"] = sorted(dd - sd)[:5]
    return result
