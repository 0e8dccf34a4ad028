"""Compare a registered Spark query with its DuckDB oracle: column names, row count, values.

Rows are compared as multisets after sorting; floats must agree to 1e-9 (relative) and the report says
whether they were also bit-equal, which is what a value hash needs.
"""
from __future__ import annotations

import math

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, np.generic):
        v = v.item()
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):  # pandas turns NULL into NaN for numeric columns: treat both as NULL
            return (0, "")
        return (2, v)
    if isinstance(v, (list, tuple)):
        return (3, str(list(v)))
    if hasattr(v, "tolist"):
        return (3, str(v.tolist()))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (2, float(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(v, (list, tuple)) and not hasattr(v, "tolist")
                                        and pd.isna(v) and not isinstance(v, float)) else v)
                         for v in rec))
    return sorted(out, key=lambda r: tuple((k, v if k == 2 else 0, v if k != 2 else "") for k, v in r))


SPARK_TO_DUCK = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
                 "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
                 "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]"}


def type_mismatches(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    rel = con.sql(f"SELECT * FROM ({sql}) LIMIT 0")
    duck_types = {name: str(t) for name, t in zip(rel.columns, rel.types)}
    out = []
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        if duck_types.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs oracle {duck_types.get(f.name)}")
    return out


def compare(spark_df, sql: str, con: duckdb.DuckDBPyConnection, check_types: bool = True) -> tuple[bool, str]:
    if check_types:
        bad = type_mismatches(spark_df, sql, con)
        if bad:
            return False, "types differ: " + "; ".join(bad)
    got = spark_df.toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns differ: spark={sorted(got.columns)} oracle={sorted(want.columns)}"
    if len(got) != len(want):
        return False, f"rows differ: spark={len(got)} oracle={len(want)}"
    a, b = _rows(got), _rows(want)
    exact = True
    for i, (ra, rb) in enumerate(zip(a, b)):
        for (ka, va), (kb, vb), col in zip(ra, rb, sorted(got.columns)):
            if ka != kb:
                return False, f"row {i} col {col}: {va!r} vs {vb!r}"
            if ka == 2:
                if va != vb:
                    exact = False
                    if not math.isclose(va, vb, rel_tol=1e-9, abs_tol=1e-12):
                        return False, f"row {i} col {col}: {va!r} vs {vb!r}"
            elif va != vb:
                return False, f"row {i} col {col}: {va!r} vs {vb!r}"
    return True, f"{len(a)} rows, {'bit-equal' if exact else 'equal within 1e-9'}"
