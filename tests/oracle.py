"""Compare a query with its SQL twin in DuckDB: columns, row count and values, order ignored."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", float(value)) if abs(value) < 2**53 else ("i", value)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("n", value)
    if isinstance(value, (bytes, bytearray, memoryview)):
        return ("x", bytes(value))
    if isinstance(value, (list, tuple)):
        return ("l", tuple(_norm(v) for v in value))
    return ("s", str(value))


def _type_class(name: str) -> str:
    name = name.lower()
    if name.startswith("decimal") or "int" in name and "interval" not in name:
        return "hugeint" if "huge" in name or name.startswith("decimal") else name.replace("integer", "int")
    return name


SPARK_TO_DUCK = {"bigint": "bigint", "string": "varchar", "double": "double", "boolean": "boolean",
                 "int": "int", "timestamp_ntz": "timestamp", "timestamp": "timestamp", "binary": "blob"}


def compare(df, con, sql: str) -> list[str]:
    """Problems found; empty when both sides agree."""
    problems = []
    relation = con.execute(sql)
    duck_cols = [d[0] for d in relation.description]
    duck_types = {d[0]: str(d[1]) for d in relation.description}
    duck_rows = relation.fetchall()
    cols = sorted(df.columns)
    if cols != sorted(duck_cols):
        return [f"columns {cols} vs {sorted(duck_cols)}"]
    for name, dtype in df.dtypes:
        want = SPARK_TO_DUCK.get(dtype, dtype)
        have = _type_class(duck_types[name])
        if want != have and not dtype.startswith("array"):
            problems.append(f"type of {name}: {dtype} vs {duck_types[name]}")
    mine = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    index = [duck_cols.index(c) for c in cols]
    theirs = sorted(tuple(_norm(r[i]) for i in index) for r in duck_rows)
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} vs {len(theirs)}")
    if mine != theirs:
        extra = [m for m in mine if m not in set(theirs)][:2]
        lacking = [t for t in theirs if t not in set(mine)][:2]
        problems.append(f"values differ; only here {extra}; only there {lacking}")
    if not mine:
        problems.append("no rows")
    return problems
