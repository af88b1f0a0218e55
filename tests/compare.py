"""Runs registered queries and their SQL on the same tables and compares the results."""

import glob
import os

import duckdb
import pandas as pd

FAMILY = {
    "string": "text", "VARCHAR": "text", "bigint": "bigint", "BIGINT": "bigint", "int": "int",
    "INTEGER": "int", "double": "double", "DOUBLE": "double", "date": "date", "DATE": "date",
    "boolean": "boolean", "BOOLEAN": "boolean",
}


def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def oracle_rows(con, sql):
    relation = con.sql(sql)
    kinds = {c: FAMILY.get(str(k), str(k)) for c, k in zip(relation.columns, relation.types)}
    return relation.columns, kinds, relation.fetchall()


def spark_rows(frame):
    kinds = {c: FAMILY.get(k, k) for c, k in frame.dtypes}
    return frame.columns, kinds, [tuple(row) for row in frame.collect()]


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(frame, con, sql):
    """None if equal, else a short text."""
    columns, kinds, rows = spark_rows(frame)
    o_columns, o_kinds, o_rows = oracle_rows(con, sql)
    if sorted(columns) != sorted(o_columns):
        return f"columns {sorted(columns)} against {sorted(o_columns)}"
    if kinds != o_kinds:
        return "types " + str({c: (kinds[c], o_kinds[c]) for c in kinds if kinds[c] != o_kinds[c]})
    ours, theirs = canonical(columns, rows), canonical(o_columns, o_rows)
    if len(ours) != len(theirs):
        only = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        return f"rows {len(ours)} against {len(theirs)}: {str(only)[:600]}"
    if ours != theirs:
        only = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        return f"values: {str(only)[:600]}"
    return None
