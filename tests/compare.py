"""Run a registered query and its DuckDB counterpart over one folder of tables."""

import duckdb
from conftest import TABLES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(repr(r[n]) for n in names) for r in df.collect())


def duckdb_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = [columns.index(n) for n in sorted(columns)]
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in result.fetchall())


def duckdb_types(con, sql):
    return {d[0]: str(d[1]) for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description}
