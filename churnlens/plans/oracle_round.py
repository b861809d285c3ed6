"""Round the double columns of an oracle query the way the registered Spark
queries round them: ``round_even(x * 1e6, 0) / 1e6`` here and
``rint(x * 1e6) / 1e6`` in Spark are the same IEEE operations, so equal
inputs give bit-equal outputs whatever the comparison does with floats.

Output columns and types are found with DuckDB ``DESCRIBE`` against empty
tables of the driver schema (no data is read).
"""

from __future__ import annotations

from functools import lru_cache

# Schemas of the driver tables used by the oracles (column, DuckDB type).
DRIVER_SCHEMA = {
    "region": [("r_regionkey", "INTEGER"), ("r_name", "VARCHAR")],
    "nation": [("n_nationkey", "INTEGER"), ("n_name", "VARCHAR"), ("n_regionkey", "INTEGER")],
    "customer": [
        ("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_nationkey", "INTEGER"),
        ("c_acctbal", "DOUBLE"), ("c_mktsegment", "VARCHAR"),
    ],
    "supplier": [("s_suppkey", "BIGINT"), ("s_name", "VARCHAR"), ("s_nationkey", "INTEGER"), ("s_acctbal", "DOUBLE")],
    "part": [
        ("p_partkey", "BIGINT"), ("p_name", "VARCHAR"), ("p_brand", "VARCHAR"), ("p_type", "VARCHAR"),
        ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE"),
    ],
    "orders": [
        ("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"), ("o_totalprice", "DOUBLE"),
        ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "VARCHAR"),
    ],
    "lineitem": [
        ("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"), ("l_linenumber", "INTEGER"),
        ("l_quantity", "DOUBLE"), ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"),
        ("l_returnflag", "VARCHAR"), ("l_linestatus", "VARCHAR"), ("l_shipdate", "TIMESTAMP"),
    ],
}

DIGITS = 6


@lru_cache(maxsize=1)
def _empty_db():
    import duckdb

    con = duckdb.connect()
    for name, cols in DRIVER_SCHEMA.items():
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {t}' for c, t in cols)})")
    return con


def round_doubles(sql: str, digits: int = DIGITS) -> str:
    """Wrap ``sql`` so that its DOUBLE/FLOAT output columns are rounded."""
    desc = _empty_db().execute(f"DESCRIBE SELECT * FROM ({sql}) q").fetchall()
    scale = f"{float(10 ** digits)!r}"
    cols = []
    changed = False
    for name, typ, *_ in desc:
        q = '"' + name.replace('"', '""') + '"'
        if typ in ("DOUBLE", "FLOAT"):
            cols.append(f"round_even(CAST({q} AS DOUBLE) * {scale}, 0) / {scale} AS {q}")
            changed = True
        else:
            cols.append(q)
    if not changed:
        return sql
    return f"SELECT {', '.join(cols)} FROM (\n{sql}\n) oracle_q"
