"""Round every DOUBLE/FLOAT output column of a twin to 6 places (DuckDB side).

Spark's ``round`` on a double goes through the value's decimal text and rounds
half-up; the twin does the same so exact decimal ties land on the same side.
"""

from __future__ import annotations

import functools
import os

_BIND_DIR = os.environ.get("VOLTCHURN_BIND_DIR", "/root/testdata/sf0.001")
_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
           "pages benchmark labels conversations").split()


@functools.lru_cache(maxsize=1)
def _con():
    import duckdb

    con = duckdb.connect()
    for t in _TABLES:
        p = f"{_BIND_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rounded_sql(sql: str, places: int = 6) -> str:
    try:
        desc = _con().execute(f"DESCRIBE {sql}").fetchall()
    except Exception:  # noqa: BLE001 - binding needs the smoke tables; fall back to raw SQL
        return sql
    dbl = [r[0] for r in desc if str(r[1]).upper() in ("DOUBLE", "FLOAT", "REAL")]
    if not dbl:
        return sql
    # Spark rounds a double through its decimal text (half-up); do the same here
    rep = ", ".join(
        f'CAST(round(TRY_CAST(CAST("{c}" AS VARCHAR) AS DECIMAL(38, 20)), {places}) AS DOUBLE) AS "{c}"'
        for c in dbl)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"
