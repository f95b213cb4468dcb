"""Run queries beside their oracles: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return value if value is None or isinstance(value, (str, bool)) else repr(value)


def _rows(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(str(_cell(r[i])) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out)


def spark_rows(spark, name: str, sf_dir: str):
    df = spark_entry.queries()[name](spark, sf_dir)
    return _rows(df.columns, df.collect())


def oracle_rows(con, name: str):
    cur = con.execute(spark_entry.oracle_sql()[name])
    return _rows([c[0] for c in cur.description], cur.fetchall())


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both agree, else what differs first."""
    cols, got = spark_rows(spark, name, sf_dir)
    want_cols, want = oracle_rows(con, name)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        lost = sorted(set(want) - set(got))[:3]
        return f"rows {len(got)} vs {len(want)}; only spark {extra}; only oracle {lost}"
    return None


def main() -> int:
    from conform.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(spark_entry.queries())
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            if name in spark_entry.oracle_sql():
                diff = difference(spark, con, name, sf_dir)
            else:
                diff = None if spark_rows(spark, name, sf_dir)[1] else "no rows"
        except Exception as e:  # keep going: the report names every broken query
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
