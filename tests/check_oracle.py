"""Compare registered queries with their SQL twins: ``python tests/check_oracle.py [sf_dir] [names...]``."""

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.map(lambda v: "<null>" if pd.isna(v) else (f"{v:.6f}" if isinstance(v, float) else str(v)))
    for c in frame.columns:
        if frame[c].dtype.kind in "if" and frame[c].isna().any():
            text[c] = ["<null>" if pd.isna(v) else f"{float(v):.6f}" for v in frame[c]]
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs between the two results, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    kinds = {c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind) for c in spark_frame.columns}
    # An integer column that holds nulls is a float column in pandas.
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and not (set(k) == {"i", "f"} and sql_frame[c].isna().any())}
    if odd and len(spark_frame):
        return f"types {odd}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    unequal = (a != b).any(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{unequal.sum()} rows, first\n  {a.loc[at].to_dict()}\n  {b.loc[at].to_dict()}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from corpusloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    shared = tempfile.TemporaryDirectory(prefix="check-oracle-")  # intermediate tables go with the run
    session = build_session(
        master="local[8]",
        **{"spark.checkpoint.dir": shared.name, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            got = queries()[name](session, sf_dir).toPandas()
            took = time.time() - start
            if name in oracle_sql():
                start = time.time()
                expected = con.execute(oracle_sql()[name]).df()
                result = differences(got, expected) or "equal"
                print(f"{name}: {result} rows={len(got)} spark={took:.1f}s sql={time.time() - start:.1f}s", flush=True)
            else:
                print(f"{name}: no SQL rows={len(got)} spark={took:.1f}s", flush=True)
        except Exception as e:
            print(f"{name}: FAILED {type(e).__name__} {str(e)[:1500]}", flush=True)
