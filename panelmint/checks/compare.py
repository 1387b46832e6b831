"""Run registered queries against DuckDB and report differences.

python -m panelmint.checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import time
from pathlib import Path

import pandas as pd


def normalised(frame: pd.DataFrame) -> list[tuple]:
    """Rows as comparable tuples, columns by name, in a fixed order."""

    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return None
        if isinstance(value, float):
            return round(value, 6) + 0.0
        return str(value) if not isinstance(value, (bool, int)) else value

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    # A whole-number column with nulls is a float column on one side only.
    mixed = [c for c in got.columns if pd.api.types.is_numeric_dtype(got[c]) and got[c].dtype != want[c].dtype and pd.api.types.is_numeric_dtype(want[c])]
    got, want = (f.assign(**{c: f[c].astype("Float64").astype(object) for c in mixed if not pd.api.types.is_bool_dtype(f[c])}) for f in (got, want))
    a, b = normalised(got), normalised(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def main() -> None:
    from panelmint.checks import ORACLES, QUERIES
    from panelmint.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(8), duck(args.sf)
    for name in args.names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, args.sf).toPandas()
            took = time.time() - start
            found = difference(got, con.sql(ORACLES[name]).df()) if name in ORACLES else None
            verdict = found or ("ok" if name in ORACLES else "rows only")
        except Exception as problem:
            got, took, verdict = (), time.time() - start, f"ERROR {type(problem).__name__}: {str(problem)[:600]}"
        print(f"{name:28s} {len(got):7d} rows {took:6.1f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
