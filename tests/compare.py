"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return columns, [str(d[1]) for d in found.description], found.fetchall()


SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN",
}


def difference(df, folder: str, sql: str) -> str | None:
    """A description of the first difference, or None."""
    names = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    columns, types, other = oracle_rows(folder, sql)
    if sorted(columns) != names:
        return f"columns {names} / {sorted(columns)}"
    order = [columns.index(c) for c in names]
    spark_types = dict(df.dtypes)
    for c in names:
        expected = types[columns.index(c)]
        found = SPARK_TYPES.get(spark_types[c], spark_types[c])
        if not expected.startswith(found) and spark_types[c] in SPARK_TYPES:
            return f"type of {c}: {spark_types[c]} / {expected}"
    other = sorted((tuple(r[i] for i in order) for r in other), key=repr)
    if len(rows) != len(other):
        extra = [r for r in rows if r not in set(other)][:2] if len(rows) < 20000 else ""
        return f"rows {len(rows)} / {len(other)} {extra}"
    bad = [(a, b) for a, b in zip(rows, other) if a != b]
    return f"{len(bad)} of {len(rows)} rows differ, e.g. {bad[:2]}" if bad else None


def main(arguments: list[str]) -> int:
    import __spark_entry__ as contract
    from rankloom.session import local_session

    sf = "0.01"
    if arguments[:1] == ["--sf"]:
        sf, arguments = arguments[1], arguments[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    queries, oracles = contract.queries(), contract.oracle_sql()
    chosen = [n for n in queries if not arguments or any(n.startswith(a) for a in arguments)]
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = difference(df, folder, oracles[name])
                note = problem or "equal"
            else:
                problem, note = None, f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        mark = "FAIL" if problem else "ok  "
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
