"""Run registered queries next to their SQL twins and compare the rows.

    python tests/compare.py [name ...]      # default: every query, sf0.01
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float):
        return repr(float(v) + 0.0)
    return str(v)


SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def open_duckdb(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def compare(df, con, sql) -> list[str]:
    """Differences between a DataFrame and its SQL twin; empty if none."""
    rows = df.collect()
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    want = found.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    for f in df.schema:
        ours = f.dataType.simpleString()
        if SAME_TYPE.get(ours) != kinds[f.name]:
            problems.append(f"type of {f.name}: {ours} / {kinds[f.name]}")
    if len(rows) != len(want):
        problems.append(f"rows {len(rows)} / {len(want)}")
    a, b = normal(rows, df.columns), normal(want, names)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        problems.append(f"values ({sorted(names)}) ours {only_a} / twin {only_b}")
    return problems


def main(wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.sparksession import make_session

    spark = make_session()
    con = open_duckdb(DATA)
    queries, twins = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, DATA)
            if name in twins:
                problems = compare(df, con, twins[name])
                note = "ok" if not problems else "DIFFERS " + " | ".join(problems)
            else:
                note = f"{df.count()} rows, no twin"
        except Exception as e:
            note = f"ERROR {type(e).__name__} {str(e)[:600]}"
        bad += note.startswith(("DIFFERS", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
