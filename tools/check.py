"""Run registered queries next to their SQL in DuckDB and compare the results.

    python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lendmark.registry.catalog import load  # noqa: E402
from lendmark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}" if value else "0"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(value)


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kind(text: str) -> str:
    text = text.lower()
    return {
        "string": "varchar", "bigint": "bigint", "int": "integer", "double": "double", "boolean": "boolean",
        "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    }.get(text, text)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    queries, oracles = load()
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            rows = df.collect()
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name:28s} {len(rows):7d} rows {took:6.2f}s", flush=True)
                continue
            start = time.time()
            rel = con.execute(oracles[name])
            columns = [d[0] for d in rel.description]
            types = {d[0]: str(d[1]).lower() for d in rel.description}
            expected = rel.fetchall()
            sql_took = time.time() - start
            problems = []
            if sorted(columns) != sorted(df.columns):
                problems.append(f"columns {sorted(df.columns)} vs {sorted(columns)}")
            else:
                for c, t in df.dtypes:
                    if kind(t) != types[c] and not (t.startswith("array") or t.startswith("struct")):
                        problems.append(f"type of {c}: {t} vs {types[c]}")
                a, b = fingerprint(df.columns, rows), fingerprint(columns, expected)
                if a != b:
                    left, right = set(a) - set(b), set(b) - set(a)
                    problems.append(f"{len(a)} vs {len(b)} rows; spark only {sorted(left)[:3]}; sql only {sorted(right)[:3]}")
            if not rows:
                problems.append("no rows")
            bad += bool(problems)
            print(f"{'FAIL' if problems else 'ok'}    {name:28s} {len(rows):7d} rows {took:6.2f}s sql {sql_took:5.2f}s "
                  + "; ".join(problems), flush=True)
        except Exception as error:  # report and go on with the next query
            bad += 1
            text = traceback.format_exc()
            print(f"ERROR {name}: {str(error)[:900]}\n{text[-700:]}", flush=True)
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
