"""Run every registered query on Spark and its DuckDB twin; compare row count,
column names/types and an order-insensitive hash of the values.

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from clickspark.plans.queries import ORACLE_SQL, QUERIES  # noqa: E402
from clickspark.session import local_session  # noqa: E402
from clickspark.sources import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return cols, sorted((tuple(_norm(x) for x in r) for r in zip(*data)), key=repr)


def _types(tbl):
    return {f.name: str(f.type) for f in tbl.schema}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    report = {}
    for name in names:
        t0 = time.time()
        entry = {}
        try:
            sp = QUERIES[name](spark, sf_dir).toArrow()
            entry["rows"] = sp.num_rows
            if name in ORACLE_SQL:
                dk = con.sql(ORACLE_SQL[name]).to_arrow_table()
                entry["oracle_rows"] = dk.num_rows
                sc, sr = _rows(sp)
                dc, dr = _rows(dk)
                entry["cols_match"] = sc == dc
                entry["types"] = (None if _types(sp) == _types(dk) else {"spark": _types(sp), "duck": _types(dk)})
                entry["match"] = sc == dc and sr == dr
                if not entry["match"] and sc == dc:
                    diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                    entry["diff"] = repr(diff)[:600]
                elif sc != dc:
                    entry["diff"] = f"spark cols {sc} vs duck cols {dc}"
            else:
                entry["match"] = None
        except Exception as e:  # report and continue
            entry["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        entry["sec"] = round(time.time() - t0, 2)
        report[name] = entry
        status = "OK " if entry.get("match") else ("-- " if entry.get("match") is None and "error" not in entry else "BAD")
        print(status, name, json.dumps(entry)[:700], flush=True)
    bad = [n for n, e in report.items() if e.get("match") is False or "error" in e]
    print("SUMMARY", len(report), "queries,", len(bad), "bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
