"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare.

The comparison follows the driver's gate: same row count, same column
names, same multiset of rows (floats rounded to 6 places, NaN as NULL).

    python -m kintsugi.plans.verify [--sf /root/testdata/sf0.01] [names...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import tempfile
import time


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import duckdb

    from kintsugi.plans import catalog
    from kintsugi.sources.tables import TABLE_NAMES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracle = catalog.queries(), catalog.oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        rec = {"oracle": name in oracle}
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            rec["python"] = "Python" in sdf._jdf.queryExecution().executedPlan().toString()
            srows = [tuple(r) for r in sdf.collect()]
            rec["rows"] = len(srows)
            if name in oracle:
                cur = con.execute(oracle[name])
                ocols = [d[0] for d in cur.description]
                orows = cur.fetchall()
                rec["oracle_rows"] = len(orows)
                rec["cols_match"] = sorted(scols) == sorted(ocols)
                rec["match"] = rec["cols_match"] and _rows(scols, srows) == _rows(ocols, orows)
                if not rec["match"]:
                    rec["spark_cols"], rec["oracle_cols"] = scols, ocols
                    a, b = _rows(scols, srows), _rows(ocols, orows)
                    sa, sb = set(a), set(b)
                    rec["spark_only"] = [x for x in a if x not in sb][:3]
                    rec["oracle_only"] = [x for x in b if x not in sa][:3]
        except Exception as e:  # report and go on with the next query
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        results[name] = rec
        if verbose:
            status = "ERROR" if "error" in rec else ("ok" if rec.get("match", True) else "MISMATCH")
            print(f"{status:8s} {name:32s} {rec}" if status != "ok" else
                  f"ok       {name:32s} rows={rec.get('rows')} {rec['sec']}s", flush=True)
    return results


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from kintsugi.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="kintsugi-")})
    res = compare(spark, a.sf, a.names or None)
    bad = [n for n, r in res.items() if "error" in r or not r.get("match", True)]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
