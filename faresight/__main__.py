"""Command line: list and run the registered queries.

    python -m faresight list
    python -m faresight run monthly_zone_revenue --data /root/testdata/sf0.01 --show 20
    python -m faresight run fact_trips --data DIR --out /warehouse/fact_trips   (parquet)
    python -m faresight explain fact_trips --data DIR
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    from faresight.plans import settings
    from faresight.plans.queries import QUERIES

    ap = argparse.ArgumentParser(prog="python -m faresight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query", choices=sorted(QUERIES))
        p.add_argument("--data", required=True, help="folder with the <table>.parquet inputs")
        p.add_argument("--master", default=None, help="e.g. local[8]; default: the environment's")
        p.add_argument("--vars", default="{}", type=json.loads, help="run parameters as JSON, e.g. '{\"days_back\": 30}'")
        if name == "run":
            p.add_argument("--show", type=int, default=20, help="rows to print (a bounded limit)")
            p.add_argument("--out", default=None, help="write the full result as parquet here instead")
    a = ap.parse_args(argv)
    settings.GIVEN.update(getattr(a, "vars", {}))
    if a.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0

    from faresight.session import get_session

    spark = get_session(a.master)
    df = QUERIES[a.query](spark, a.data)
    if a.cmd == "explain":
        df.explain("formatted")
    elif a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(f"wrote {a.query} to {a.out}")
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
