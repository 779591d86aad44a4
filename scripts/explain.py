"""Print the formatted physical plan of catalog queries after running them.

Usage: python scripts/explain.py [sf_dir] name [name ...]
Runs each query once (so the adaptive plan shows its final form) and prints
`explain("formatted")`: scans with PushedFilters / ReadSchema, joins chosen
at run time, exchanges and whole-stage codegen ids.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelens.plans.catalog import QUERIES  # noqa: E402
from tradelens.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    for name in args:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
