"""Run registered queries by name.

    python -m dossier.plans                      # list the registered queries
    python -m dossier.plans share_of_max /root/testdata/sf0.01 [--explain] [--rows N]
"""

from __future__ import annotations

import argparse

from ..session import build_session
from .base import load_all


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m dossier.plans")
    ap.add_argument("name", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    ap.add_argument("--rows", type=int, default=20)
    a = ap.parse_args(argv)
    queries = load_all()
    if not a.name:
        for name, q in queries.items():
            print(f"{name:28s} {'oracle' if q.oracle else '-'}")
        return
    spark = build_session()
    df = queries[a.name].run(spark, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    df.show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
