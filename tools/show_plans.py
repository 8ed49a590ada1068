"""Print the formatted physical plan of registered queries (no execution).

usage: python tools/show_plans.py [sf_dir] name [name ...]
Sinks and iterative operators run their eager steps (writes, loop rounds)
while building the returned DataFrame; the plan shown is the final one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or ["vehicle_etl", "vehicle_metrics", "merge_edges"]
    from keelson.registry import queries
    from keelson.session import local_session
    spark = local_session(8)
    qs = queries()
    for name in names:
        print(f"===== {name}")
        qs[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
