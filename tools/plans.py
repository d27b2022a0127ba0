"""Writes docs/PLANS.md: the physical plans of the headline queries
(``explain()`` simple mode, long expression lines shortened).

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "route_all_topics": "One scan of the source (four columns), one `from_json`, the per-record "
                        "message array exploded by `Generate`; the only exchange is the final "
                        "per-topic count (partial aggregation).",
    "dau_info": "Session filter below the dedup; `SortAggregate` partial → exchange on "
                "`(dt, mid)` → final: one row per device and day before any join; dimension "
                "joins broadcast by AQE from the measured size.",
    "dim_latest": "Latest row per key with `max_by` (partial aggregate before the shuffle); "
                  "the routing list is a local relation, broadcast by its size.",
    "cdc_route_counts": "One pass: changes meet their routing rows in a join, targets "
                        "are counted with partial aggregation.",
    "dau_new_only": "The stored result is read with a partition filter on the days being resumed "
                    "(`PartitionFilters`), reduced to the candidates' keys, then the anti join.",
    "read_from_offsets": "The stored positions (one row per partition) are broadcast by their size; "
                         "the source is filtered map-side.",
}


def shorten(plan: str, width: int = 170) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        out.append(line if len(line) <= width else line[:width] + " …")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from daystream.plans.catalog import QUERIES
    from daystream.session import get_spark
    spark = get_spark("local[8]", 8, checkpoint_dir=tempfile.mkdtemp(prefix="plans-"))
    parts = ["# Physical plans of the headline queries\n",
             f"Generated by `python tools/plans.py` on `{sf}` (local[8], AQE on; "
             "the final AQE plan can differ, e.g. a sort-merge join turned into a broadcast "
             "join once sizes are measured). Long expression lines are cut.\n"]
    for name, note in NOTES.items():
        df = QUERIES[name](spark, sf)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        parts.append(f"## {name}\n\n{note}\n\n```\n{shorten(buf.getvalue().strip())}\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(parts))
    print(path)


if __name__ == "__main__":
    main()
