"""Write QUERIES.md from the registry."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from recspark.plans import REGISTRY  # noqa: E402


def main():
    rows = [(name, q.ops, "SQL" if q.sql else "rows", q.build.__module__.rsplit(".", 1)[-1]) for name, q in REGISTRY.items()]
    ids = {}
    for name, ops, *_ in rows:
        for x in ops.split():
            ids.setdefault(x, []).append(f"`{name}`")
    out = ["# Registered queries", "", "Written by `scripts/list_queries.py` from `recspark.plans.REGISTRY` (the same table `__spark_entry__.queries()` returns).",
           "`SQL` = a DuckDB twin in `oracle_sql()`; `rows` = rows-only check plus a property or planted-structure test.", "",
           "| query | SURVEY \u00a72 ids | oracle | module |", "|---|---|---|---|", *[f"| `{n}` | {o} | {k} | `{m}` |" for n, o, k, m in rows],
           "", "## By operator id", "", "| id | queries |", "|---|---|", *[f"| {x} | {', '.join(ids[x])} |" for x in sorted(ids, key=lambda x: (x[0], int(x[1:])))], ""]
    with open(os.path.join(ROOT, "QUERIES.md"), "w", encoding="utf-8") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
