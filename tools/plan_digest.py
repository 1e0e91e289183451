"""Write docs/PLANS.md: for every registered query, the shape of its final
physical plan (``explain("formatted")``): exchanges, join strategies, windows,
codegen stages, and what each parquet scan reads and pushes down.

Usage: python tools/plan_digest.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _final_tree(text: str) -> list[str]:
    """Tree lines of the physical plan without AQE's ``Initial Plan`` copies."""
    tree = text.split("\n\n")[0].splitlines()
    out, skip_at = [], None
    for line in tree:
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if indent >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = indent
            continue
        out.append(line)
        if "InMemoryRelation" in line:  # the cache build ran during the eager fit step
            skip_at = indent + 1
    return out


NAMES = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate", "ObjectHashAggregate",
         "SortAggregate", "Generate", "MapInPandas", "ArrowEvalPython", "TakeOrderedAndProject",
         "InMemoryTableScan", "Scan parquet", "Scan ExistingRDD"]


def digest(text: str) -> dict:
    tree = _final_tree(text)
    ops = Counter()
    ids = set()
    for line in tree:
        m = re.search(r"([A-Za-z][A-Za-z ]*?)\s*\((\d+)\)", line.lstrip(" :|+-*"))
        if not m:
            continue
        name, node = m.group(1).strip(), m.group(2)
        ids.add(node)
        hits = [n for n in NAMES if name == n or name.startswith(n + " ")]
        if hits:
            ops[max(hits, key=len)] += 1
    scans = []
    for block in text.split("\n\n"):
        head = block.lstrip().splitlines()[0] if block.strip() else ""
        m = re.match(r"\((\d+)\) Scan parquet", head)
        if not m or m.group(1) not in ids:
            continue
        loc = re.search(r"Location: InMemoryFileIndex.*?\[(.*?)\]", block)
        table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
        pushed = re.search(r"PushedFilters: \[(.*?)\]\n", block + "\n")
        schema = re.search(r"ReadSchema: struct<(.*?)>\n", block + "\n")
        cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", schema.group(1))] if schema else []
        scans.append((table, pushed.group(1) if pushed else "", cols))
    return {"ops": ops, "scans": scans}


def main() -> None:
    from hearth.plans.registry import ORACLE, QUERIES, load_all
    from hearth.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8", app="hearth-plans")
    load_all()
    out = ["# Physical plan digest", "",
           f"Generated by `tools/plan_digest.py` from `explain(\"formatted\")` at `{sf}`: the final plan of each",
           "registered query (eager fit steps, e.g. quantile routing or Gram passes, run while the query is built",
           "and are not shown). Scans list the table, the pushed filters and the columns actually read.", ""]
    for name in QUERIES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        d = digest(buf.getvalue())
        ops = ", ".join(f"{k} x{v}" for k, v in d["ops"].items() if v)
        out.append(f"## {name}{'' if name in ORACLE else ' (rows-only)'}")
        out.append("")
        out.append(f"operators: {ops or '-'}")
        out.append("")
        for table, pushed, cols in d["scans"]:
            out.append(f"* scan `{table}` reads {len(cols)} col(s) `{', '.join(cols)}`"
                       + (f"; pushed `{pushed}`" if pushed else ""))
        out.append("")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote docs/PLANS.md ({len(QUERIES)} queries)")


if __name__ == "__main__":
    main()
