"""Summarise the physical plan of every registered query (markdown table).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Columns: shuffles (hash keys), joins by strategy, partial aggregation,
window-group limits, filters pushed into scans.
"""

import re
import sys

sys.path.insert(0, ".")

from faresight.plans.queries import QUERIES  # noqa: E402
from faresight.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = get_session("local[8]", 16)


def clean(expr: str) -> str:
    return re.sub(r"#\d+L?", "", expr)


print("# Physical plans of the registered queries\n")
print(f"Generated by `tools/plan_summary.py` from the initial AQE plans at `{sf}`. "
      "Shuffle keys are the hash-partitioning expressions; BHJ = broadcast hash join (dimension "
      "side chosen by Spark's size check), SMJ = sort-merge join; partial = map-side partial "
      "aggregate before the shuffle.\n")
print("| Query | Shuffles (keys) | Joins | Partial agg | Other |")
print("|---|---|---|---|---|")
for k, q in QUERIES.items():
    if k == "session_streaks_stream":
        print(f"| {k} | streaming: state store keyed by (user_id, event_type); file sink | - | - | "
              "watermark 5 s, session window 5 min, append |")
        continue
    p = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
    keys = sorted({clean(m) for m in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", p)})
    singles = p.count("Exchange SinglePartition")
    shuffles = "; ".join(f"`{x}`" for x in keys) or "none"
    if singles:
        shuffles += f"; {singles}× single-partition (global aggregate of partial results)"
    joins = []
    for name, tag in (("BroadcastHashJoin", "BHJ"), ("SortMergeJoin", "SMJ"), ("ShuffledHashJoin", "SHJ")):
        n = p.count(name + " ")
        if n:
            joins.append(f"{n}× {tag}")
    anti = len(re.findall(r"LeftAnti", p))
    if anti:
        joins.append(f"{anti} anti")
    partial = "yes" if re.search(r"partial_\w+", p) else "-"
    other = []
    if "WindowGroupLimit" in p:
        other.append("partial WindowGroupLimit (rank filter before the shuffle)")
    if "TakeOrderedAndProject" in p:
        other.append("TakeOrderedAndProject (top-k)")
    if "Window [" in p and "WindowGroupLimit" not in p:
        other.append("window over aggregated rows")
    pushed = sorted({clean(m) for m in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", p)
                     if m and ("IsNotNull" not in m or "," in m)})
    pushed = [x for x in pushed if not re.fullmatch(r"(IsNotNull\([^)]*\)(, )?)+", x)]
    if pushed:
        other.append("pushed: " + "; ".join(f"`{x}`" for x in pushed))
    print(f"| {k} | {shuffles} | {', '.join(joins) or '-'} | {partial} | {', '.join(other) or '-'} |")
