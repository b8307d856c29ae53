"""Summarise the physical plans of the headline queries into PLANS.md.

usage: python tools/plan_report.py [sf]   (default 0.01)
For each query: exchanges, join strategies, Python operators, and every scan
with its ReadSchema / PushedFilters / PartitionFilters, from explain("formatted").
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crewspark.plans import all_queries  # noqa: E402
from crewspark.session import local_session  # noqa: E402

OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "Window",
       "WindowGroupLimit", "TakeOrderedAndProject", "FlatMapCoGroupsInPandas", "MapInPandas",
       "ArrowEvalPython", "BatchEvalPython", "Expand", "Generate"]


def summarise(df) -> tuple[Counter, list[str]]:
    text = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(text)
    counts = Counter()
    for line in plan.splitlines():
        m = re.match(r"^\(\d+\) (\w+)", line.strip())
        if m and m.group(1) in OPS:
            counts[m.group(1)] += 1
    scans = []
    for block in plan.split("\n\n"):
        if "Scan parquet" in block.splitlines()[0] if block.strip() else False:
            info = {k: v for k, v in re.findall(r"^(ReadSchema|PushedFilters|PartitionFilters|Location): (.*)$",
                                                 block, re.M)}
            loc = re.sub(r".*/", "", info.get("Location", "").split(" ")[-1].rstrip("]"))
            scans.append(f"`{loc}` ReadSchema `{info.get('ReadSchema', '')}`"
                         + (f", PushedFilters `{info['PushedFilters']}`" if info.get("PushedFilters", "[]") != "[]" else "")
                         + (f", PartitionFilters `{info['PartitionFilters']}`"
                            if info.get("PartitionFilters", "[]") != "[]" else ""))
    return counts, scans


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session(8)
    names = [n for n, q in all_queries().items() if q.bench] + ["domain_projects", "project_fit", "similar_projects_ann",
                                                                  "normalize_skills", "lifecycle_batch"]
    out = [f"# Physical plans of the headline queries (sf{sf}, from `explain(\"formatted\")`)", "",
           "Generated by `tools/plan_report.py`. Counts are physical operators in the final plan text "
           "(adaptive plans show their initial form; subqueries included).", ""]
    for n in names:
        df = all_queries()[n].spark_df(spark, f"/root/testdata/sf{sf}")
        counts, scans = summarise(df)
        ops = ", ".join(f"{k} ×{v}" for k, v in sorted(counts.items())) or "–"
        out.append(f"## `{n}`\n\n- operators: {ops}")
        for s in scans:
            out.append(f"- scan {s}")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
