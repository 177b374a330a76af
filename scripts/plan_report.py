"""Summarize the physical plan of every registered query into PLANS.md.

    python scripts/plan_report.py [sf_dir]

For each query: scans (table, columns read, pushed filters), shuffle
exchanges with their keys, joins, aggregate strategies, Python nodes. Plans
are taken from a library session (static broadcast off, AQE on) before
execution, i.e. the plan AQE starts from.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP_EXECUTION = {"raw_roundtrip", "raw_day_scan", "curated_rerun", "curation_job", "dq_landed",
                  "traffic_stream_keys", "late_record_kept", "raw_two_entities", "catalog_append"}


def summarize(tree: str) -> dict[str, list[str]]:
    scans = []
    for line in tree.splitlines():
        if "FileScan" not in line:
            continue
        m = re.search(r"FileScan (\w+) \[([^\]]*)\]", line)
        loc = re.search(r"Location: [^\[]*\[([^\]]*)\]", line)
        part = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        cols = [re.sub(r"#\d+L?", "", c).strip() for c in m.group(2).split(",") if c.strip()]
        name = os.path.basename(loc.group(1).split(",")[0].rstrip("/")) if loc else "?"
        detail = f"{name} ({m.group(1)}): {len(cols)} cols [{', '.join(cols)}]"
        if part and part.group(1):
            detail += f"; PartitionFilters [{re.sub(r'#[0-9]+L?', '', part.group(1))}]"
        if pushed and pushed.group(1):
            detail += f"; PushedFilters [{pushed.group(1)}]"
        scans.append(detail)
    exchanges = [re.sub(r"#\d+L?", "", f"{kind}({keys})")
                 for kind, keys in re.findall(r"Exchange (\w+)\(([^)]*)\)", tree)]
    joins = re.findall(r"(\w+Join) [^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|RightOuter|FullOuter)", tree)
    aggs = re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b", tree)
    py = [n for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
          if n in tree]
    agg_counts = {a: aggs.count(a) for a in sorted(set(aggs))}
    return {"scans": scans, "exchanges": exchanges, "joins": [f"{j} {t}" for j, t in joins],
            "aggregates": [f"{k} x{v}" for k, v in agg_counts.items()], "python": py}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strata.plans.queries import QUERIES
    from strata.session import get_session

    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# PLANS", "",
           "Generated by `python scripts/plan_report.py` from the physical plans of the",
           f"registered queries on `{sf_dir}` in a library session (AQE on, static",
           "broadcast off). Shuffle exchanges list their keys; `REBALANCE`/`REPARTITION`",
           "exchanges are explicit. Payload-building exchanges belong to the test harness",
           "(they turn tables into raw documents); a curator on landed files has one",
           "exchange (its dedupe).", ""]
    for name, q in QUERIES.items():
        if name in SKIP_EXECUTION:
            out += [f"## {name}", "", "writes to the scratch folder before planning its read; "
                    "see tests/test_sources_sinks.py for its plan assertions", ""]
            continue
        df = q(spark, sf_dir)
        tree = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(tree)
        out += [f"## {name}", ""]
        for key in ("scans", "exchanges", "joins", "aggregates", "python"):
            vals = s[key]
            out.append(f"- {key}: " + ("none" if not vals else ""))
            out += [f"  - {v}" for v in vals]
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
