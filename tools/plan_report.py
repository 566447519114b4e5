"""Summarise the physical plan of every registered query (for PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > plans.txt
For each query: shuffles (hash / range), broadcasts, join and aggregate
strategies, windows, Python stages and the columns each scan reads. The plan
is taken from ``explain("formatted")`` before execution (AQE may still turn
a shuffle join into a broadcast join at runtime).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldwise.plans.registry_all import all_queries  # noqa: E402
from fieldwise.session import local_session  # noqa: E402

PATTERNS = {
    "shuffle": r"(?<!Broadcast)Exchange \(",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash_agg": r"HashAggregate",
    "sort_agg": r"SortAggregate",
    "obj_agg": r"ObjectHashAggregate",
    "window": r"\bWindow\b",
    "python": r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython",
    "generate": r"\bGenerate\b",
}


def summarise(text: str) -> dict:
    head = text.split("\n\n")[0]
    out = {k: len(re.findall(p, head)) for k, p in PATTERNS.items()}
    out["range_shuffle"] = len(re.findall(r"Arguments: rangepartitioning", text))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    out["scan_columns"] = [len([c for c in s.split(",") if c.strip()]) for s in scans]
    out["pushed_filters"] = len([f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if f.strip()])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    print("| query | operators | shuffles | range | bcast | SMJ | BHJ | hashAgg | sortAgg | window | python | scans (cols read) |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    for name, reg in all_queries().items():
        df = reg.build(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        print(
            f"| {name} | {reg.operators} | {s['shuffle']} | {s['range_shuffle']} | {s['broadcast']} | {s['smj']} | "
            f"{s['bhj']} | {s['hash_agg']} | {s['sort_agg']} | {s['window']} | {s['python']} | {s['scan_columns']} |"
        )
        if s["bnlj"]:
            print(f"<!-- WARNING {name}: nested-loop / cartesian join in plan -->")


if __name__ == "__main__":
    main()
