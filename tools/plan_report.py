"""Summarise the executed (AQE final) plan of every registered key.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each key: joins by strategy, shuffles, aggregates (hash / sort, partial
steps), scans with their pushed filters, and the red flags that would not
survive scale (cartesian products, nested-loop joins, Python UDFs, windows
without a partition key).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
         "ArrowEvalPython", "FlatMapGroupsInPandas")


def final_plan(df) -> str:
    """The executed plan after AQE, without the 'Initial Plan' blocks that the
    adaptive plan prints beside each final one."""
    df.toArrow()  # run this DataFrame's own execution so AQE finalises its plan
    text = df._jdf.queryExecution().executedPlan().toString()
    out, skip_at = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if indent >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = line.index("==")  # its children start at this column
            continue
        out.append(line)
    return "\n".join(out)


def _table(loc: str) -> str:
    """Given tables by name; the job's own folders as 'scratch'."""
    base = os.path.basename(loc.split(",")[0].rstrip("/"))
    if base.endswith(".parquet"):
        return base[:-len(".parquet")]
    return "scratch"


def summarise(plan: str) -> dict:
    def count(pat):
        return len(re.findall(pat, plan))
    scans = re.findall(r"FileScan parquet [^\n]*?Location: [^\[]*\[([^\]]*)\][^\n]*?"
                       r"PushedFilters: \[([^\]]*)\]", plan)
    tables = sorted({_table(loc) for loc, _ in scans})
    pushed = sorted({f for _, pf in scans for f in pf.split(", ")
                     if f and not f.startswith("IsNotNull")})
    return {
        "bhj": count(r"BroadcastHashJoin"),
        "smj": count(r"SortMergeJoin"),
        "shj": count(r"ShuffledHashJoin"),
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                          r"Exchange RoundRobin|Exchange SinglePartition"),
        "reused": count(r"ReusedExchange|ReusedSubquery"),
        "hash_agg": count(r"HashAggregate\("),
        "sort_agg": count(r"SortAggregate\("),
        "partial": count(r"partial_"),
        "window": count(r"\bWindow \["),
        "tables": tables,
        "pushed": pushed,
        "flags": [f for f in FLAGS if f in plan],
    }


APPENDIX = ("q4_quarter_pivot", "q10_entity_month_mv_compat")


def _trim(plan: str) -> str:
    """Drop the long metadata of scans and exchanges, keep the tree."""
    out = []
    for line in plan.splitlines():
        line = re.sub(r", Location: InMemoryFileIndex[^\]]*\]", "", line)
        line = re.sub(r"DataFilters: \[[^\]]*\], Format: Parquet, ", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line.rstrip())
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from shelfwise.plans.catalog import all_queries
    from shelfwise.session import build_session
    spark = build_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print(f"# Executed plans ({sf_dir}, local mode, AQE final plans)\n")
    print("Generated by `tools/plan_report.py`. BHJ/SMJ/SHJ: broadcast hash, sort-merge, "
          "shuffled hash joins as AQE chose them at this size (dimension joins turn into "
          "shuffle joins when their measured size passes the broadcast threshold). "
          "`partial` counts partial-aggregate functions (map-side combine). "
          "Streaming and writing keys show the plan of the table they return.\n")
    print("| key | BHJ | SMJ | SHJ | shuffles | reused | hash agg | sort agg | partial "
          "| window | scans | pushed filters | flags |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|---|")
    queries = all_queries()
    for name, fn in queries.items():
        try:
            s = summarise(final_plan(fn(spark, sf_dir)))
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {str(e)[:80]} |")
            continue
        print(f"| {name} | {s['bhj']} | {s['smj']} | {s['shj']} | {s['shuffles']} | "
              f"{s['reused']} | {s['hash_agg']} | {s['sort_agg']} | {s['partial']} | "
              f"{s['window']} | {', '.join(s['tables'])} | {'; '.join(s['pushed']) or '-'} | "
              f"{', '.join(s['flags']) or '-'} |", flush=True)
    for name in APPENDIX:
        print(f"\n## Executed plan: `{name}`\n\n```")
        print(_trim(final_plan(queries[name](spark, sf_dir))))
        print("```")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
