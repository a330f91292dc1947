"""Summarize the physical plan of every table the rebuild writes, as it
runs on the written inputs of the previous layer. Usage:

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.params import FIXTURE_PARAMS  # noqa: E402
from salesmart.plans.pipeline import land, rebuild  # noqa: E402
from salesmart.plans.warehouse import Warehouse  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources.fixture import fixture_sources  # noqa: E402
from salesmart.operators.staging import staging  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange rangepartitioning", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "SortAggregate", "Expand", "TakeOrderedAndProject", "Window ", "Subquery subquery"]


def summary(df) -> tuple[str, str, str]:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    p = df._jdf.queryExecution().executedPlan().toString()
    counts = []
    for n in NODES:
        c = len(set(re.findall(r"Subquery subquery#\d+", p))) if n == "Subquery subquery" else p.count(n)
        if c:
            counts.append(f"{n.strip()} x{c}")
    wgl = re.findall(r"WindowGroupLimit \[[^\]\n]*\], \[[^\]\n]*\], (\w+)\([^\n]*?\), (\d+), (Partial|Final)", p)
    if wgl:
        counts.append("WindowGroupLimit " + ", ".join(sorted({f"{f} <= {k} {m}" for f, k, m in wgl})))
    pushed = sorted({x for x in re.findall(r"PushedFilters: \[([^\]]+)\]", p)})
    schemas = sorted({x.rstrip(".") for x in re.findall(r"ReadSchema: struct<([^>\n]*?)(?:>|\.\.\.)", p)})
    return "; ".join(counts), " / ".join(pushed) or "-", " / ".join(s.replace(":", " ") for s in schemas)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false"})
    src = land(spark, fixture_sources(spark, sf_dir))
    report = rebuild(spark, src, FIXTURE_PARAMS)
    written = {n: spark.read.parquet(f"{report.out_dir}/{n}") for n in report.rows}
    stg_only = {k: v for k, v in written.items() if k.startswith("stg_")}
    star_in = Warehouse(src, FIXTURE_PARAMS, tables=stg_only)
    up_to_star = Warehouse(src, FIXTURE_PARAMS, tables={k: v for k, v in written.items()
                                                        if k.startswith(("stg_", "dim_", "fact_"))})
    full = Warehouse(src, FIXTURE_PARAMS, tables=written)
    plans = {**staging(src, FIXTURE_PARAMS)}
    plans.update({k: b() for k, b in star_in.star_builders().items()})
    plans.update({k: b() for k, b in up_to_star.mart_builders().items()})
    plans.update({k: b() for k, b in full.answer_builders().items()})
    plans["gate: primary keys"] = full.primary_keys()
    plans["gate: foreign keys"] = full.foreign_keys()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Each table as the rebuild runs it: staging from the landed sources, star from the written staging")
    print("tables, marts from the written star, answers from the written marts and star. Broadcast")
    print("joins appear where the planner or AQE measured a side under the broadcast threshold at this")
    print("scale; the same plans use sort-merge joins when both sides are large. Generated by")
    print("`tools/plan_report.py`.\n")
    print("| Table | Operators | Pushed filters | Columns read |")
    print("| --- | --- | --- | --- |")
    for name, df in plans.items():
        ops, pushed, cols = summary(df)
        print(f"| {name} | {ops} | {pushed} | {cols} |")


if __name__ == "__main__":
    main()
