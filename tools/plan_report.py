"""Physical-plan facts per registered query, as a Markdown table (for PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: shuffles (Exchange), join strategies, aggregate operators, top-k, window
operators, and the scans' pushed filters and read schema. Plans are taken after AQE has run
(the query is executed once with a no-op sink), so they are the plans actually used.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costpulse.plans import registry  # noqa: E402
from costpulse.session import get_spark  # noqa: E402

STREAMING = ("stream_rollup_closed", "stream_anomalies_closed", "stream_dedup", "upsert_latest")


def facts(plan: str) -> dict[str, str]:
    def count(pattern):
        return len(re.findall(pattern, plan))
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                  r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))
    aggs = sorted(set(re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {
        "shuffles": str(count(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                              r"Exchange SinglePartition|Exchange RoundRobinPartitioning")),
        "broadcasts": str(count(r"BroadcastExchange")),
        "joins": ", ".join(joins) or "-",
        "aggregates": ", ".join(aggs) or "-",
        "top-k": "yes" if "TakeOrderedAndProject" in plan else "-",
        "window": "yes" if re.search(r"\bWindow\b", plan) else "-",
        "pushed": "; ".join(p for p in pushed if p) or "-",
        "read": "; ".join(schemas) or "-",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("plans", master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "broadcasts", "joins", "aggregates", "top-k", "window", "pushed", "read"]
    print(f"# Physical plans ({os.path.basename(sf_dir)}, AQE final plans)\n")
    print("Generated by `tools/plan_report.py`. Streaming and upsert keys show the plan of "
          "reading back their output table; the streaming job plans follow below.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|" + " --- |" * (len(cols) + 1))
    for name, q in registry.REGISTRY.items():
        df = q.plan(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        f = facts(plan)
        print(f"| `{name}` | " + " | ".join(f[c].replace("|", "/") for c in cols) + " |")
    print("\n## Streaming jobs (last micro-batch, operators only)\n")
    for title, plan in stream_plans(spark, sf_dir):
        print(f"### {title}\n\n```")
        print(plan)
        print("```\n")
    spark.stop()


def _operators(plan: str) -> str:
    keep = []
    for line in plan.split("\n"):
        m = re.match(r"^([\s:+\-*()0-9]*)([A-Za-z][A-Za-z]+)", line)
        if m:
            keep.append(m.group(1) + m.group(2))
    return "\n".join(keep)


def stream_plans(spark, sf_dir):
    from costpulse.plans.registry import _replay_config, _stream_source
    from costpulse.sources import raw_json
    from costpulse.streaming import jobs

    source, paths = _stream_source(spark, sf_dir)
    for title, start in (("rollups (60 min)", jobs.rollup_job),
                         ("anomalies (5 min)", jobs.anomaly_job)):
        q = start(spark, raw_json.json_lines_stream(spark, source), paths,
                  _replay_config(spark), available_now=True)
        q.awaitTermination()
        yield title, _operators(q._jsq.explainInternal(False))


if __name__ == "__main__":
    main()
