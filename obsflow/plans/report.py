"""Physical-plan summary of the registered batch queries (exchanges, aggregates,
broadcasts, pushed filters), written as Markdown.

    python -m obsflow.plans.report /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import re
import sys

from obsflow.plans.explain import plan_text
from obsflow.plans.queries import QUERIES
from obsflow.session import get_spark

STREAMING = {"stream_window_sink", "stream_restart", "stream_late_data", "stream_clean_sink", "stream_anomalies",
             "stream_quality_report", "stream_anomalies_fixed"}
KINDS = [("Exchange hashpartitioning", "hash exchange"), ("Exchange rangepartitioning", "range exchange"),
         ("Exchange SinglePartition", "single-partition exchange (partial results only)"),
         ("BroadcastExchange", "broadcast"), ("WindowGroupLimit", "window group limit"),
         ("TakeOrderedAndProject", "top-n"), ("ArrowEvalPython", "Arrow UDF"),
         ("FlatMapGroupsInPandas", "grouped pandas"), ("MapInPandas", "mapInPandas"),
         ("SortAggregate", "sort aggregate"), ("ObjectHashAggregate", "object hash aggregate"),
         ("Generate inline", "parse-once generator")]


def summarize(text: str) -> dict:
    simple = text
    out = {label: simple.count(key) for key, label in KINDS if simple.count(key)}
    out["partial aggregates"] = len(re.findall(r"functions=\[(?:partial_|merge_)", simple))
    return out


def main(sf_dir: str) -> None:
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra_conf={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Physical plans of the registered batch queries at `{sf_dir}` (AQE initial plans, "
          "`local[8]`). Counts per plan; streaming queries run to completion when built and are "
          "summarised by their sink's read-back only.\n")
    print("| Query | Plan operators | Pushed filters at the scan |")
    print("|---|---|---|")
    for k, fn in QUERIES.items():
        if k in STREAMING:
            continue
        df = fn(spark, sf_dir)
        simple = plan_text(df, "simple")
        formatted = plan_text(df, "formatted")
        s = summarize(simple)
        ops = ", ".join(f"{v} {n}" for n, v in s.items() if v) or "narrow only (scan, project, filter)"
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", formatted)) - {""})
        print(f"| `{k}` | {ops} | {'; '.join(p[:120] for p in pushed) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
