"""Print the executed (post-AQE) plans of the key operators.

    python explain_plans.py [sf_dir]              # full formatted plans
    python explain_plans.py [sf_dir] --markdown   # trimmed report (PLANS.md)

Used to check, after each change, that the per-event plan has no exchange
and no Python, that scans read only the needed columns, that keep-first
dedup aggregates partially before its one exchange, and that the replay
check prunes the target's date partitions.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quayside.operators.dedup import drop_existing, keep_first  # noqa: E402
from quayside.plans.registry import _accepted  # noqa: E402
from quayside.session import build_session, scratch_path  # noqa: E402
from quayside.sinks.writers import files_sink  # noqa: E402


NOTES = {
    "accepted": """What to look for:
- one scan reading only the five used columns;
- no `Exchange`;
- the parsed facts come out of a codegen'd `Generate` (the fence);
- the accepted-row filter sits above it, so no parse work is repeated.

Two projections run outside codegen, both still JVM-side:
- the `from_json` decode, because Spark's JSON-to-struct expression has no code generator;
- the metadata merge where a key is overwritten, because higher-order functions (`transform_values`,
  `map_filter`) are interpreted. It applies to accepted rows only: the filter runs first.""",
    "keep-first": """What to look for: `partial_min` (SortAggregate) before the single `Exchange hashpartitioning(event_id)`.
A hot key is reduced to one row per map task before the shuffle. There is no `Window`. Each
branch recomputes the batch here because nothing is persisted in this standalone plan; `deliver`
persists the batch first.""",
    "replay": """What to look for:
- the target scan reads only `event_id` plus the partition column;
- it is pruned by the batch's dates, a literal list in `PartitionFilters`;
- the anti-join is Spark's choice by size: nothing is hinted.""",
}
REPORT: list[str] = []


def show(title: str, df, key: str = "") -> None:
    df.collect()   # run this very plan once (small scale) so AQE finalises it and codegen stages show
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    if "--markdown" not in sys.argv:
        print(f"==== {title}\n{plan}")
        return
    tree = []
    for line in plan.splitlines():
        if line.startswith("(1)"):
            break
        if line.strip():
            tree.append(line[:150])
    scans = sorted({line.strip()[:200] for line in plan.splitlines()
                    if line.startswith(("ReadSchema", "PartitionFilters", "PushedFilters"))})
    REPORT.append(f"## {title}\n\n```\n" + "\n".join(tree) + "\n```\n\nScan details:\n\n```\n"
                  + "\n".join(scans) + f"\n```\n\n{NOTES.get(key, '')}\n")


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    acc = _accepted(spark, sf, keep=("partition", "offset", "event_date"))
    show("accepted events (decode → coerce → classify → enrich → conform)", acc, "accepted")
    show("keep-first dedup", keep_first(acc), "keep-first")
    path = scratch_path(spark, "explain-target")
    files_sink("t", path).write(acc.drop("partition", "offset"), 0)
    batch = acc.filter(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    dates = sorted(r[0] for r in batch.select("event_date").distinct().collect())
    show("replay check against the sink", drop_existing(batch, spark.read.parquet(path), dates=dates), "replay")
    if REPORT:
        print("# Executed plans (post-AQE), from `python explain_plans.py --markdown` at sf0.01\n\n"
              "Regenerate with `python explain_plans.py [sf_dir] --markdown`. Node trees are trimmed to 150\n"
              "characters per line; the full formatted output also lists every node's expressions.\n")
        print("\n".join(REPORT))


if __name__ == "__main__":
    main()
