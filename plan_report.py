"""Print, for each query, the scans, exchanges and joins of its final adaptive plan.

``python plan_report.py [--large] [query ...]``; with ``--large`` Spark may not broadcast by its own
estimate, which shows the plans that large inputs get.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

from dayfold.session import local_session
from registry.queries import QUERIES

COUNTED = {
    "scans": ["FileScan"],
    "exchanges": ["- Exchange", "SortExchange"],
    "reused": ["ReusedExchange"],
    "broadcasts": ["BroadcastExchange"],
    "hash joins": ["BroadcastHashJoin", "ShuffledHashJoin"],
    "merge joins": ["SortMergeJoin"],
    "sorts": ["Sort ["],
    "python": ["EvalPython", "InPandas"],
}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # runs the plan; the result goes nowhere
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("== Initial Plan ==")[0]


def main() -> None:
    names = [n for n in sys.argv[1:] if n != "--large"] or list(QUERIES)
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01").rstrip("/")
    own = tempfile.mkdtemp(prefix="plans-")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"),
        app="plans",
        spark__checkpoint__dir=f"file:{own}/shared",
        spark__sql__warehouse__dir=f"{own}/warehouse",
    )
    if "--large" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| query | " + " | ".join(COUNTED) + " |")
    print("|---" * (len(COUNTED) + 1) + "|")
    for name in names:
        plan = final_plan(QUERIES[name](spark, folder))
        counts = [sum(plan.count(word) for word in words) for words in COUNTED.values()]
        print(f"| `{name}` | " + " | ".join(map(str, counts)) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
