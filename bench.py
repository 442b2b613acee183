"""Time the headline queries and print one JSON line.

Reads the tables in $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query runs in full: its rows are
written to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymark.queries import QUERIES  # noqa: E402

HEADLINES = (
    "grade_rollouts",
    "group_advantage",
    "evaluate",
    "eval_report",
    "math_equal",
    "math_equal_sums",
    "math_equal_nested",
    "extract_answer",
    "extract_answer_documents",
    "normalize_latex_documents",
    "closed_form",
    "prepare_sft",
    "prepare_rl",
    "prepare_all",
    "join_truth",
    "stable_index",
    "score_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallymark-bench-"))
        # Call sites of single column calls: they double the time it takes to write down a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["total_reward"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up, not timed
    seconds = {}
    for name in HEADLINES:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
