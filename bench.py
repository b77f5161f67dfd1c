"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed: building the frame (its
checkpoint jobs included) and reading every result row on the executors.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lethe.plans.catalogue import QUERIES  # noqa: E402
from lethe.session import build_session  # noqa: E402

HEADLINES = [
    "keys_csv",  # ingest: read, clean, deduplicate
    "expand_tasks",
    "validate_root",
    "estimate_delete",  # dry run
    "assign_chunks",
    "purge_rows",
    "purge_audit",
    "purge_multi_group",  # ingest, dry run and purge of all groups, all tables written
    "mask_email",
    "mask_name",
    "mask_regex_redact",
    "mask_apply",
    "mask_multi_table",
    "rpt_signoff",
    "rpt_reconcile",
    "verify_untouched",
    "chk_unique_collision",
    "stream_suppress",
]


def run(spark, sf_dir: str, name: str) -> float:
    began = time.monotonic()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.monotonic() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        run(spark, sf_dir, name)
        seconds[name] = round(run(spark, sf_dir, name), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
