"""Ingest, dry run and purge at the size of the published single-node run.

Three tables of 1,000,000 rows in a strict 1:1:1 hierarchy and 100,000 keys, 10
bench_pipeline.py <work folder> [cpus]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from lethe.config import DeletionConfig, DeletionRule, Group, Hop, KeyPath  # noqa: E402
from lethe.plans import erasure  # noqa: E402
from lethe.session import build_session  # noqa: E402
from lethe.sources.keyfile import read_keys_csv  # noqa: E402
from lethe.sources.snapshots import SnapshotStore  # noqa: E402

ROWS, KEYS, UNKNOWN, BATCH = 1_000_000, 100_000, 10, "BENCH"
DIRECT = KeyPath("order_no")
CONFIG = DeletionConfig(
    [Group("ORDERS", "ORDER_NO", chunk_size=500)],
    [
        DeletionRule(
            "ORDERS", "logs", 1, KeyPath("order_no", hops=(Hop("item_id", "items", "id"),))
        ),
        DeletionRule("ORDERS", "items", 2, DIRECT),
        DeletionRule("ORDERS", "orders", 3, DIRECT),
    ],
)


def main() -> None:
    root, cpus = sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = build_session(
        "bench-pipeline", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, call):
        began = time.monotonic()
        result = call()
        seconds[name] = round(time.monotonic() - began, 2)
        return result

    store = SnapshotStore(spark, f"{root}/store")
    ids = spark.range(1, ROWS + 1)
    number = F.format_string("ORD-%07d", "id")

    def seed():
        with store.begin() as change:
            change.overwrite("orders", ids.select(number.alias("order_no"),
                                                  F.concat(F.lit("Customer "), "id").alias("name")))
            change.overwrite("items", ids.select("id", number.alias("order_no"),
                                                 (F.col("id") % 97).alias("amount")))
            change.overwrite("logs", ids.select("id", F.col("id").alias("item_id"),
                                                F.lit("Created").alias("log_text")))

    timed("seed", seed)
    live = spark.range(1, KEYS - UNKNOWN + 1).select(number.alias("key_no"))
    dummy = spark.range(UNKNOWN).select(F.format_string("DUMMY-KEY-%04d", "id").alias("key_no"))
    keys = live.union(dummy).select(F.lit("ORDER_NO").alias("key_type"), "key_no")
    timed("key_file", lambda: keys.write.option("header", True).csv(f"{root}/keys"))
    timed("ingest", lambda: erasure.ingest(store, read_keys_csv(spark, f"{root}/keys"), BATCH))
    timed("dry_run", lambda: erasure.run_deletion_dry_run(store, CONFIG, BATCH))
    timed("deletion", lambda: erasure.run_deletion(store, CONFIG, BATCH))

    statuses = {r["status"]: r["count"] for r in store.read(erasure.TASKS).groupBy("status")
                .count().collect()}
    assert statuses == {"COMPLETED": KEYS - UNKNOWN, "NOT_FOUND": UNKNOWN}, statuses
    left = {t: store.read(t).count() for t in ("orders", "items", "logs")}
    assert set(left.values()) == {ROWS - KEYS + UNKNOWN}, left
    assert store.read(erasure.AUDIT).count() == 600
    seconds["ingest_to_purged"] = round(
        seconds["ingest"] + seconds["dry_run"] + seconds["deletion"], 2
    )
    print(json.dumps({"cpus": cpus, "rows_per_table": ROWS, "keys": KEYS, "seconds": seconds}))


if __name__ == "__main__":
    main()
