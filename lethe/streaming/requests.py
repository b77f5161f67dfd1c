"""Continuous intake of erasure requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lethe.config import DeletionConfig
from lethe.plans.erasure import ingest, take_requests
from lethe.sources.keyfile import clean_keys
from lethe.sources.snapshots import SnapshotStore

REQUEST_SCHEMA = "key_type string, key_no string, requested_at timestamp"


def read_requests(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Requests dropped as CSV files; ``files_per_trigger`` bounds one micro-batch."""
    reader = spark.readStream.schema(REQUEST_SCHEMA).option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def distinct_requests(requests: DataFrame) -> DataFrame:
    """Cleaned requests of one micro-batch, each key once.

    Repeats in other micro-batches are caught when the batch is stored, by an anti
    join with the keys already there; so no request is too late to be taken.
    """
    return clean_keys(requests).dropDuplicates(["key_type", "key_no"])


def start_intake(
    store: SnapshotStore, config: DeletionConfig, requests: DataFrame, batch_id: str,
    checkpoint: str, as_of: str | None = None, validate: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store, expand, validate and estimate every request once.

    Only the keys of a micro-batch are looked for.  One that is repeated after a failure
    adds nothing: known keys are skipped.  ``trigger`` holds the arguments of the stream's trigger; the
    default takes what is there and ends.
    """

    def take(batch: DataFrame, epoch: int) -> None:
        if validate:
            take_requests(store, config, distinct_requests(batch), batch_id, as_of)
        else:
            ingest(store, distinct_requests(batch), batch_id)

    return (
        requests.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
