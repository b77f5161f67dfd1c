"""Session settings and the shared folder for durable intermediate results."""

from __future__ import annotations

import tempfile
from weakref import WeakSet

from pyspark.sql import SparkSession

from lethe.functions.masks import register_mask_functions


_prepared: WeakSet[SparkSession] = WeakSet()


def build_session(app: str = "lethe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a skewed partition is worth one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # checkpointed keys do not outlive the frames that use them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Make an existing session ready: mask functions and checkpoint folder."""
    if spark not in _prepared:
        register_mask_functions(spark)
        shared_folder(spark)
        _prepared.add(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lethe-"))
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()
