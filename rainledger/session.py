"""Session settings every entry point needs, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. UTC is needed for right results (hours and dates are
# truncated in UTC). The skew settings let AQE split a hot join key even when
# the aggregation above the join then needs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what is kept for several jobs is coalesced like any other result, not left in all its shuffle partitions
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}

# How much of a shuffle one task takes, unless the session says otherwise. A task that joins and groups holds tens of times
# what it reads, so this bounds its memory; partitions are merged up to it and have to be small enough before.
TASK_SIZE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
FIRST_PARTITIONS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", 400)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    most = max(FIRST_PARTITIONS[1], int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    for name, value in (TASK_SIZE, (FIRST_PARTITIONS[0], str(most))):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; pass more as ``**{"spark.x.y": "z"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession) -> str:
    """The shared folder for stream checkpoints, staged writes and tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own; anywhere else a missing setting is an
    error, because executors could not see a folder on the driver's disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rainledger-"))
    return work_dir(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no earlier run has used."""
    return f"{work_dir(spark)}/rainledger/{name}-{uuid.uuid4().hex}"
