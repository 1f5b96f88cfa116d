"""Session factory.

No master, host or path is hard-coded: the cluster manager supplies them. The defaults below
only set what the pipeline's semantics depend on (UTC wall clock) and what keeps plans sane at
any scale (AQE on, so shuffle partition counts adapt at runtime).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # shuffles start with many partitions and AQE joins small ones, so no plan is sized by hand
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    # checkpoints of iterative operators go once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "tripstar", master: str | None = None, **conf: str) -> SparkSession:
    """Return (or reuse) a session with the pipeline defaults, overridable per key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
