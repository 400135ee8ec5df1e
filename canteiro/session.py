"""Session settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; all can be changed on a live session.
RUNTIME_SETTINGS = {
    # dates without a zone are UTC
    "spark.sql.session.timeZone": "UTC",
    # repeated attribute keys keep the last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # a record that repeats a key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # runtime coalescing, broadcast switch and skew split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows a task reads from a shuffle, compressed: a sort of them takes some nine times as much memory or more
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # HotSpot does not compile methods above 8000 bytes; wide parsing projections then run as
    # separate, compiled expressions instead of one interpreted method
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "canteiro", master: str | None = None, **conf: str) -> SparkSession:
    """Session for scripts and tests; a cluster passes its own session to ``configure``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
