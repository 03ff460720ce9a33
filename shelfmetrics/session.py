"""Session settings for jobs that start their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Reports are about UTC days.
TIME_ZONE = "UTC"

# Defaults that the submitted configuration may override. A plan-time broadcast goes by
# file sizes, which are compressed, so its limit is low. A run-time broadcast goes by the
# measured size of a finished shuffle stage.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "4MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def get_session(app: str = "shelfmetrics", settings: dict[str, str] | None = None) -> SparkSession:
    """The cluster's session, with the tuning it does not set itself."""
    builder = SparkSession.builder.appName(app)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in TUNING.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark
