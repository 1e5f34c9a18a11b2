"""Session settings that the engine is designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and sizes shuffles; duplicate map keys keep the last value, as JSON loaders do.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "quire", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
