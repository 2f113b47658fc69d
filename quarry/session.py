"""Settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # `atomic_month=2025` stays text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a count over a CSV sees the same malformed rows as a full read
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
