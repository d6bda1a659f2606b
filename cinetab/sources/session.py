"""Settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Spark 4.1 lets groups and windows above a union rely on how its inputs are dealt. In 4.1.2 rows of one key can then
#: be in several tasks: on test tables, merge_tiny_shots (a cogroup over unions) came out wrong for six of ten videos.
SETTINGS = {"spark.sql.unionOutputPartitioning": "false"}


def prepared(spark: SparkSession) -> SparkSession:
    """``spark`` with the settings that the library's results need; call it once for a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
