"""Session settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "dumpmill", **conf: str) -> SparkSession:
    """A session in UTC with ANSI mode and adaptive execution; other settings are the cluster's."""
    own = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"} | conf
    builder = SparkSession.builder.appName(name)
    for k, v in own.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
