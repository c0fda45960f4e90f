"""Session settings the library relies on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times carry no zone after parsing, so days and hours are UTC days and hours.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Only settable when the session is built.
BUILD_SETTINGS = {
    # Plans are built from many small column calls; recording a stack trace on each costs more than the calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "clickstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; memory and parallelism stay with the deployment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **BUILD_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put :data:`SETTINGS` on a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
