"""Sessions with the settings that the bar operators rely on."""

from pyspark.sql import SparkSession


def get_spark(name: str = "tallyforge", **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``settings`` are further Spark settings, dots as __."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    # streams that keep a filter's state need this store
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
