"""Session settings the operators rely on."""

import tempfile

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """All times are UTC: parsing, formatting and bucketing assume this session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for stream checkpoints and written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting (tests) falls back to a fresh temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_FALLBACK.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="tidewire-")
    )


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """State of keyed stream operators on local disk and checkpoint, not in the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark
