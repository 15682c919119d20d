"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from measured sizes
# (broadcast only below ``autoBroadcastJoinThreshold``), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "qalens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect.

    ``shuffle_partitions`` should be sized to the data: roughly the shuffled
    bytes divided by 128-256 MB. AQE coalesces it down when the data is small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # no driver-side context (Spark Connect)
        pass
    return spark


def private_session(spark: SparkSession, conf: dict[str, object]) -> SparkSession:
    """A session on the same cluster with settings of its own (the caller's stay as they are),
    for reads whose tasks must be cut in a certain way."""
    own = spark.newSession()
    for key, value in conf.items():
        own.conf.set(key, str(value))
    return own


def bound_to(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` of a private session as a DataFrame of ``spark``: its files keep the private
    session's settings, all later steps follow ``spark``."""
    name = f"shared_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without one (tests, single-machine runs) gets a fresh local
    folder, registered so that ``DataFrame.checkpoint()`` works too. On a cluster each
    executor would write to its own disk, so a missing setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context (Spark Connect)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="qalens-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
