"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query needs for right results. The feeds carry wall-clock
# times without a zone (Parquet TIMESTAMP_NTZ); cast to TIMESTAMP in a zone
# without daylight saving (UTC) they keep that wall clock exactly, so hour,
# weekday and date keys are the ones written in the data on every cluster,
# with no missing or doubled hour at a DST change, and one-hour windows start
# on the hour.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only tune execution; applied when a session is built here.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.streaming.schemaInference": "false",
    # Reliable checkpoints (replay numbering) live in the shared folder; let
    # Spark remove them once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for every Column function costs several JVM round
    # trips per expression when a plan is built; a production job does not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ridepulse",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**TUNING_CONF, **REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on in an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the distributed folder every executor can reach. Only
    when the session names none (local tests) a folder of our own is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ridepulse-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared work folder (one per run)."""
    root = work_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
