"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting covers a hot country or theme.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the DataFrame that wrote them is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str = "local[8]",
    app_name: str = "newsrisk",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to input bytes / ~128 MB (AQE coalesces below that).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"  # local mode: the driver JVM is the only executor
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder (HDFS/object store) there and we use it
    unchanged. Only when the setting is absent on a single-JVM local master (tests)
    do we create a scratch folder of our own; a cluster run (``local-cluster`` included)
    without it is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if sc.master != "local" and not sc.master.startswith("local["):
            # a machine-local folder would vanish with its executor: insist on the shared one
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for cluster runs")
        path = tempfile.mkdtemp(prefix="newsrisk-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds several jobs (model fits, scoring passes):
    the upstream plan runs once, and a lost executor re-reads the checkpoint
    instead of recomputing from the raw scan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# The longest top-k list that is broadcast outright; any longer side is left to AQE's measured sizes.
BROADCAST_LIST_ROWS = 200


def broadcast_list(df, rows: int):
    """Broadcast ``df``, a list of at most ``rows`` short rows, if that is a short list."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if rows <= BROADCAST_LIST_ROWS else df
