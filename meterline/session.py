"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results; the operators need exactly these.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that change plans only. No partition counts here: they belong to the cluster.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # merge the events of a busy session key before the shuffle, not after it
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# How tables and results are stored, unless the session says otherwise. Hashed ids fill most of them: hexadecimal text, which snappy
# leaves as it is and zstd halves. Higher levels only find matches by chance in it, which cost more than they save.
STORE_CONF = {
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}


def build_session(app_name: str = "meterline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_CONF, **PLAN_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure_store(configure(builder.getOrCreate()))


def configure_store(spark: SparkSession) -> SparkSession:
    """Settings for what is written; those that the session names stand."""
    for key, value in STORE_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in {**RESULT_CONF, **PLAN_CONF}.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there every task runs on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="meterline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
