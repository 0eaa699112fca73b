"""Session settings the pipeline depends on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Epoch values are UTC and every output timestamp is zone-less, so the session
# time zone must be UTC for epoch <-> timestamp conversions and text formats. A cast to
# a declared schema must fail rather than turn values into NULLs: ANSI mode.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "keelson",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Plans are generated from catalogs (hundreds of columns); recording the Python call
        # site of every DataFrame / function call costs several driver round trips each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for staging and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder there).
    Only a local-mode session without one (tests) gets a scratch folder; on a
    cluster a missing setting is an error, never a machine-local folder. Works
    with Spark Connect sessions too (which have no SparkContext).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: configuration only
        sc = None
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares (staging and lineage cuts)")
    local = tempfile.mkdtemp(prefix="keelson-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local
