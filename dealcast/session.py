"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (runtime coalescing, skew-join
# splitting, size-checked broadcast of small sides), UTC so dates never shift.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "dealcast",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's base settings.

    On a cluster leave ``master`` unset so spark-submit decides. ``shuffle_partitions``
    should be sized so one shuffle partition is ~128-256 MB at the target scale;
    AQE coalesces small ones at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is used as is.
    Only a local-mode session without that setting (tests) gets a scratch folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        d = tempfile.mkdtemp(prefix="dealcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and return it.

    Used between iterations of loops (boosting rounds, searches) so a lost executor
    recomputes from the checkpoint, not from the raw scan. The input is persisted
    for the duration of the checkpoint: an eager checkpoint runs one job to
    materialise and another to write, and without the cache the second would
    recompute the whole input. The cache is released once the files are written.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist(blocking=False)
