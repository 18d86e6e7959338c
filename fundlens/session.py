"""Session settings and the shared scratch folder.

Settings kept deliberately small: UTC session zone (all epoch <-> date maths is
also written zone-independently), ANSI left on, AQE with partition coalescing
and skew-join splitting, Arrow for the rare pandas hop.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "fundlens",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``shuffle_partitions`` is only a starting value: AQE coalesces small
    partitions at run time, so on a cluster it should be sized for the
    largest shuffle (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20,
               min_partitions: int = 200) -> dict[str, str]:
    """Settings that keep partitions to about ``partition_bytes`` for a job
    whose largest shuffle moves ``shuffle_bytes``.

    The shuffle partition count is the starting point AQE coalesces down
    from, so it is sized for the largest stage (after map-side partial
    aggregation, which for the word and term counts is far below the input
    size).  Input splits and AQE's target size use the same figure, and a
    partition above the skew threshold is split at run time.
    """
    n = max(min_partitions, -(-shuffle_bytes // partition_bytes))
    size = f"{partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
    }


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (it is the folder every executor can
    reach).  Only a local-mode session without the setting gets a private
    folder, created once per application.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset runtime conf raises
            root = None
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for "
                "checkpoints and intermediate tables")
        app_id = sc.applicationId
        root = _LOCAL_ROOTS.get(app_id)
        if root is None:
            root = tempfile.mkdtemp(prefix="fundlens-")
            _LOCAL_ROOTS[app_id] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "fundlens",
                        f"{name}-{uuid.uuid4().hex[:12]}")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``shared_dir`` whose reader is finished."""
    if os.sep + "fundlens" + os.sep not in path:
        raise ValueError(f"not an intermediate folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
