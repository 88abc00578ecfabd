"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC wall-clock timestamps, AQE for runtime
# re-planning (coalescing, skew splits, broadcast only when the measured side is small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "snapline") -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a cluster
    leave them unset so the submitter's values apply.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# The folder in use, by application: a running session's settings cannot be changed.
_CHECKPOINT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Only a local session (one
    machine) may go without: it gets a fresh folder under the system temp dir. On a cluster
    an unset folder is an error, as executors would not share it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no JVM context on this client (e.g. Spark Connect)
        sc = None
    if not d and sc is not None:
        d = _CHECKPOINT.get(sc.applicationId) or sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="snapline-ckpt-")
    if sc is not None and _CHECKPOINT.get(sc.applicationId) != d:
        sc.setCheckpointDir(d)
        _CHECKPOINT[sc.applicationId] = d
    return d.rstrip("/")


def cluster_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 << 20,
                 shuffle_expansion: float = 1.0) -> dict[str, str]:
    """Size scans and shuffles for a run over ``input_bytes`` on ``total_cores`` cores.

    Scan splits and AQE's advisory shuffle partition size are ``target_partition_bytes``
    (sized to sort in memory per core, spilling beyond it). The initial shuffle width
    covers the expected shuffled bytes at that size, at least two tasks per core, so AQE
    only has to coalesce, never to split, outside skew handling. Skew handling splits
    any shuffle partition above 4x the median and above 1 GiB.
    """
    shuffled = int(input_bytes * shuffle_expansion)
    width = max(2 * total_cores, -(-shuffled // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``snapline`` importable in Python workers: zip the package in memory, write it
    once per application to the shared checkpoint folder, whatever file system that is, and
    register it with ``addPyFile``."""
    import io
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    dest = f"{checkpoint_dir(spark)}/pyfiles-{sc.applicationId}/snapline.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(dest)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(sc.applicationId)
