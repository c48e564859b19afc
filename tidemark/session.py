"""Spark session set-up shared by tests, the bench and the driver entry."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, input_bytes: int | None = None) -> SparkSession:
    """Return (or create) a session configured the way the operators expect.

    * session time zone UTC: the driver's tables hold ``timestamp_ntz`` event
      times, read as UTC wall clock;
    * AQE on (partition coalescing, skew-join splitting, runtime broadcast of
      sides whose *measured* size is under the threshold);
    * UI off: no server is started;
    * with ``input_bytes``: ``scale_settings`` for an input of that size.

    The master is set only if the argument or ``TIDEMARK_MASTER`` names one, since a
    master set in code would outrank that of ``spark-submit``; under plain
    ``python`` Spark's own default, ``local[*]``, holds.
    """
    master = master or os.environ.get("TIDEMARK_MASTER")
    # Python processes started by the JVM (workers, the stateful-processor
    # runner) inherit this; on a cluster the package is installed instead.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "4g"))
    )
    if master:
        builder = builder.master(master)
    for k, v in scale_settings(input_bytes).items() if input_bytes is not None else ():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    if spark.sparkContext.master.startswith("local"):
        ship_package(spark)   # on a cluster the package is installed on every node
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (stateful processors run
    there): zip the package once per session and add it with ``addPyFile``."""
    import shutil

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tidemark-pkg-")
    archive = shutil.make_archive(os.path.join(out, "tidemark"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="tidemark")
    sc.addPyFile(archive)
    _SHIPPED.add(id(sc))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only in local mode, where the
    driver is the one machine, is a fresh scratch folder made if it is unset;
    elsewhere that is an error, since executors could not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def streaming_checkpoint(spark: SparkSession, name: str) -> str:
    """A per-query streaming checkpoint location under the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}"


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` (e.g. 100 TB).

    * scan splits and AQE's target shuffle partition are ``partition_bytes``,
      so every task's input fits an executor core's memory share and spills
      rarely;
    * the initial shuffle partition count follows the input size (AQE then
      coalesces small ones); raise ``partition_bytes`` where the driver can not
      track so many map outputs;
    * skew-join splitting for partitions over 4x the target; broadcasts only
      under 64 MB measured (static estimate or AQE runtime size).
    """
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
