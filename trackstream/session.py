"""Session helpers: build a session, pin the time zone, find the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

# Settings every trackstream job relies on.  Event-time features (hour, day of
# week) must not follow the JVM zone, so the session zone is pinned to UTC.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture costs extra JVM round-trips on every Column
    # call while a plan is built; plans are identical without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state: RocksDB (off-heap, spills to local disk, needed by
    # transformWithState) with changelog checkpointing, so a micro-batch
    # commit uploads only the changes instead of a full snapshot.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "trackstream",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the trackstream defaults.

    ``master`` defaults to whatever spark-submit provided; tests pass
    ``local[*]``.  The web UI stays off: nothing here opens a server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`CORE_CONF` to a session made elsewhere.

    The time zone always, as results depend on it; of the rest, what can be set at run
    time and was not given when the application started."""
    try:
        given = spark.sparkContext.getConf()
    except PySparkAttributeError:       # Spark Connect: the server's settings apply
        given = None
    for k, v in CORE_CONF.items():
        if k == "spark.sql.session.timeZone" or (
                given is not None and not given.contains(k) and spark.conf.isModifiable(k)):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset *and* the session
    runs in local mode (tests, laptops) is a private scratch folder created.  On
    a cluster an unset value is an error: a machine-local folder would not
    survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running trackstream jobs on a cluster")
    path = tempfile.mkdtemp(prefix="trackstream-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    sub = f"{name}-{os.getpid()}-{next(_counter)}"
    return base.rstrip("/") + "/" + sub


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``trackstream`` importable in the Python workers that run its
    pandas UDFs, ``applyInPandas`` groups and stateful processors.

    Once per application the package is zipped and handed to
    ``SparkContext.addPyFile``, which serves it to every executor (new or
    replaced ones included).  Where the package is already installed on the
    executors, or shipped with ``--py-files``, this is a harmless no-op."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: ship with the session's artifacts
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="trackstream-pyfiles-")
    target = os.path.join(out_dir, "trackstream.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
