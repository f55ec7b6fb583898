"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings this engine relies on.  AQE re-plans joins at runtime (a join side
# is broadcast only when its measured size is under the threshold; otherwise
# a sort-merge join stays) and splits skewed shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lower bound for coalesced shuffle partitions: only binds on tiny
    # shuffles (keeps them spread over the cores), never at scale
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tapflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the engine's recommended settings.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` to
    the data (about 128-256 MB of shuffle output per partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    and the master is local (tests) a scratch folder is created and set; on
    a cluster an unset folder is an error, never a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:            # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", str(master)):      # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tapflow-ckpt-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tapflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut there, and a result consumed by several branches of
    one plan is computed once instead of once per branch."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tapflow`` importable in executor Python workers, as
    ``--py-files`` would: the package is zipped once per application and
    added with ``addPyFile`` (``addArtifacts`` under Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:
        sc = None
    key = sc.applicationId if sc is not None else id(spark)
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="tapflow-pkg-"), "tapflow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(zpath)
    else:
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(key)
