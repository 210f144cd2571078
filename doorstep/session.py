"""Session settings and the shared working folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "doorstep", **conf) -> SparkSession:
    """A session with the settings the jobs rely on; master and sizing come from spark-submit.

    AQE carries the skew handling: it splits hot join partitions and skewed rebalance partitions,
    and coalesces the small exchanges behind low-cardinality reports.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        # Recording a Python call site for every column costs more than planning a small report.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config(STATE_PROVIDER, ROCKSDB_PROVIDER)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may fall back to a temporary folder of this machine, which goes when the
    application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="doorstep-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/doorstep/{label}-{uuid.uuid4().hex}"
