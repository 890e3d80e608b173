"""Session helpers: building a session for local runs and finding the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of size: AQE re-plans shuffles at
# runtime (partition coalescing, skew-join splitting), Arrow speeds pandas
# transfer, and UTC keeps timestamp semantics independent of the host.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clientlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no server port)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("CLIENTLENS_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster job over ``input_bytes`` of input.

    Scan splits and post-shuffle partitions aim at ``target_partition_bytes``
    (fits comfortably in executor memory, no spill for the aggregations here);
    the initial shuffle partition count is at least two waves of the cores
    and at least input / target, and AQE then coalesces small partitions and
    splits skewed ones at runtime. Example: 100 TB (10^14 bytes) on 8,000
    cores gives 372,530 initial shuffle partitions of 256 MiB.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # keep broadcast decisions to sides whose size Spark has measured
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a local master
    (tests, the bench) gets a scratch folder if none is set; on a cluster a
    missing ``spark.checkpoint.dir`` is an error, since a folder of the
    driver's disk is invisible to executors."""
    sc = _context(spark)
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        return root
    conf = _conf(spark, "spark.checkpoint.dir")
    if not conf:
        if sc is None or not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="clientlens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


def _conf(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None)


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (Connect sessions raise here)
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


def parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "8"))


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local
    temp folder on a cluster): stream checkpoints, sink tables, round trips."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = "/".join(parts)
    if unique:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    return f"{root}/clientlens/{name}"
