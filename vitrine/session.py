"""SparkSession construction and cluster-facing settings.

The library never hard-codes a cluster layout.  `build_session` is what tests
and the bench use locally; on a cluster the caller brings its own session and
the library only reads settings from it (for example `spark.checkpoint.dir`).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every plan this library produces:
#  * AQE re-plans joins from runtime sizes (a dimension that turns out small is
#    broadcast, a big one stays sort-merge), coalesces small shuffle partitions,
#    and splits skewed join partitions (one hot product / order / client).
#  * Session time zone pinned so DATE/TIMESTAMP casts are reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "vitrine",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must be a shared folder named by
    `spark.checkpoint.dir`; it is read from the session and never replaced.
    Only a local-mode session without the setting (tests, the bench) gets a
    private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="vitrine-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cluster_conf(input_bytes: int, task_slots: int, shuffle_fraction: float = 0.1,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run; pass them to the session builder.

    * scans: `partition_bytes` per split (100 TB -> ~400k scan tasks of 256 MB);
    * shuffles: the widest shuffle of these plans moves the pruned columns of the
      order lines after partial aggregation, roughly `shuffle_fraction` of the
      input; it gets about `partition_bytes` per partition, at least two waves of
      the task slots (AQE coalesces what turns out small and splits skewed join
      partitions above the skew threshold);
    * the broadcast threshold stays small: only measured-small sides are broadcast.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(2 * task_slots, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
