"""Spark session defaults for local runs and tests.

On a cluster the session comes from the caller; these helpers only fill in
settings that are unset.  ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the session (the shared folder the cluster names) and only sets a
private folder when none is configured.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
    # Generated methods above HotSpot's 8000-byte limit are never JIT-compiled;
    # the wide survey projections hit it.  Fall back to the (JIT-compiled)
    # iterator code for such stages, and let the JIT compile huge methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A window/aggregate must be partitioned on all of its keys: an upstream
    # partitioning on a subset (say person_id alone) would otherwise be reused
    # and put every row of a hot subset value in one task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wayfarer") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a private temp folder only if none is set.

    Order: ``spark.checkpoint.dir``, then a folder already given to
    ``SparkContext.setCheckpointDir``.  The temp-folder fallback is for plain
    local mode (tests, bench) only: where executors are processes of their own
    a machine-local folder would be lost with them, so an unset folder is an
    error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
        if not d:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir is not set: name a shared folder "
                                 "(HDFS/object store) for checkpoints on a cluster")
            d = tempfile.mkdtemp(prefix="wayfarer-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def limit_methods(spark: SparkSession) -> None:
    """``spark.sql.codegen.hugeMethodLimit`` as in ``LOCAL_DEFAULTS``, unless the context or the session has set it.

    The wide survey projections compile to one method beyond what the JIT takes, which then runs as
    plain bytecode (a scan with all linked-trip columns: four times the CPU time).
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if not spark.sparkContext.getConf().contains(key) and key not in spark.conf.getAll:
        spark.conf.set(key, LOCAL_DEFAULTS[key])


# Settings for a large cluster (set on the session when the cluster has not
# set them).  AQE sizes shuffle partitions from runtime statistics (start
# high, coalesce to ~256 MB), splits skewed join partitions, and picks
# broadcasts only from measured sizes.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}


def apply_cluster_defaults(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set ``CLUSTER_DEFAULTS`` (and ``overrides``) for keys that neither the context nor the session has set."""
    conf = spark.sparkContext.getConf()
    on_session = set(spark.conf.getAll)
    for k, v in {**CLUSTER_DEFAULTS, **(overrides or {})}.items():
        if not conf.contains(k) and k not in on_session:
            spark.conf.set(k, v)
