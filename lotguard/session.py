"""Session construction and the shared scratch location.

On a cluster the scratch location is whatever ``spark.checkpoint.dir`` names
(a shared file system); a default under /tmp is only set when the session has
none, which is the local-test case.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce small shuffle partitions only below 64 KB, so small stages keep
    # one task per core (no effect once partitions are large).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Let AQE turn a join into a broadcast only after it has measured the
    # build side at run time; static estimates of derived tables are unreliable.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def get_session(master: str = "local[8]", app: str = "lotguard", **conf: str) -> SparkSession:
    """Session with AQE on and the UI off. Shuffle partitions: the core count
    in local mode (tests); on a cluster 4x the cores unless given, with AQE
    coalescing small partitions at run time."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in conf:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", str(cores if master.startswith("local") else 4 * cores))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; in local mode one is created if unset,
    on a cluster that is an error (no machine's own folder would do)."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lotguard-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    return path


#: Rows of a written table of keys and figures (some MB) that a join may broadcast.
SMALL_ROWS = 100_000


def known_small(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A table of short rows that is cheap to read (batches, totals), to be
    broadcast to its join if it has at most ``rows``: the other side is then not
    shuffled. A larger one stays as it is."""
    return F.broadcast(table) if table.count() <= rows else table


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint location and read it back: its
    lineage ends there, and what reads it twice computes it once."""
    path = f"{scratch_dir(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
