"""Session helpers: the configuration the operators assume and the shared
checkpoint folder used to cut long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins, coalesces small shuffle
# partitions and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cohortforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks. On a cluster the session is
    provided by the platform and only ``ensure_checkpoint_dir`` is needed."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the input: scan splits of ``partition_bytes``, an
    initial shuffle width that keeps each reducer near that size before AQE
    coalesces it, and AQE skew handling (a partition 5x the median and over
    1 GiB is split). E.g. 100 TB -> about 370,000 initial shuffle partitions,
    coalesced at run time."""
    parts = max(200, int(input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    """Set runtime SQL settings on an existing session."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and intermediate tables: the
    context's checkpoint folder, else the one named by ``spark.checkpoint.dir``.

    A private folder is made only for a local master (tests); a cluster without
    a shared folder is an error, since executors do not see each other's disks."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:  # Spark appends a folder of its own to the one that was set
        named = spark.conf.get("spark.checkpoint.dir", None)
        return named if named and named.rstrip("/") in d else os.path.dirname(d)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cohortforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


@contextmanager
def shuffles_end_with_jobs(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends. Else they stay until the
    driver happens to collect its garbage, beside those of all later queries."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: computed
    once, pruned by column in later reads, and kept when executors are lost. The
    shuffle files of the write go with it, so a job cut into written steps holds
    those of one step at a time."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_end_with_jobs(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes written steps that nothing reads any more."""
    for t in tables:
        base = scratch_path(t.sparkSession, "").split(":")[-1].strip("/")
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if base in folder:
                path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "cohortforge-tables", name)
