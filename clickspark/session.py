"""Session helpers: a tuned local session for tests/bench, and shared scratch space.

Scratch space always lives under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``). A private folder is created only when the session
runs in local mode and no folder is configured (tests, bench).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "clickspark") -> SparkSession:
    """Session for tests and the bench: AQE on, shuffle partitions sized to cores."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or max(8, cores * 2)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # checkpoints written by prefix sums are removed once their DataFrame is gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLICKSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and
    the master is local does it create one (a fresh folder per process).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="clickspark-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)    # private to this process
        spark.conf.set(_CKPT_KEY, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/clickspark-{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str) -> DataFrame:
    """Written once to the scratch folder and read from there. The shuffles behind the
    rows leave the disk as soon as they are written; a checkpoint or a cached table keeps them."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        path = scratch_path(spark, name)
        df.select("*").write.parquet(path)          # planned anew, with the setting
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the scratch files that ``df`` reads, all of which ``store`` has written."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    if any("/clickspark-" not in f for f in folders):
        raise ValueError("only stored tables can be discarded")
    for f in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df):
    """Cut lineage with a reliable checkpoint (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
