"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job expects: AQE re-plans joins and partition counts at run
# time (and splits skewed join partitions, also below another join), bad
# values raise, timestamps are read in UTC.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",  # windows-1252 message loads
}

# Settings of the campaign's queries: a shuffle starts from many partitions and
# AQE joins them up to 16 MB, so the sorts of a task stay as small when the input grows.
# A stage becomes one method only where the JVM compiles it too: methods of over 8,000
# bytes, such as the 64 columns of the base, would be interpreted.
CAMPAIGN_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The shuffle files of a stored stage go when it is stored, not when the driver's memory is next cleaned.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "offerline",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("OFFERLINE_DRIVER_MEMORY", _driver_memory()))
               .config("spark.sql.legacy.javaCharsets", "true")
               # Let the JIT compile Spark's large generated methods (the
               # 64-column campaign stage); set the same on executors.
               .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods"))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _driver_memory(cap_mb: int = 8192) -> str:
    """60% of physical memory, at most ``cap_mb`` (local mode: the driver JVM
    holds every executor thread)."""
    try:
        with open("/proc/meminfo") as fh:
            total_kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1024, min(cap_mb, int(total_kb / 1024 * 0.6)))}m"
    except (OSError, StopIteration, ValueError):
        return "4g"


def apply_job_conf(spark: SparkSession, campaign: bool = True) -> SparkSession:
    """Set the job settings on an existing (cluster) session; without
    ``campaign`` the campaign's own are taken back."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    for k, v in CAMPAIGN_CONF.items():
        if campaign:
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) == v:
            spark.conf.unset(k)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Checkpoint directory from ``spark.checkpoint.dir``; a local temporary
    folder is used only when the session names none (local tests)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured is None and sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if configured is None and fallback is None and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = configured or fallback or tempfile.mkdtemp(prefix="offerline-ckpt-")
    sc.setCheckpointDir(path)
    return path
