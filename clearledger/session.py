"""Session settings the cleaning jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 32_000
MAX_SCAN_TASKS = 100_000

# What every job needs, whatever the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode. A wide projection that
    # fuses into a larger one would run interpreted, so let Spark give up whole-stage code for
    # that part of the plan instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Plans here hold thousands of small expressions; recording the Python line of each one, which
# only serves error messages, doubles the time it takes to build a plan.
DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def shuffle_settings(
    input_bytes: int,
    cores: int,
    max_partitions: int = MAX_SHUFFLE_PARTITIONS,
    max_scan_tasks: int = MAX_SCAN_TASKS,
) -> dict[str, str]:
    """Shuffle and scan sizing for a job that reads ``input_bytes``.

    Adaptive execution can merge shuffle partitions that turn out small but cannot add any, so
    the starting number is sized for the whole input, and at least two waves of tasks. A
    shuffle has one block per map and reduce task, so both are bounded: a larger input gets
    larger partitions, which the sorts spill, instead of ever more of them. Raise
    ``max_partitions`` above about 8 TB where the shuffle service can bear more blocks.
    """
    partitions = min(max(2 * cores, -(-input_bytes // TARGET_PARTITION_BYTES)), max_partitions)
    split = max(TARGET_PARTITION_BYTES, -(-input_bytes // max_scan_tasks))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        # Else Spark merges partitions only down to one a core, whatever their size.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def require(spark: SparkSession) -> SparkSession:
    """Put the required SQL settings on a session that somebody else built."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Start (or get) a session with the required and default settings, then ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **REQUIRED, **settings}.items():
        builder = builder.config(key, value)
    return require(builder.getOrCreate())
