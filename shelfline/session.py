"""Session set-up and the runtime settings the library depends on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the plans are written for. They are applied only where
# the cluster has not chosen a value itself.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Bytes a task reads, from files or from a shuffle. Keys, dates and zeros compress: sorts and hash tables of what a task read take up to
# 20 times as much, so Spark's 128 and 64 MB are a gigabyte and more. A size the session chose while it ran is left alone too.
_SIZES = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Partitions a shuffle starts with. Adaptive execution merges them up to the size above, but never splits those of an aggregate, a window
# or a sort, so there must be enough for the largest tables, however few the session shuffles small ones to. Not more than 200, though:
# up to there a task writes each row straight to its partition's file, beyond it holds all it writes in memory.
_STARTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
STARTING_PARTITIONS = 200


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prefer_defaults(spark)


def prefer_defaults(spark: SparkSession, partitions: bool = True) -> SparkSession:
    """Apply the library's adaptive-execution settings to a session that has not set them.

    Without ``partitions`` shuffles start with the number the session shuffles to, unless it has another already.
    """
    explicit = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _DEFAULTS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    for key, value in _SIZES.items():
        if key not in explicit and key not in spark.conf.getAll:
            spark.conf.set(key, value)
    if partitions and _STARTING not in explicit and spark.conf.get(_STARTING, str(STARTING_PARTITIONS)) == str(STARTING_PARTITIONS):
        shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(_STARTING, str(max(STARTING_PARTITIONS, shuffled)))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the cluster's ``spark.checkpoint.dir`` when it names one.

    Only a local master gets a temporary folder; on a cluster a machine-local
    folder would be lost with its machine, so a missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="shelfline-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
