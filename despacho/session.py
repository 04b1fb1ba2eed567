"""Spark session profile and the shared folder for written results."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Sizes are of compressed rows, and the rows of a hot key compress well: split them early.
SPLIT_EARLY = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
}
PROFILE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **SPLIT_EARLY,
}


def build_session(app: str, cpus: int, **settings: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session.

    Its tables are about a thousandth of a cluster's, and so is the size below
    which shuffle partitions are joined: else every small shuffle is one task,
    and what one task wrote can't be split where a key is hot.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**PROFILE, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def split_hot_keys_early(spark: SparkSession) -> None:
    """Let adaptive joins split hot partitions from 32 MB on, unless the session says otherwise."""
    for key, value in SPLIT_EARLY.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


# Facts meet a dimension too large to broadcast behind a Bloom filter of its keys; Spark's own limit is 10 MB.
THINNING = {"spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512MB"}
SHUFFLE_BYTES = 128 << 20  # of the scanned data for a partition


def tune(spark: SparkSession, scanned_bytes: int = 0) -> None:
    """Apply the profile to a cluster's session and size its shuffles.

    Adaptive execution joins small shuffle partitions but does not add any, so
    it starts from one per 128 MB of ``scanned_bytes`` and at least three per
    core, unless the session names a number itself.
    """
    for key, value in {**PROFILE, **THINNING}.items():
        spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    configured = {"spark.sql.shuffle.partitions", initial} & dict(spark.sparkContext.getConf().getAll()).keys()
    if not configured:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(initial, str(max(200, 3 * cores, -(-scanned_bytes // SHUFFLE_BYTES))))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a folder, as its file system tells them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may go without the setting; it then gets a temporary
    folder, the same one throughout the application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="despacho-")
        folder = _local_folders[application]
    return folder.rstrip("/")


def delivery_folder(spark: SparkSession) -> str:
    """Where deliveries go that name no root: ``spark.despacho.delivery``, else a folder beside the checkpoints."""
    folder = spark.conf.get("spark.despacho.delivery", None)
    return folder.rstrip("/") if folder else f"{shared_folder(spark)}/despacho"
