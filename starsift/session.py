"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC times and adaptive execution; cluster settings win where given."""
    builder = (
        SparkSession.builder.appName("starsift")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # stored intermediate rows go once nothing refers to them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "12g")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="starsift-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as stored in the shared folder; later steps start from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


#: Rows and bytes of a batch that goes to Python: texts and sets are long, so Spark's defaults fill memory.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20
_BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", BATCH_BYTES),
}


def bounded_batches(spark: SparkSession) -> None:
    """Sets rows and bytes of a batch for this session, unless it has settings of its own; results do not depend on them."""
    for setting, (default, bound) in _BATCH_SETTINGS.items():
        if spark.conf.get(setting) == default:
            spark.conf.set(setting, str(bound))
