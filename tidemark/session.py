"""Session helpers: the settings this library expects and its shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
MADE: list[str] = []
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "tidemark", cores: str = "8", memory: str = "8g", shuffle_partitions: int | None = None
) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, bring your own.

    `shuffle_partitions` stays at the core count here. On a cluster set it to two or three
    times the executor cores and let adaptive execution merge the small ones.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only where the session names none (plain local tests) is a temporary folder made and set.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"executors need a shared folder: set {CHECKPOINT_SETTING}")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder name below the shared folder."""
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    MADE.append(path)
    return path


def is_scratch(path: str, beside: str | None = None) -> bool:
    """Whether `release` would delete `path`, unless it would delete `beside` with it."""
    plain = lambda p: "/" + p.removeprefix("file:").strip("/") + "/"
    made = [plain(m) for m in MADE]
    return any(plain(path).startswith(m) and not (beside and plain(beside).startswith(m)) for m in made)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete every scratch folder this process made. Call it when their results are read."""
    while MADE:
        delete_folder(spark, MADE.pop())
