"""Sessions for tests and benchmarks, their size settings, and the shared folder intermediate data goes to."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes of heap that Spark keeps from its tasks.
RESERVED_HEAP = 300 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerkit")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=None)
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerkit-{app_id}-")


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder under ``spark.checkpoint.dir``.

    A machine-local folder stands in only where that is unset and Spark itself is local.
    """
    app_id = spark.sparkContext.applicationId
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return f"{root.rstrip('/')}/ledgerkit-{app_id}"
    if spark.sparkContext.master.startswith("local"):
        return _local_folder(app_id)
    raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def byte_size(setting: str) -> int:
    """A size setting such as ``10485760b``, ``10m`` or ``-1`` in bytes."""
    unit = setting.strip().lower().removesuffix("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit[-1:], 1)
    return int(unit.rstrip("kmg")) * factor


def task_memory(spark: SparkSession) -> int:
    """Bytes of heap that a task of a join can count on while all cores are busy; too few rather than too many."""
    context = spark.sparkContext
    conf, cores = context.getConf(), context.defaultParallelism
    if context.master.split("[")[0] == "local":
        machine = spark._jvm.java.lang.Runtime.getRuntime()
        heap, cores = machine.maxMemory(), max(cores, machine.availableProcessors())
    else:
        heap = byte_size(conf.get("spark.executor.memory", "1g"))
        cores = int(conf.get("spark.executor.cores", str(cores)))
    return int((heap - RESERVED_HEAP) * float(conf.get("spark.memory.fraction", "0.6")) / max(cores, 1))
