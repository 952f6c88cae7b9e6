"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lendscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of input that one shuffle partition is planned for.
SHUFFLE_BYTES = 256 << 20


def partitions_for(input_bytes: int, least: int = 200) -> int:
    """Shuffle partitions for an input, a quarter of a gigabyte each: 100 TB give about 400,000."""
    return max(least, -(-input_bytes // SHUFFLE_BYTES))


def cluster_session(input_bytes: int) -> SparkSession:
    """A session for a job over ``input_bytes`` of tables; the master and spark.checkpoint.dir come from the cluster.

    Shuffles start with partitions sized from the input, and the adaptive rules join small ones
    and split skewed ones.
    """
    return (
        SparkSession.builder.appName("lendscope")
        .config("spark.sql.shuffle.partitions", str(partitions_for(input_bytes)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "256m")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if "folder" not in _LOCAL:
        _LOCAL["folder"] = tempfile.mkdtemp(prefix="lendscope-")
    return _LOCAL["folder"]


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder for one run of one job."""
    return f"{shared_folder(spark)}/lendscope/{purpose}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df, purpose: str):
    """Write ``df`` once to the shared folder and read it back.

    The written files cut the lineage and survive lost executors, and a value
    that depends on the row layout stays the same however often it is read.
    """
    path = run_folder(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
