"""Session construction and the two I/O helpers every operator shares.

Nothing here fixes cluster sizes: a session that already exists (the driver's,
a cluster's) is used as it is; only what is unset gets a default.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", name: str = "corvidex", **conf: str) -> SparkSession:
    """A local session for tests and benches.  AQE stays on; shuffle width
    follows the cores, as a cluster's would follow its executors."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORVIDEX_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``base`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where the session
    has it; a temporary folder only in local mode, where there is one machine."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    d = tempfile.mkdtemp(prefix="corvidex-")
    spark.conf.set("spark.checkpoint.dir", f"file://{d}")
    return f"file://{d}"


_WRITTEN: list[str] = []


def clear(spark: SparkSession) -> int:
    """Deletes the tables this process has written to the shared folder, once no
    result that was made from them is needed any more; gives their number."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += p.getFileSystem(conf).delete(p, True)
    return n


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back.

    Survives executor loss (unlike localCheckpoint), is compressed, and gives
    the optimiser true sizes, so joins against it choose their own strategy.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
