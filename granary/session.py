"""Sessions and the shared folder in which long plans are cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("granary")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only where that is unset (one machine), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="granary-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let at most ``rows`` rows go to a Python worker at once: texts are long, and the default of 10,000 suits numbers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def few_files(spark: SparkSession) -> None:
    """Let small shuffles shrink to partitions of the advisory size, not to one a core: each partition written is a file."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.

    Every executor can read the files, so a lost executor costs no recomputation; unlike ``checkpoint()`` the files are
    columnar and compressed, and later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/granary-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files behind a frame made by ``written`` once nothing needs it."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles() if "/granary-" in f}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
