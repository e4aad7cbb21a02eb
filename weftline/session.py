"""Sessions, and intermediate tables that survive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weftline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset and all runs on one machine, as in tests, one below the warehouse."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not found and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints").rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, and any executor can read it."""
    path = f"{shared_dir(df.sparkSession)}/weftline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/weftline-" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
