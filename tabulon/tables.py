"""Reading the tables and keeping intermediate results where a lost executor cannot take them along."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LEFT: list[tuple] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; a file and a folder of files read alike."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tabulon-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _clear() -> None:
    while _LEFT:
        spark, path = _LEFT.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended; the folder belongs to the cluster
            pass


atexit.register(_clear)


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` as a table written to the shared folder and read back.

    Cuts the lineage and survives the loss of executors; columns not needed later are not read again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tabulon-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _LEFT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
