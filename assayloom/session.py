"""Session helpers: table access, vectorised text maps and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; Catalyst prunes its columns to those a query uses."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which outlives executors: the session's `spark.checkpoint.dir`.

    A folder of our own is used only where none is set and the master is local (tests); it is removed at exit.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="assayloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written as a table into the shared folder and read again: its lineage ends there, and columns are still pruned."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/assayloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables of this process; results that were not written yet cannot be computed any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def per_distinct(values: pd.Series, fn: Callable) -> list:
    """`fn` of each value, called once per distinct value of the batch; null stays None."""
    codes, seen = pd.factorize(values)
    mapped = [fn(v) for v in seen]
    return [mapped[c] if c >= 0 else None for c in codes]
