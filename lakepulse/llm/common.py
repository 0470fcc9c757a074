"""Shared folder, saved tables and release of shuffle files."""

from __future__ import annotations

import gc
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application, for Python functions that run there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-package-')}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only a local master may do without it (tests): a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now, not at the next garbage collection of the driver."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def save(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes df to the shared folder, in a folder per value of `by`, and reads it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes saved tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        parts = [name.rpartition("/llm/") for name in df.inputFiles()]
        for folder in {top + inner + rest.split("/")[0] for top, inner, rest in parts if inner}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(column: str = "text"):
    """Words of a text: runs of characters other than space and \\t..\\r."""
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
