"""What every operator needs of the session: this package on the executors, and tables written to the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import statledger
from pyspark.sql import DataFrame, SparkSession

from statledger.session import shared_dir

_SHIPPED = "spark.statledger.shipped"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    if spark.conf.get(_SHIPPED, "") != spark.sparkContext.applicationId:
        root = os.path.dirname(os.path.abspath(statledger.__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="statledger-"), "statledger_package.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.join("statledger", os.path.relpath(path, root)))
        spark.sparkContext.addPyFile(archive)
        spark.conf.set(_SHIPPED, spark.sparkContext.applicationId)
    return spark


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder in spark.checkpoint.dir."""
    return f"{shared_dir(spark)}/statledger/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
