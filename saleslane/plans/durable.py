"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster session
    without it is an error, because a folder of one machine is not shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="saleslane-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder


def durable(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """The frame written once as a table in the checkpoint folder and read back from there.

    Unlike ``checkpoint()``, which runs an uncached plan twice, this runs it once, and what
    comes back is a columnar scan that later steps prune and filter.  ``schema`` reads stored
    structs as the user-defined types that share their layout.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
