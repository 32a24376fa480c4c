"""Panels whose partitions are replaced one by one and become visible together.

``publish`` writes its rows to a folder of their own and only then appends one file to the manifest,
which names the partitions that the folder replaces.  Readers see what the manifest names: a write
that fails or is killed leaves the panel as it was, and nothing is deleted before its successor can
be read.  Publications are ordered by their number and, where two writers took the same number, by
their folder, so concurrent writers give the result of one order and lose nothing but what the
later one replaces.

Cases: an empty frame replaces nothing, or everything with ``whole``.  NULL is a partition of its own, and the
empty string is part of it.  Repeated rows stay repeated.  Columns that an older publication lacks are NULL in its rows; columns
that the newest one lacks are gone.  Other partition columns than the panel's are an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of the stored rows that tells their publication.
RUN = "panel_run"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path on it."""
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


class PublishedPanel:
    """A panel under one folder, which all executors must reach."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        if not partition_by:
            raise ValueError("a published panel needs partition columns")
        self.spark, self.path, self.keys = spark, path, tuple(partition_by)

    def _log(self) -> DataFrame | None:
        """One row (number, run, whole, schema, keys...) per replaced partition; NULL keys with ``whole``."""
        try:
            found = self.spark.read.parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        if tuple(found.schema["keys"].dataType.names) != self.keys:
            raise ValueError(f"the panel is partitioned by {found.schema['keys'].dataType.names}")
        return found

    def _live(self) -> DataFrame | None:
        """The newest publication (keys, run) of each partition that is still visible."""
        log = self._log()
        if log is None:
            return None
        emptied = log.filter("whole").agg(F.max(F.struct("number", "run")).alias("at")).first()["at"]
        if emptied is not None:
            later, same = F.col("number") > emptied["number"], F.col("number") == emptied["number"]
            log = log.filter(later | (same & (F.col("run") >= emptied["run"])))
        newest = F.max(F.struct("number", "run")).alias("newest")
        return log.filter(~F.col("whole")).groupBy("keys").agg(newest).select("keys", "newest.run")

    def publish(self, df: DataFrame, whole: bool = False) -> None:
        """Replace the partitions that occur in ``df``, or with ``whole`` all of them."""
        if RUN in df.columns:
            raise ValueError(f"the column {RUN} is the panel's own")
        log = self._log()
        number = (log.agg(F.max("number")).first()[0] if log is not None else None) or 0
        run = uuid.uuid4().hex
        folder = f"{self.path}/data/{RUN}={run}"
        # Small partitions share a task and large ones are split, so a day is not a file of every task.
        df.hint("rebalance", *self.keys).write.partitionBy(*self.keys).parquet(folder)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])

        def rows(found: DataFrame, emptied: bool, keys: Column) -> DataFrame:
            own = (number + 1, run, emptied, schema.json())
            kinds = zip(own, ("number", "run", "whole", "schema"), ("long", "string", "boolean", "string"), strict=True)
            return found.select(*(F.lit(v).cast(kind).alias(name) for v, name, kind in kinds), keys.alias("keys"))

        nothing = F.lit(None).cast(T.StructType([schema[k] for k in self.keys]))
        written = self.spark.read.schema(schema).parquet(folder).select(*self.keys).distinct()
        log = rows(self.spark.range(int(whole)), True, nothing).union(rows(written, False, F.struct(*self.keys)))
        # A single file appears by a single rename: all partitions change together.
        log.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def read(self) -> DataFrame:
        """The visible rows, with the columns of the newest publication; the partition columns come last."""
        log = self._log()
        newest = None if log is None else log.agg(F.max_by("schema", F.struct("number", "run")).alias("schema")).first()["schema"]
        if newest is None:
            raise ValueError(f"nothing has been published at {self.path}")
        schema = T.StructType.fromJson(json.loads(newest))
        columns = [c for c in schema.names if c not in self.keys] + list(self.keys)
        live = self._live()
        runs = [r["run"] for r in live.select("run").distinct().collect()]  # one per publication still visible
        if not runs:
            return self.spark.createDataFrame([], schema).select(*columns)
        stored = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
        base = f"{self.path}/data"
        rows = self.spark.read.schema(stored).option("basePath", base).parquet(*(f"{base}/{RUN}={r}" for r in runs))
        shown = live.select(F.col("run").alias("_run"), *(F.col(f"keys.{k}").alias(f"_{k}") for k in self.keys))
        same = [rows[RUN] == shown["_run"], *(rows[k].eqNullSafe(shown[f"_{k}"]) for k in self.keys)]
        return rows.join(shown, reduce(lambda a, b: a & b, same), "left_semi").select(*columns)

    def vacuum(self) -> int:
        """Delete the folders that no visible partition needs; call it while nobody reads or publishes."""
        live = self._live()
        needed = set() if live is None else {r["run"] for r in live.select("run").distinct().collect()}
        system, base = file_system(f"{self.path}/data")
        folders = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        dead = [f.path for f in folders if f.base_name.removeprefix(f"{RUN}=") not in needed]
        for path in dead:
            system.delete_dir(path)
        return len(dead)
