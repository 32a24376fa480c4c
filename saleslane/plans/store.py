"""Stored stages of a run: finished ones are read back, also after the run was killed.

A stage is named by a hash of what it is made from: the contents of the input tables, the parameters
and the stages before it.  Its table gets a folder that nothing else writes to, and a row in the
manifest only once the table is whole.  So a run resumes after its last finished stage, a change of
one parameter repeats only the stages behind it, and what a killed run left half done is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.sources.published import file_system

MANIFEST = "stage string, key string, path string"


def content_key(df: DataFrame) -> str:
    """A hash of a table's rows and columns, whatever their order and partitions; one scan."""
    names = sorted(df.columns)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema]
    row = F.xxhash64(*(F.col(f"`{c}`") for c in names), *(F.col(f"`{c}`").isNull() for c in names))
    sums = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    return hash_of(sorted(kinds), list(sums))


def hash_of(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


class StageStore:
    """The stages kept under one folder, which all executors must reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _finished(self) -> dict[str, str]:
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        # Two runs may have finished the same stage; either table is whole.
        return {r["key"]: r["path"] for r in sorted(rows, key=lambda r: r["path"])}

    def path_of(self, stage: str, key: str, write: Callable[[str], None]) -> str:
        """The folder of a finished stage; ``write`` fills a new one if it is not finished."""
        found = self._finished().get(key)
        if found is None:
            found = f"{self.path}/{stage}-{uuid.uuid4().hex}"
            write(found)
            row = self.spark.createDataFrame([(stage, key, found)], MANIFEST)
            row.coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return found

    def table(self, stage: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stage that is one table; ``build`` is called only if it is not finished."""
        return self.spark.read.parquet(self.path_of(stage, key, lambda path: build().write.parquet(path)))

    def stages(self) -> DataFrame:
        """The manifest: one row (stage, key, path) per finished stage."""
        return self.spark.createDataFrame([(p.rsplit("/", 1)[1].split("-")[0], k, p) for k, p in self._finished().items()], MANIFEST)

    def remove(self) -> None:
        """Delete all stages and the manifest."""
        system, path = file_system(self.path)
        if system.get_file_info(path).type == fs.FileType.Directory:
            system.delete_dir(path)
