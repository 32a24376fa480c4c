"""Readers and writers of panels, tuned parameters and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslane import schemas
from saleslane.functions.exprs import nan_to_null


def read_panel(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read CSV or Parquet with a given schema; dates may be strings, timestamps or dates.

    CSV is read with the schema, never inferred; a value that does not fit it is an error.  Parquet keeps its own types and is cast, so
    filters and column selections still reach the scan.
    """
    if fmt == "csv":
        text = T.StructType(
            [
                T.StructField(f.name, T.StringType() if f.name == "date" else f.dataType)
                for f in schema
            ]
        )
        raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    typed = raw.select(*(_typed(f) for f in schema))
    return nan_to_null(typed)


def _typed(field: T.StructField):
    column = F.col(field.name)
    cast = F.to_date(column) if field.name == "date" else column.cast(field.dataType)
    return cast.alias(field.name)


def read_sku_day(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_panel(spark, path, schemas.SKU_DAY, fmt)


def read_exog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_panel(spark, path, schemas.EXOG, fmt)


def write_panel(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a panel or a report, optionally partitioned by low-cardinality columns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def save_params(spark: SparkSession, params: dict[str, float], path: str) -> None:
    """Tuned parameters as one JSON row ``{"pooled": {name: number}}``."""
    values = {name: float(value) for name, value in params.items()}
    row = spark.createDataFrame([(values,)], "pooled map<string,double>")
    row.coalesce(1).write.mode("overwrite").json(path)


def load_params(spark: SparkSession, path: str) -> dict[str, float] | None:
    """Saved parameters, or None if nothing has been saved at ``path``."""
    try:
        row = spark.read.schema("pooled map<string,double>").json(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return dict(row["pooled"]) if row else {}


def load_ets_state(spark: SparkSession, path: str) -> DataFrame:
    """The smoothing states that a run has saved under ``path``; forecasts start from them."""
    return spark.read.parquet(f"{path}/ets_state")
