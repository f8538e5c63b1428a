"""Reading the prediction table back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalise_partitions(df: DataFrame) -> DataFrame:
    """Partition columns as written: ``date`` a ``yyyy-MM-dd`` string,
    ``query_id`` a string, ``batch_id`` a bigint (Spark infers ``date`` as a
    DATE and small ids as INT from the folder names). Filters on these
    expressions still prune folders."""
    if "date" in df.columns and not isinstance(df.schema["date"].dataType, T.StringType):
        df = df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    if "query_id" in df.columns:
        df = df.withColumn("query_id", F.col("query_id").cast("string"))
    if "batch_id" in df.columns:
        df = df.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return df


def read_predictions(spark: SparkSession, path: str, date: str | None = None,
                     since: str | None = None) -> DataFrame:
    """The date-partitioned prediction table; ``date``/``since`` filters on
    the partition column are pruned to the matching folders."""
    df = normalise_partitions(spark.read.option("basePath", path).parquet(path))
    if date is not None:
        df = df.where(F.col("date") == F.lit(date))
    if since is not None:
        df = df.where(F.col("date") >= F.lit(since))
    return df


def read_json_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON copy back as columns (``schema`` as DDL), with its partition columns."""
    lines = normalise_partitions(spark.read.text(path))
    return lines.select(F.from_json("value", schema).alias("r"), "date", "query_id", "batch_id") \
        .select("r.*", "date", "query_id", "batch_id")
