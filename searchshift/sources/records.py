"""Records: cutting into batches, and loading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators.mapping import spark_schema
from ..operators.numbering import number_rows


def batch_records(df: DataFrame, order_cols: list[str], size: int = rules.BATCH_SIZE) -> DataFrame:
    """Rows with their position in input order and their batch, both from 0."""
    numbered = number_rows(df, order_cols, "row_index")
    return numbered.withColumn("batch", F.floor(F.col("row_index") / size))


def batch_summary(batches: DataFrame) -> DataFrame:
    """Records of each batch, with first and last position counted from 1."""
    return batches.groupBy("batch").agg(
        F.count("*").alias("records"), (F.min("row_index") + 1).alias("first_record"),
        (F.max("row_index") + 1).alias("last_record"))


def load_records(spark: SparkSession, path: str, target_types: dict[str, str]) -> DataFrame:
    """Records from JSON files that hold one array each, under the mapped types."""
    return spark.read.schema(spark_schema(target_types)).json(path, multiLine=True)
