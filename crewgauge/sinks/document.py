"""The study document as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_document(document: DataFrame, path: str) -> None:
    """One JSON object; undefined figures are written as null, not dropped."""
    document.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_document(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
