"""Run-scoped intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from crewgauge.session import scratch_database, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that a lost executor costs a re-read and nothing is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` as a table in buckets by ``column`` in the shared folder, which is not shuffled again to meet others by that column."""
    spark = df.sparkSession
    database = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, name)}'")
    scratch_database(database)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("compression", "zstd").saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")
