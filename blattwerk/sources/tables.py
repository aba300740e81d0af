"""Readers of the table folder that every registered query gets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole Parquet table ``name`` of ``sf_dir``; Spark prunes what a query does not use."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
