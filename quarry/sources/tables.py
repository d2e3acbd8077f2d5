"""Readers of the Parquet tables that queries work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` under `sf_dir`, a path in any store that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
