"""Parquet table access. Column lists are passed so the scan's ReadSchema
only carries what the plan uses (Catalyst prunes anyway; being explicit keeps
plans readable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
