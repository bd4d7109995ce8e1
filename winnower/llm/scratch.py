"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_folder


def ship(spark: SparkSession) -> None:
    """Let local Python workers import this package; on a cluster it comes with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


class Scratch:
    """Writes tables below ``spark.checkpoint.dir``, which cuts the lineage: a lost executor loses none of their rows."""

    def __init__(self, spark: SparkSession, purpose: str):
        ship(spark)
        self.spark = spark
        self.root = fresh_folder(spark, purpose)
        self.count = 0

    def table(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
