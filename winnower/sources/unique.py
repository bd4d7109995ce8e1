"""A table that takes each key once, over all batches that ever arrive."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.operators import bloom
from winnower.operators.dedupe import first_per_key
from winnower.session import folder_names, move_folder, remove_folder

DAY = "day"
#: Where rows without a day are filed.
UNDATED = "1970-01-01"


@dataclass(frozen=True)
class UniqueTable:
    """Parquet rows by batch and day, with Bloom filters of each day's keys beside them.

    A batch goes against the filters first, so only days that may hold one of its keys are read, and of those only the
    key column.
    """

    root: str
    key: str = "message_id"
    order: tuple[str, ...] = ("timestamp", "offset")

    def _batch(self, name: str) -> str:
        return f"{self.root}/batches/batch={name}"

    def _stored(self, spark: SparkSession, part: str) -> DataFrame | None:
        if not folder_names(spark, f"{self.root}/batches/batch=*/part={part}/filed=*"):
            return None
        return spark.read.option("basePath", f"{self.root}/batches").parquet(f"{self.root}/batches/batch=*/part={part}").drop("part")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows, with the day and the batch they came in; None before the first row."""
        return self._stored(spark, "rows")

    def locate(self, keys: DataFrame) -> DataFrame:
        """(key, day) of the stored rows that have one of the keys. Days without a candidate are not read."""
        spark = keys.sparkSession
        none = keys.select(self.key, F.lit(None).cast("date").alias(DAY)).where(F.lit(False))
        rows, filters = self.read(spark), self._stored(spark, "filters")
        if rows is None:
            return none
        days = bloom.groups_to_read(keys, self.key, filters, "filed")
        if not days:
            return none
        candidates = rows.where(F.col("filed").isin(days)).select(self.key, "filed")
        return candidates.join(keys.select(self.key), self.key, "left_semi").distinct().withColumnRenamed("filed", DAY)

    def append(self, batch: DataFrame, name: str) -> None:
        """Store the rows of a batch whose key is new, the first of each by ``order``; a repeated batch changes nothing.

        The batch needs a column ``day``. Rows without a key are all kept. A batch is written aside with its filters
        and moved to its place in one step, so a reader sees it whole or not at all. Batches of one table must not run
        at the same time; a streaming query runs its own one after the other.
        """
        spark = batch.sparkSession
        if folder_names(spark, self._batch(name)):
            return
        aside = f"{self.root}/_writing/{uuid.uuid4().hex}"
        filed = F.coalesce(F.col(DAY), F.lit(UNDATED).cast("date"))
        keyless = batch.where(F.col(self.key).isNull())
        once = first_per_key(batch.where(F.col(self.key).isNotNull()), [self.key], [c for c in self.order if c in batch.columns])
        arrived = _stage(once.unionByName(keyless).withColumn("filed", filed), f"{aside}/arrived")
        known = self.locate(arrived).select(self.key)
        new = arrived.join(known, self.key, "left_anti").select(*arrived.columns).hint("rebalance", "filed")
        new = _stage(new, f"{aside}/part=rows", ["filed"])
        bloom.filter_rows(new, self.key, ["filed"]).hint("rebalance", "filed").write.partitionBy("filed").parquet(f"{aside}/part=filters")
        remove_folder(spark, f"{aside}/arrived")
        move_folder(spark, aside, self._batch(name))


def _stage(df: DataFrame, folder: str, partitions: Sequence[str] = ()) -> DataFrame:
    df.write.partitionBy(*partitions).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
