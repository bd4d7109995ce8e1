from __future__ import annotations

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from winnower.operators import bloom
from winnower.plans import catalog
from winnower.sources.unique import UniqueTable

ROW = "message_id string, offset long, day date"


def test_filters_find_every_key_and_few_others(spark):
    stored = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3).alias("g"))
    filters = bloom.filter_rows(stored, "key", ["g"])
    assert {r.blocks for r in filters.collect()} == {4} and filters.count() == 12 and all(len(r.bitmap) == bloom.BITS // 8 for r in filters.collect())
    asked = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("key")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    hits = bloom.may_contain(asked, "key", filters, ["g"])
    assert hits.join(stored, ["key", "g"]).count() == 20_000
    assert hits.count() < 20_000 + 0.02 * 3 * 40_000
    twice = filters.union(filters)
    assert bloom.may_contain(asked, "key", twice, ["g"]).count() == hits.count()


def test_each_key_is_stored_once_over_batches(spark, tmp_path):
    rng = random.Random(3)
    table = UniqueTable(str(tmp_path))
    days = [None, *[date(2024, 1, d) for d in range(1, 8)]]
    seen: dict[str, int] = {}
    nameless = 0
    for n in range(4):
        rows = [(f"m{rng.randrange(300)}" if rng.random() < 0.95 else None, k, rng.choice(days)) for k in range(n * 1000, n * 1000 + 200)]
        table.append(spark.createDataFrame(rows, ROW), f"b{n}")
        table.append(spark.createDataFrame([("never", 1, None)], ROW), f"b{n}")  # a repeated batch
        for key, offset, _ in rows:
            if key is None:
                nameless += 1
            elif key not in seen or seen[key] >= n * 1000:
                seen[key] = min(offset, seen.get(key, offset))
    got = table.read(spark).collect()
    assert sorted((r.message_id, r.offset) for r in got if r.message_id) == sorted(seen.items())
    assert sum(r.message_id is None for r in got) == nameless
    found = table.locate(spark.createDataFrame([("m1",), ("none",), (None,)], "message_id string")).collect()
    assert {r.message_id for r in found} == {"m1"} & set(seen)


def test_a_hot_key_is_one_row(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("message_id"), F.col("id").alias("offset"), F.lit("2024-01-01").cast("date").alias("day"))
    table = UniqueTable(str(tmp_path))
    table.append(rows, "a")
    table.append(rows, "b")
    assert table.read(spark).count() == 20_001


def test_days_that_cannot_hold_a_key_are_not_read(spark, tmp_path):
    table = UniqueTable(str(tmp_path))
    table.append(spark.createDataFrame([(f"old{k}", k, date(2024, 1, 1)) for k in range(20)], ROW), "a")
    table.append(spark.createDataFrame([(f"new{k}", k, date(2024, 1, 2)) for k in range(20)], ROW), "b")
    for path in Path(tmp_path).glob("batches/batch=a/part=rows/filed=2024-01-01/*.parquet"):
        content = path.read_bytes()
        path.write_bytes(content[:4] + b"\xff" * 40 + content[44:])  # pages that cannot be read, below a good footer
        (path.parent / f".{path.name}.crc").unlink()
    with pytest.raises(Exception, match="(?i)parquet|read"):
        table.read(spark).collect()
    table.append(spark.createDataFrame([("new1", 7, date(2024, 1, 3)), ("newer", 8, date(2024, 1, 3))], ROW), "c")
    stored = spark.read.parquet(f"{tmp_path}/batches/batch=c/part=rows")
    assert [r.message_id for r in stored.collect()] == ["newer"]


def test_an_empty_batch(spark, tmp_path):
    table = UniqueTable(str(tmp_path))
    assert table.read(spark) is None
    table.append(spark.createDataFrame([], ROW), "a")
    table.append(spark.createDataFrame([("x", 1, None)], ROW), "b")
    assert [r.message_id for r in table.read(spark).collect()] == ["x"]


def test_many_keys_are_not_all_asked_of_every_day(spark, tmp_path, monkeypatch):
    table = UniqueTable(str(tmp_path))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
    stored = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("message_id"), F.col("id").alias("offset"), day.alias("day"))
    table.append(stored, "a")
    pairs, ask = [], bloom.may_contain

    def counted(keys, key, filters, groups):
        pairs.append(keys.count() * filters.select(*groups).distinct().count())
        return ask(keys, key, filters, groups)

    monkeypatch.setattr(bloom, "may_contain", counted)
    assert table.locate(stored.select("message_id")).exceptAll(stored.select("message_id", "day")).count() == 0
    assert table.locate(stored.select("message_id")).count() == 20_000
    assert sum(pairs) < 20_000


def test_one_known_key_among_many_new_ones_is_found(spark, tmp_path):
    table = UniqueTable(str(tmp_path))
    table.append(spark.createDataFrame([(f"old{n}", n, date(2024, 1, n)) for n in range(1, 6)], ROW), "a")
    new = spark.range(3_000).select(F.concat(F.lit("new"), "id").alias("message_id"))
    keys = new.union(spark.sql("SELECT explode(array('old3', NULL))"))
    assert [(r.message_id, r.day) for r in table.locate(keys).collect()] == [("old3", date(2024, 1, 3))]
    filters = table._stored(spark, "filters")
    assert bloom.groups_to_read(keys, "message_id", filters, "filed") == [date(2024, 1, 3)]
    assert bloom.groups_to_read(keys.where("message_id IS NULL"), "message_id", filters, "filed") == []


def test_a_delivery_of_many_files_is_one_batch(spark, tmp_path, monkeypatch):
    events = spark.range(300).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_704_100_000 + F.col("id") * 600).alias("ts"),
        (F.col("id") % 7).alias("user_id"), (F.col("id") / 2).alias("value"),
    )
    events.repartition(3).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(catalog, "fresh_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    got = catalog.QUERIES["unique_across_batches"](spark, f"{tmp_path}/in")
    assert sorted(map(tuple, got.collect())) == [(n, n % 7, n / 2) for n in range(300)]
    assert len(list(tmp_path.glob("unique/in/*/*.parquet"))) > 3
    assert len(list(tmp_path.glob("unique/table/batches/batch=*"))) == 3
