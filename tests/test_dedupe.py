from __future__ import annotations

from winnower.operators.dedupe import dedupe_stream, first_per_key, split_late
from winnower.operators.union import union_by_name
from winnower.streaming.jobs import start_table


def hot(spark):
    """A third of the rows share one key."""
    return spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 500) END AS k",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, (id * 7919) % 3000) AS at",
        "id AS payload",
    )


def test_first_per_key_against_brute_force(spark):
    rows = hot(spark).collect()
    expected = {}
    for r in rows:
        if r.k not in expected or (r.at, r.payload) < expected[r.k]:
            expected[r.k] = (r.at, r.payload)
    got = {r.k: (r.at, r.payload) for r in first_per_key(hot(spark), ["k"], ["at"]).collect()}
    assert got == expected


def test_a_time_comes_before_none(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, NULL, 'x'), (1, timestamp'2024-01-01', 'y'), (2, NULL, 'z') t(k, at, v)")
    assert sorted((r.k, r.v) for r in first_per_key(rows, ["k"], ["at"]).collect()) == [(1, "y"), (2, "z")]


def test_every_row_is_in_time_or_late(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01 00:00', timestamp'2024-01-01 01:00'), "
                     "(2, timestamp'2024-01-01 00:00', timestamp'2024-01-01 01:01'), (3, NULL, timestamp'2024-01-01') t(k, at, got)")
    in_time, late = split_late(rows, "at", "got", "1 hour")
    assert ([r.k for r in in_time.collect()], sorted(r.k for r in late.collect())) == ([1], [2, 3])


def test_identical_copies_of_a_hot_key_are_dropped(spark, tmp_path):
    spark.range(4000).selectExpr("'hot' AS k", "timestamp'2024-01-01' AS at").repartition(8).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, at timestamp").parquet(f"{tmp_path}/in")
    start_table(dedupe_stream(stream, ["k"], "at", "1 day"), f"{tmp_path}/out", "d", f"{tmp_path}/s", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_streams_drop_repeats_of_a_hot_key(spark, tmp_path):
    hot(spark).repartition(6).write.parquet(f"{tmp_path}/in")
    expected = sorted(r.k for r in hot(spark).select("k").distinct().collect())
    for spread in (1, 8):
        stream = spark.readStream.schema("k string, at timestamp, payload long").option("maxFilesPerTrigger", 2).parquet(
            f"{tmp_path}/in"
        )
        once = dedupe_stream(stream, ["k"], "at", "1 day", spread)
        start_table(once, f"{tmp_path}/out{spread}", "d", f"{tmp_path}/state{spread}", once=True).awaitTermination()
        assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out{spread}").collect()) == expected


def test_union_matches_names_and_widens(spark):
    a = spark.sql("SELECT 1 AS id, 2.5D AS x")
    b = spark.sql("SELECT 3 AS X, 4 AS ID")
    got = union_by_name([a, b, a])
    assert [tuple(r) for r in got.collect()] == [(1, 2.5), (4, 3.0), (1, 2.5)]
    missing = union_by_name([a, spark.sql("SELECT 9 AS id")], allow_missing=True)
    assert [tuple(r) for r in missing.collect()] == [(1, 2.5), (9, None)]
