from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, PROCESSED_TABLE, TRIP
from winnower.operators import metrics
from winnower.session import fresh_folder, scoped_conf
from winnower.sources import files, tables


def test_csv_schema_and_limit(spark, tmp_path):
    path = f"{tmp_path}/t.csv"
    spark.range(100).selectExpr("id", "id * 2 AS twice").coalesce(1).write.option("header", True).csv(path)
    assert files.read_csv(spark, path).schema.simpleString() == "struct<id:int,twice:int>"
    typed = files.read_csv(spark, path, spark.range(1).selectExpr("id", "id * 2D AS twice").schema)
    assert typed.count() == 100 and typed.schema["twice"].dataType.simpleString() == "double"
    assert files.read_csv(spark, path, limit=7).count() == 7


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    path = f"{tmp_path}/t.csv"
    spark.sql("SELECT 1 AS b, 2 AS a").write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, spark.sql("SELECT 1 AS a, 2 AS b").schema).collect()


def test_ingest_schema_leaves_moments_as_text():
    schema = files.ingest_schema(TRIP)
    assert schema["tpep_pickup_datetime"].dataType.simpleString() == "string"
    assert schema["VendorID"].dataType.simpleString() == "int"


def test_fallback(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    read = lambda s, p: s.read.parquet(p)
    found = files.read_first_available(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], read)
    assert found.count() == 3
    with pytest.raises(Exception, match="nosuch"):
        files.read_first_available(spark, ["nosuch://bucket/x", f"{tmp_path}/b"], read)
    found = files.read_first_available(spark, ["nosuch://bucket/x", f"{tmp_path}/b"], read, any_problem=True)
    assert found.count() == 3
    with pytest.raises(FileNotFoundError, match="no source"):
        files.read_first_available(spark, [f"{tmp_path}/a"], read)


def test_folding_takes_types_from_the_schema(spark, tmp_path):
    spark.sql("SELECT '007' AS code, 1 AS id").write.option("header", True).csv(f"{tmp_path}/a")
    spark.sql("SELECT 2 AS id, '008' AS code").write.option("header", True).csv(f"{tmp_path}/b")
    schema = spark.sql("SELECT 1L AS id, '' AS code").schema
    folded = files.fold_csv_to_parquet(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], f"{tmp_path}/c", schema)
    assert sorted(map(tuple, folded.select("id", "code").collect())) == [(1, "007"), (2, "008")]
    with pytest.raises(ValueError, match="lacks: code"):
        files.fold_csv_to_parquet(spark, [f"{tmp_path}/a"], f"{tmp_path}/d", spark.sql("SELECT 1L AS id").schema)


def test_whole_text(spark, tmp_path):
    (tmp_path / "o.txt").write_text("one\ntwo\n")
    assert [r.value for r in files.read_text_object(spark, f"{tmp_path}/o.txt").collect()] == ["one\ntwo\n"]
    assert files.read_text_object(spark, f"{tmp_path}/none.txt") is None


def test_backup_survives_any_text(spark, tmp_path):
    texts = ['plain', 'a "quoted" word', 'comma, and\nline break', '', None, ' spaces ', '{"k": "v"}', 'back\\slash']
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, payload string").withColumn(
        "at", F.lit("2024-01-01 10:00:00.123456").cast("timestamp")
    )
    folder = files.backup_to_csv(frame, str(tmp_path), rows_per_file=2)
    assert "/dlq_backups/" in folder
    restored = files.read_backup(spark, folder, frame.schema)
    assert sorted(restored.collect()) == sorted(frame.collect())


def test_run_stamp():
    from datetime import datetime

    assert files.run_stamp(datetime(2024, 3, 5, 6, 7, 8)) == "20240305_060708"


def test_daily_logs(spark, tmp_path):
    lines = spark.createDataFrame(
        [("2024-01-01T23:59:59.000Z", "a"), ("2024-01-02T00:00:00Z", "b"), ("soon", "c"), (None, "d")],
        "timestamp string, message string",
    ).withColumns({"@version": F.lit("1"), "@timestamp": F.lit("x")})
    files.write_daily_logs(lines, f"{tmp_path}/logs")
    stored = spark.read.option("pathGlobFilter", "*.json").json(f"{tmp_path}/logs")
    assert {(r.message, str(r.log_date)) for r in stored.collect()} == {
        ("a", "2024.01.01"), ("b", "2024.01.02"), ("c", "undated"), ("d", "undated")
    }
    assert not {"@version", "@timestamp"} & set(stored.columns)


def test_describe(spark):
    tree, sample = files.describe_frame(spark.range(100))
    assert "id: long" in tree and sample.count() == 5


@pytest.mark.parametrize("contract", [DEAD_LETTER_TABLE, PROCESSED_TABLE, FAILED_TABLE])
def test_tables_can_be_created_twice(spark, tmp_path, contract):
    name = f"t_{contract.name}"
    for _ in range(2):
        tables.create_table(spark, contract, name, f"{tmp_path}/t")
    assert set(spark.table(name).columns) == {*contract.names, "day"}
    spark.sql(f"DROP TABLE {name}")


def test_letters_table_defaults_and_pruning(spark, tmp_path):
    name = tables.create_table(spark, DEAD_LETTER_TABLE, "letters_test", f"{tmp_path}/t")
    row = spark.sql("SELECT 1L AS id, 'm' AS message_id, 't' AS topic, 0 AS partition, 5L AS offset, "
                    "timestamp'2024-01-01' AS timestamp, '{}' AS payload")
    row = tables.with_day(row, DEAD_LETTER_TABLE)
    tables.insert_by_name(row, name)
    tables.insert_by_name(row.withColumn("status", F.lit("FAILED")), name)
    pending = tables.letters_with_status(spark, name, "PENDING")
    got = pending.first()
    assert (got.retry_count, got.status) == (0, "PENDING") and got.created_at is not None
    plan = pending._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(status" in plan
    of_day = spark.table(name).where("day = DATE'2024-01-01'")
    assert of_day.count() == 2 and spark.table(name).where("day = DATE'2024-01-02'").count() == 0
    plan = of_day._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(day" in plan
    assert tables.one_per_message(spark.table(name)).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_letters_take_the_status_of_their_latest_attempt(spark):
    letters = spark.sql("SELECT id AS message_id, 'PENDING' AS status, timestamp'2024-01-01' AS updated_at FROM VALUES ('a'), ('b'), ('c') t(id)")
    changes = spark.sql("SELECT * FROM VALUES ('a', 'FAILED', timestamp'2024-01-02'), ('a', 'PROCESSED', timestamp'2024-01-03'), "
                        "('b', 'FAILED', timestamp'2024-01-02') t(message_id, status, updated_at)")
    got = {r.message_id: r.status for r in tables.move_letters(letters, changes).collect()}
    assert got == {"a": "PROCESSED", "b": "FAILED", "c": "PENDING"}


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:postgresql://db/x", 0, 900, partitions=9)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "9" and options["upperBound"] == "900"
    assert options["dbtable"] == "dlq_messages"


def test_backlog(spark):
    frame = spark.sql("SELECT 'a' topic, id % 3 partition, id div 3 + 10 offset FROM range(30)")
    assert metrics.topic_backlog(frame).first().backlog == 30
    holes = metrics.topic_backlog(frame.where("offset <> 12")).first()
    assert (holes.backlog, holes.messages) == (30, 27)
    queue = metrics.topic_backlog(frame.withColumns({"partition": F.lit(None).cast("int"), "offset": F.lit(None).cast("long")}))
    assert queue.first().backlog == 30


def test_observed_write(spark, tmp_path):
    summary = metrics.observed_write(spark.range(1234).toDF("x"), lambda f: f.write.parquet(f"{tmp_path}/o"))
    assert summary.records == 1234 and summary.per_second > 0


def test_scratch_is_below_the_shared_folder(spark):
    assert fresh_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_scoped_conf(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with scoped_conf(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_csv_reads_doubled_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"{""k"": ""v, w""}"\n2,"a\n""b"""\n')
    want = [(1, '{"k": "v, w"}'), (2, 'a\n"b"')]
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_path}/a.csv", multi_line=True).collect())) == want
    schema = spark.sql("SELECT '' AS v, 1 AS id").schema
    folded = files.fold_csv_to_parquet(spark, [f"{tmp_path}/a.csv"], f"{tmp_path}/out", schema, multi_line=True)
    assert sorted(map(tuple, folded.select("id", "v").collect())) == want
