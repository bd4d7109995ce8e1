from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnower.contract import STRICT, Contract, Field, Policy, Rule, contract_from_json_schema
from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, PROCESSED_TABLE, TRIP
from winnower.operators import validate, versions
from winnower.operators.documents import document_violations

SCHEMA = {
    "meta": {"schema_version": "2.0", "valid_from": "2024-06-01T00:00:00Z"},
    "schema": {
        "type": "object",
        "properties": {
            "id": {"type": "integer", "minimum": 1},
            "when": {"type": "string", "format": "date-time"},
            "share": {"type": "number", "minimum": 0, "maximum": 1},
            "size": {"type": "string", "enum": ["S", "M"]},
            "code": {"type": "string", "pattern": "^[A-Z]{2}$", "maxLength": 2},
        },
        "required": ["id"],
        "additionalProperties": False,
    },
}


def test_reading_a_json_schema():
    contract = contract_from_json_schema("order", SCHEMA)
    assert contract.names == ["id", "when", "share", "size", "code"]
    assert contract.required == ["id"] and contract.closed
    assert (contract.version, contract.valid_from) == ("2.0", "2024-06-01T00:00:00Z")
    assert [f.kind for f in contract.fields] == ["int", "timestamp", "double", "string", "string"]
    assert contract.struct().simpleString() == "struct<id:int,when:timestamp,share:double,size:string,code:string>"


@pytest.mark.parametrize(("text", "expected"), [
    ('{"id": 1}', set()),
    ('{"id": 1, "when": "2024-01-01T10:00:00Z", "share": 0.5, "size": "M", "code": "AB"}', set()),
    ('{"id": 1.0}', set()),
    ('{"id": 1.5}', {"id:type"}),
    ('{"id": "1"}', {"id:type"}),
    ('{"id": true}', {"id:type"}),
    ('{"id": null}', {"id:type"}),
    ('{}', {"id:required"}),
    ('{"id": 0}', {"id:minimum"}),
    ('{"id": 1, "share": 1.1}', {"share:maximum"}),
    ('{"id": 1, "when": "tomorrow"}', {"when:format"}),
    ('{"id": 1, "when": 20240101}', {"when:type"}),
    ('{"id": 1, "size": "L"}', {"size:enum"}),
    ('{"id": 1, "size": 3}', {"size:type", "size:enum"}),
    ('{"id": 1, "code": "ab"}', {"code:pattern"}),
    ('{"id": 1, "code": "ABC"}', {"code:pattern", "code:length"}),
    ('{"ID": 1}', {"id:required", "unknown_property"}),
    ('[1]', {"not_an_object"}),
    ('"id"', {"not_an_object"}),
    ('{"id": 1', {"not_an_object"}),
    (None, {"not_an_object"}),
])
def test_documents(spark, text, expected):
    contract = contract_from_json_schema("order", SCHEMA)
    frame = spark.createDataFrame([(1, text)], "k int, value string")
    assert {r.rule for r in document_violations(frame, contract, ["k"]).collect()} == expected


def test_a_field_named_twice_is_refused():
    with pytest.raises(ValueError, match="twice"):
        Contract("x", (Field("a", "int"), Field("a", "string")))


def test_unknown_test_is_refused():
    with pytest.raises(ValueError, match="unknown test"):
        Rule("r", "c", "no_such_test").outcome(F)


def test_optional_fields_may_be_null(spark):
    contract = Contract("t", (Field("a", "int", minimum=0), Field("b", "string", required=True, max_length=2)))
    frame = spark.createDataFrame([(1, None, "x"), (2, -1, None), (3, 5, "abc")], "k int, a int, b string")
    found = validate.rule_violations(frame, contract.row_rules(), ["k"], Policy(three_valued=True)).collect()
    assert {(r.k, r.rule) for r in found} == {(2, "a:minimum"), (2, "b:required"), (3, "b:length")}


def test_violations_are_empty_exactly_for_valid_rows(spark, data):
    from winnower.contracts import TRIP_RULES
    from winnower.operators.correct import correct
    from winnower.plans.trips import table, trips

    judged = validate.judge(correct(trips(table(spark, data, "events")), TRIP), TRIP_RULES)
    broken = validate.rule_violations(judged, TRIP_RULES, ["event_id"], STRICT).select("event_id").distinct()
    dead = validate.dead_rows(judged).select("event_id")
    assert broken.exceptAll(dead).count() == 0 and dead.exceptAll(broken).count() == 0


def test_in_force(spark):
    contract = contract_from_json_schema("order", SCHEMA)
    frame = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-05-31 23:59:59'), (2, timestamp'2024-06-01'), (3, NULL) t(k, at)")
    assert [(r.k, r.schema_version) for r in validate.in_force(frame, contract, "at").collect()] == [(2, "2.0")]


def test_table_contracts_have_the_columns_of_the_tables():
    assert len(DEAD_LETTER_TABLE.names) == 12 and len(PROCESSED_TABLE.names) == 6 and len(FAILED_TABLE.names) == 8
    assert len(TRIP.names) == 19 and len(TRIP.required) == 6


def test_unknown_keywords_are_refused():
    import pytest

    from winnower.contract import contract_from_json_schema

    def schema(**more):
        return {"schema": {"type": "object", "properties": {"a": {"type": "integer", **more}}}}

    assert contract_from_json_schema("c", schema(minimum=1, description="n")).names == ["a"]
    for keyword in ("exclusiveMinimum", "const", "minLength"):
        with pytest.raises(ValueError, match=keyword):
            contract_from_json_schema("c", schema(**{keyword: 1}))
    with pytest.raises(ValueError, match="format"):
        contract_from_json_schema("c", {"schema": {"properties": {"a": {"type": "string", "format": "email"}}}})
    with pytest.raises(ValueError, match="patternProperties"):
        contract_from_json_schema("c", {"schema": {"properties": {}, "patternProperties": {}}})


def test_a_moment_has_a_date_and_a_time(spark):
    from winnower.functions.cleaning import whole_moment

    good = ["2015-01-15 19:05:39", "2015-01-15T19:05:39.123456Z", "2015-01-15 19:05", "2015-01-15T19:05:39+02:00"]
    bad = ["10:00", "2015", "2015-01-15", "bad", "2015-13-15 19:05:39", "", None]
    frame = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = [r.m is not None for r in frame.select(whole_moment(frame.t).alias("m")).collect()]
    assert got == [True] * len(good) + [False] * len(bad)


def test_versions_judge_rows_and_documents_alike(spark):
    def contract(version, since, **limits):
        return Contract("c", (Field("n", "int", required=True, **limits),), version=version, valid_from=since)

    chosen = [contract("2", "2024-01-10T00:00:00Z", minimum=5), contract("1", "2024-01-05T00:00:00Z", maximum=3)]
    rows = [(1, "2024-01-04 23:59:59", 9), (2, "2024-01-05 00:00:00", 9), (3, "2024-01-10 00:00:00", 9), (4, "2024-02-01 00:00:00", 1), (5, None, 1), (6, "2024-01-06 00:00:00", None)]
    frame = spark.createDataFrame(rows, "id int, at string, n int").withColumn("at", F.col("at").cast("timestamp"))
    want = {1: (None, None), 2: ("1", "n:maximum"), 3: ("2", ""), 4: ("2", "n:minimum"), 5: (None, None), 6: ("1", "n:required")}
    got = versions.judge_rows(frame, chosen, "at").collect()
    assert {r.id: (r.schema_version, r.error) for r in got} == want
    documents = frame.select("id", "at", F.to_json(F.struct("n")).alias("value"))
    got = versions.judge_documents(documents, chosen, "at").collect()
    assert {r.id: (r.schema_version, r.error) for r in got} == want
    always = versions.judge_rows(frame, [contract("0", None), *chosen], "at").where("id IN (1, 5)").collect()
    assert {r.id: r.schema_version for r in always} == {1: "0", 5: None}
    with pytest.raises(ValueError, match="share"):
        versions.version_in_force([chosen[0], chosen[0]], "at")


def test_a_version_reads_its_own_days_only(spark, tmp_path):
    rows = spark.range(10).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("at"), F.lit('{"n": 1}').alias("value"))
    rows.write.parquet(f"{tmp_path}/d")
    chosen = [Contract("c", (Field("n", "int"),), version=str(k), valid_from=f"2024-01-0{k}T00:00:00Z") for k in (2, 5)]
    judged = versions.judge_documents(spark.read.schema(rows.schema).parquet(f"{tmp_path}/d"), chosen, "at")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LessThan(at,2024-01-05") == 1 and plan.count("GreaterThanOrEqual(at,2024-01-05") == 1
    assert judged.groupBy("schema_version").count().collect().__len__() == 3
