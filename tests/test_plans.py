"""The plans are the ones wanted: narrow, in the JVM, reading only what they need."""

from __future__ import annotations

import re

import pytest

from winnower.contract import COMPAT, STRICT
from winnower.contracts import LINEITEM, TRIP, TRIP_RULES
from winnower.operators import dedupe, metrics, retry, validate
from winnower.operators.correct import correct
from winnower.operators.documents import document_violations
from winnower.plans.catalog import QUERIES
from winnower.plans.trips import envelopes, table, trips
from winnower.streaming import jobs


def plan(df, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NARROW = {
    "correct": lambda ev, p: correct(trips(ev), TRIP, p),
    "split": lambda ev, p: retry.split_messages(envelopes(ev), TRIP, TRIP_RULES, p),
    "retry": lambda ev, p: retry.retry_messages(envelopes(ev), TRIP, TRIP_RULES, p),
    "outbound": lambda ev, p: jobs.first_pass_outbound(
        retry.split_messages(envelopes(ev), TRIP, TRIP_RULES, p), TRIP, jobs.TopicNames(), p
    ),
    "documents": lambda ev, p: document_violations(envelopes(ev), TRIP, ["event_id"]),
}


@pytest.mark.parametrize("policy", [STRICT, COMPAT])
@pytest.mark.parametrize("name", sorted(NARROW))
def test_row_work_needs_no_shuffle_and_no_python(spark, data, name, policy):
    text = physical(NARROW[name](table(spark, data, "events"), policy))
    assert "Exchange" not in text
    assert not re.search(r"Python|ArrowEval|BatchEval|MapInPandas", text)


@pytest.mark.parametrize("policy", [STRICT, COMPAT])
def test_each_message_is_parsed_once(spark, data, tmp_path, policy):
    envelopes(table(spark, data, "events")).write.parquet(f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m")
    split = retry.split_messages(stored, TRIP, TRIP_RULES, policy)
    for frame in (jobs.first_pass_outbound(split, TRIP, jobs.TopicNames(), policy), retry.dead_letter_rows(split)):
        # The strict policy has a second parser, which runs only for records that did not fit.
        assert physical(frame).count("from_json(") == (1 if policy is COMPAT else 2)


def test_only_needed_columns_are_read(spark, data):
    summary = validate.violation_summary(table(spark, data, "lineitem"), LINEITEM.row_rules()[:2])
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan(summary)
    branches = QUERIES["trip_branch_counts"](spark, data)
    assert "props" not in plan(branches)


def test_filters_reach_the_scan_below_the_identity(spark, data):
    from winnower.operators.correct import with_identity

    lines = with_identity(table(spark, data, "lineitem"), "l_orderkey", "l_linenumber").where("l_quantity > 49")
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in plan(lines)


def test_aggregates_reduce_before_the_shuffle(spark, data):
    for frame in (
        metrics.partition_backlog(envelopes(table(spark, data, "events"))),
        dedupe.first_per_key(table(spark, data, "lineitem"), ["l_orderkey"], ["l_shipdate"]),
        dedupe.distinct_keys(table(spark, data, "lineitem"), ["l_orderkey"]),
    ):
        text = physical(frame)
        assert text.count("Exchange") == 1
        assert "partial_" in text or text.count("HashAggregate") == 2 or text.count("WindowGroupLimit") == 2


ROW_QUERIES = (
    "correct_numeric", "valid_rows", "invalid_rows", "undetermined_rows", "invalid_rows_default", "retryable_rows",
    "terminal_rows", "rule_violations", "json_roundtrip", "malformed_kept", "contract_violations", "contract_lineitem",
    "event_documents", "inject_apply", "unknown_keys", "contract_in_force",
)


@pytest.mark.parametrize("name", ROW_QUERIES)
def test_registered_row_queries_move_nothing(spark, data, name):
    assert "Exchange" not in physical(QUERIES[name](spark, data))


def test_no_query_joins_or_collects_groups():
    from pathlib import Path

    root = Path(validate.__file__).parents[1]
    # The optional operators on documents have tests of their own.
    source = "".join(p.read_text() for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm")
    for word in ("crossJoin", "localCheckpoint", "collect_list", ".toPandas(", "applyInPandas", ".collect("):
        assert word not in source, word
