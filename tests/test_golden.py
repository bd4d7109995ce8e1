from __future__ import annotations

import pytest
from golden import CASES, messages

from winnower.contract import COMPAT, STRICT
from winnower.contracts import TRIP, TRIP_RULES
from winnower.operators import retry
from winnower.operators.documents import document_violations


@pytest.fixture(scope="module")
def compat(spark):
    return {r.id: r for r in retry.split_messages(messages(spark), TRIP, TRIP_RULES, COMPAT, ["id"]).collect()}


@pytest.fixture(scope="module")
def strict(spark):
    return {r.id: r for r in retry.split_messages(messages(spark), TRIP, TRIP_RULES, STRICT, ["id"]).collect()}


@pytest.fixture(scope="module")
def retried(spark):
    return {r.id: r for r in retry.retry_messages(messages(spark), TRIP, TRIP_RULES, COMPAT, keep=["id"]).collect()}


def test_compat_branches(compat):
    assert {i: compat[i].branch for i, *_ in CASES} == {i: branch for i, _, branch, _, _ in CASES}


def test_strict_branches(strict):
    assert {i: strict[i].branch for i, *_ in CASES} == {i: branch for i, _, _, _, branch in CASES}


def test_retry_routes(retried):
    assert {i: retried[i].route for i, *_ in CASES} == {i: route for i, _, _, route, _ in CASES}


def test_values_after_cleaning(compat, strict, retried):
    assert compat["g02"].VendorID == 0 and compat["g04"].VendorID == 0
    assert compat["g09"].fare_amount == 12.0 and strict["g09"].fare_amount == 12.0
    assert compat["g20"].fare_amount == pytest.approx(1.234568, abs=1e-6)
    assert strict["g20"].fare_amount == 12345678.9
    assert compat["g27"].passenger_count == 0 and strict["g27"].passenger_count == 1
    assert strict["g28"].fare_amount == 12.0 and strict["g29"].total_amount == 17.05
    assert strict["g21"].fare_amount is None
    assert retried["g22"].retry_count == 4 and retried["g23"].retry_count == 3


def test_text_of_a_broken_message_is_kept(compat, strict):
    for split in (compat, strict):
        assert split["g17"].payload == "not json" and split["g17"].malformed
        assert split["g18"].payload == "" and split["g18"].malformed
        assert not split["g04"].malformed and not split["g29"].malformed


def test_errors_name_the_violated_rules(strict):
    assert strict["g19"].error == "fare_non_negative,rate_code_known"
    assert strict["g17"].error.startswith("malformed,pickup_present")
    assert strict["g01"].error == ""
    assert all((row.error == "") == (row.branch == "valid") for row in strict.values())


def test_contract_violations(spark):
    found = {}
    for row in document_violations(messages(spark), TRIP, ["id"]).collect():
        found.setdefault(row.id, set()).add(row.rule)
    assert found == {
        "g02": {"VendorID:required"},
        "g03": {"VendorID:minimum"},
        "g04": {"VendorID:type"},
        "g05": {"tpep_pickup_datetime:required"},
        "g06": {"passenger_count:minimum"},
        "g07": {"passenger_count:maximum"},
        "g08": {"passenger_count:required"},
        "g09": {"fare_amount:minimum"},
        "g10": {"fare_amount:required"},
        "g11": {"total_amount:minimum"},
        "g12": {"total_amount:required"},
        "g13": {"RateCodeID:enum"},
        "g15": {"store_and_fwd_flag:pattern"},
        "g17": {"not_an_object"},
        "g18": {"not_an_object"},
        "g19": {"fare_amount:required", "RateCodeID:enum"},
        "g21": {"not_an_object"},  # NaN is no JSON
        "g22": {"unknown_property"},
        "g23": {"unknown_property"},
        "g24": {"trip_distance:minimum"},
        "g25": {"tpep_pickup_datetime:format"},
        "g26": {"unknown_property"},
        "g28": {"fare_amount:type"},
        "g29": {"total_amount:type"},
        "g30": {"fare_amount:required", "unknown_property"},
    }
