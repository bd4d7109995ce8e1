"""The tables' row constraints on topics that would not fit in memory if they were written out."""

from __future__ import annotations

from datetime import datetime

import pytest
from comparing import differences, oracle_connection

from winnower.plans.catalog import QUERIES
from winnower.plans.oracle import ORACLE

USERS = (0, 1, 42, 43, 51, 52, 63, 64, 127, 128, 255, 256, 1_500, 2_000_000_000, 2**40)
KINDS = ("", "x", "äé", "click", "signup", "k" * 255, "k" * 256)


@pytest.mark.parametrize("name", ["table_constraints", "table_constraints_failed", "table_constraints_processed"])
def test_users_of_any_number(spark, tmp_path, name):
    rows = [(user, kind) for user in USERS for kind in KINDS]
    events = [(n, datetime(2024, 1, 1), user, kind, 1.0, "{}") for n, (user, kind) in enumerate(rows, 1)]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).coalesce(1).write.parquet(f"{tmp_path}/all")
    next(tmp_path.glob("all/*.parquet")).rename(tmp_path / "events.parquet")
    assert differences(QUERIES[name](spark, str(tmp_path)), oracle_connection(str(tmp_path)), ORACLE[name]) == []
