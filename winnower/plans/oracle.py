"""Plain SQL for the registered queries, for an engine that sees the same tables."""

from __future__ import annotations

from winnower.contracts import FAULT_FIELDS, TRIP

TRIPS = """
SELECT event_id,
 CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 131 = 0 THEN -1 ELSE CAST(user_id % 2 + 1 AS INT) END AS VendorID,
 CASE WHEN event_id % 211 = 0 THEN NULL ELSE ts END AS tpep_pickup_datetime,
 CASE WHEN event_id % 223 = 0 THEN NULL ELSE ts + INTERVAL '15' MINUTE END AS tpep_dropoff_datetime,
 CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN CAST(-1 - event_id % 6 AS INT)
      ELSE CAST(event_id % 7 AS INT) END AS passenger_count,
 CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 113 = 0 THEN CAST(-value AS FLOAT)
      ELSE CAST(value / 10 AS FLOAT) END AS trip_distance,
 CAST(CASE WHEN event_id % 179 = 0 THEN 181.5 WHEN event_id % 181 = 0 THEN -200 ELSE -73.9 END AS FLOAT) AS pickup_longitude,
 CAST(CASE WHEN event_id % 191 = 0 THEN 90.5 ELSE 40.7 END AS FLOAT) AS pickup_latitude,
 CASE WHEN event_id % 127 = 0 THEN NULL WHEN event_id % 137 = 0 THEN 99
      ELSE CAST(event_id % 6 + 1 AS INT) END AS RateCodeID,
 CASE WHEN event_id % 139 = 0 THEN NULL WHEN event_id % 149 = 0 THEN 'X' WHEN event_id % 50 = 1 THEN 'Y'
      ELSE 'N' END AS store_and_fwd_flag,
 CAST(CASE WHEN event_id % 193 = 0 THEN -180.5 WHEN event_id % 197 = 0 THEN NULL ELSE -73.8 END AS FLOAT) AS dropoff_longitude,
 CAST(CASE WHEN event_id % 199 = 0 THEN -91 ELSE 40.8 END AS FLOAT) AS dropoff_latitude,
 CASE WHEN event_id % 151 = 0 THEN NULL ELSE CAST(user_id % 6 + 1 AS INT) END AS payment_type,
 CASE WHEN event_id % 157 = 0 THEN NULL WHEN event_id % 163 = 0 THEN CAST(-value AS FLOAT)
      ELSE CAST(value AS FLOAT) END AS fare_amount,
 CAST(0.5 AS FLOAT) AS extra, CAST(0.5 AS FLOAT) AS mta_tax,
 CASE WHEN event_id % 227 = 0 THEN CAST(-0.5 AS FLOAT) WHEN event_id % 229 = 0 THEN NULL ELSE CAST(value / 5 AS FLOAT) END AS tip_amount,
 CAST(CASE WHEN event_id % 233 = 0 THEN -2 ELSE 0 END AS FLOAT) AS tolls_amount, CAST(0.3 AS FLOAT) AS improvement_surcharge,
 CASE WHEN event_id % 167 = 0 THEN NULL WHEN event_id % 173 = 0 THEN CAST(-value AS FLOAT)
      ELSE CAST(value + 1.3 AS FLOAT) END AS total_amount,
 CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 5 AS INT) ELSE NULL END AS retry_count
FROM events"""

CLEAN_TRIPS = """
SELECT event_id,
 CAST(user_id % 2 + 1 AS INT) AS VendorID,
 CAST(event_id % 7 AS INT) AS passenger_count,
 CAST(value / 10 AS FLOAT) AS trip_distance,
 CAST(value AS FLOAT) AS fare_amount,
 CAST(value + 1.3 AS FLOAT) AS total_amount,
 CAST(user_id % 6 + 1 AS INT) AS payment_type
FROM events"""

FLOATS = [f.name for f in TRIP.fields if f.kind == "float"]
INTS = [f.name for f in TRIP.fields if f.kind == "int"]
MOMENTS = [f.name for f in TRIP.fields if f.kind == "timestamp"]


def _fixed(source: str, retry: str = "retry_count") -> str:
    """Corrected fields of a source of trips."""
    parts = ["event_id"]
    for f in TRIP.fields:
        if f.kind == "int":
            parts.append(f"COALESCE({f.name}, 0) AS {f.name}")
        elif f.name == "fare_amount":
            parts.append("ABS(fare_amount) AS fare_amount")
        else:
            parts.append(f.name)
    return f"SELECT {', '.join(parts)}, {retry} AS retry_count FROM {source}"


# What must hold for a corrected trip, by name.
HOLDS = {
    "vendor_present": "VendorID IS NOT NULL",
    "pickup_present": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_present": "tpep_dropoff_datetime IS NOT NULL",
    "passenger_range": "passenger_count BETWEEN 0 AND 9",
    "fare_non_negative": "fare_amount >= 0",
    "total_non_negative": "total_amount >= 0",
    "rate_code_known": "RateCodeID IN (1, 2, 3, 4, 5, 6)",
    "flag_known": "store_and_fwd_flag IN ('Y', 'N')",
}
OK = "(" + " AND ".join(HOLDS.values()) + ")"
STRICT_OK = f"COALESCE({OK}, FALSE)"
OK_BUT_RATE_CODE = "COALESCE(" + " AND ".join(v for k, v in HOLDS.items() if k != "rate_code_known") + ", FALSE)"
BRANCH = f"CASE WHEN {OK} THEN 'valid' WHEN NOT {OK} THEN 'dead' ELSE 'undetermined' END"
STRICT_BRANCH = f"CASE WHEN {STRICT_OK} THEN 'valid' ELSE 'dead' END"
BROKEN = ", ".join(f"CASE WHEN NOT COALESCE({v}, FALSE) THEN '{k}' END" for k, v in HOLDS.items())
ERROR = f"CONCAT_WS(',', CASE WHEN malformed THEN 'malformed' END, {BROKEN})"
# A retry that sets a usual rate code, on its first three attempts, in what is a document.
REPAIRED_OK = f"(NOT malformed AND {OK_BUT_RATE_CODE})"
_BROKEN_BUT_RATE_CODE = ", ".join(
    f"CASE WHEN NOT COALESCE({v}, FALSE) THEN '{k}' END" for k, v in HOLDS.items() if k != "rate_code_known"
)
REPAIRED_ERROR = (
    f"CASE WHEN malformed OR COALESCE(retry_count, 0) + 1 > 3 THEN {ERROR} ELSE CONCAT_WS(',', {_BROKEN_BUT_RATE_CODE}) END"
)

# Messages: trips of which every 97th is no document and so has no field at all.
MESSAGES = (
    "SELECT event_id, event_id % 97 = 0 AS malformed, "
    + ", ".join(f"CASE WHEN event_id % 97 <> 0 THEN {n} END AS {n}" for n in [*TRIP.names, "retry_count"])
    + " FROM trips"
)
WITH = f"""WITH trips AS ({TRIPS}),
fixed AS ({_fixed('trips')}),
msgs AS ({MESSAGES}),
mfixed AS (SELECT m.malformed, f.* FROM ({_fixed('msgs')}) f JOIN msgs m USING (event_id))
"""
IDENTITY = "sha256('trips|' || (event_id % 3) || '|' || (event_id // 3))"
ENVELOPE = "'trips' AS topic, CAST(event_id % 3 AS INT) AS partition, event_id // 3 AS \"offset\""


def _moment(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"


def _cents(name: str) -> str:
    return f"CAST(SUM(CAST(ROUND(CAST({name} AS DOUBLE) * 100) AS BIGINT)) AS DOUBLE) / 100"


def _row(number: str = "CAST({n} AS DOUBLE)") -> str:
    parts = ["event_id"]
    for f in TRIP.fields:
        if f.kind == "float":
            parts.append(f"{number.format(n=f.name)} AS {f.name}")
        elif f.kind == "timestamp":
            parts.append(f"{_moment(f.name)} AS {f.name}")
        else:
            parts.append(f.name)
    return ", ".join([*parts, "retry_count"])


ROW = _row()
COUNTED = f"SELECT * REPLACE (COALESCE(retry_count, 0) + 1 AS retry_count) FROM fixed"
MCOUNTED = f"SELECT * REPLACE (COALESCE(retry_count, 0) + 1 AS retry_count) FROM mfixed"


def _listed(keys: str, conditions: dict[str, str], source: str) -> str:
    """One row per violated condition."""
    cases = ", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in conditions.items())
    return f"SELECT * FROM (SELECT {keys}, UNNEST([{cases}]) AS rule FROM {source}) WHERE rule IS NOT NULL"


LINEITEM_BROKEN = {
    "l_orderkey:required": "l_orderkey IS NULL",
    "l_orderkey:minimum": "l_orderkey < 1",
    "l_partkey:required": "l_partkey IS NULL",
    "l_suppkey:required": "l_suppkey IS NULL",
    "l_linenumber:required": "l_linenumber IS NULL",
    "l_linenumber:minimum": "l_linenumber < 1",
    "l_linenumber:maximum": "l_linenumber > 7",
    "l_quantity:required": "l_quantity IS NULL",
    "l_quantity:minimum": "l_quantity < 1",
    "l_quantity:maximum": "l_quantity > 45",
    "l_extendedprice:required": "l_extendedprice IS NULL",
    "l_extendedprice:minimum": "l_extendedprice < 0",
    "l_discount:minimum": "l_discount < 0",
    "l_discount:maximum": "l_discount > 0.08::DOUBLE",
    "l_tax:minimum": "l_tax < 0",
    "l_returnflag:enum": "l_returnflag NOT IN ('A', 'N', 'R')",
    "l_returnflag:length": "length(l_returnflag) > 1",
    "l_linestatus:pattern": "NOT regexp_matches(l_linestatus, '^[FO]$')",
    "l_shipdate:required": "l_shipdate IS NULL",
}

# Violations of a document whose values have their own types, and of one that holds text only.
_REQUIRED = {f"{n}:required": f"{n} IS NULL" for n in TRIP.required}
DOCUMENT_BROKEN = {
    "VendorID:minimum": "VendorID < 1",
    "passenger_count:minimum": "passenger_count < 0",
    "passenger_count:maximum": "passenger_count > 9",
    "trip_distance:minimum": "trip_distance < 0",
    "pickup_longitude:minimum": "pickup_longitude < -180",
    "pickup_longitude:maximum": "pickup_longitude > 180",
    "pickup_latitude:maximum": "pickup_latitude > 90",
    "dropoff_longitude:minimum": "dropoff_longitude < -180",
    "dropoff_latitude:minimum": "dropoff_latitude < -90",
    "RateCodeID:enum": "RateCodeID NOT IN (1, 2, 3, 4, 5, 6)",
    "store_and_fwd_flag:pattern": "store_and_fwd_flag NOT IN ('Y', 'N')",
    "payment_type:enum": "payment_type NOT IN (1, 2, 3, 4, 5, 6)",
    "fare_amount:minimum": "fare_amount < 0",
    "tip_amount:minimum": "tip_amount < 0",
    "tolls_amount:minimum": "tolls_amount < 0",
    "tpep_pickup_datetime:format": "event_id % 61 = 0 AND tpep_pickup_datetime IS NOT NULL",
    "total_amount:minimum": "total_amount < 0",
    **_REQUIRED,
    "unknown_property": "retry_count IS NOT NULL",
}
TEXT_DOCUMENT_BROKEN = {
    **{f"{n}:type": f"{n} IS NOT NULL" for n in [*FLOATS, *INTS]},
    "RateCodeID:enum": "RateCodeID IS NOT NULL",
    "payment_type:enum": "payment_type IS NOT NULL",
    "store_and_fwd_flag:pattern": "store_and_fwd_flag NOT IN ('Y', 'N')",
    **_REQUIRED,
}


def _fault(rate: float) -> str:
    hit = f"CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS UBIGINT) % 10000 < {round(rate * 10000)}"
    choice = "CAST('0x' || substr(md5('42|' || event_id), 9, 8) AS UBIGINT) % 12"
    names = "[" + ", ".join(f"'{f}'" for f in FAULT_FIELDS) + "]"
    return (
        f"{hit} AS fault_hit, CASE WHEN {choice} < 6 THEN 'missing_field' ELSE 'invalid_value' END AS fault_kind, "
        f"{names}[CAST({choice} % 6 AS INT) + 1] AS fault_field"
    )


def _struck(name: str, kind: str) -> str:
    return f"fault_hit AND fault_kind = '{kind}' AND fault_field = '{name}'"


def _faulty(name: str) -> str:
    return (
        f"CASE WHEN {_struck(name, 'missing_field')} THEN NULL "
        f"WHEN {_struck(name, 'invalid_value')} THEN -ABS({name}) ELSE {name} END AS {name}"
    )


FAULTY = ", ".join(_faulty(n) for n in FAULT_FIELDS)
FAULT_OUT = ", ".join(
    f"CAST({n} AS DOUBLE) AS {n}" if n in FLOATS else n for n in FAULT_FIELDS
)
FAULT_DOCUMENT = ", ".join(
    f"ROUND(CAST({_faulty(n).rsplit(' AS ', 1)[0]} AS DOUBLE), 4) AS {n}, "
    f"CASE WHEN {n} IS NULL AND {_struck(n, 'invalid_value')} THEN 'invalid_value' END AS {n}_text"
    for n in FAULT_FIELDS
)

_TEXT = (
    "CASE event_id % 6 WHEN 0 THEN '$' || CAST(value AS VARCHAR) WHEN 1 THEN CAST(value AS VARCHAR) || ' usd' "
    "WHEN 2 THEN '1,' || CAST(value AS VARCHAR) WHEN 3 THEN 'n/a' "
    "WHEN 4 THEN '-' || CAST(value AS VARCHAR) || '.1' ELSE CAST(value AS VARCHAR) END"
)
_STRIPPED = "regexp_replace(text, '[^0-9.-]', '', 'g')"
_NUMBER = f"COALESCE(TRY_CAST(text AS DOUBLE), TRY_CAST({_STRIPPED} AS DOUBLE))"

_DLQ_MESSAGE = f"{IDENTITY} AS message_id, {ENVELOPE}"
_DEAD_LETTERS = f"{WITH} SELECT {{columns}} FROM mfixed JOIN events USING (event_id) WHERE NOT {STRICT_OK}"

ORACLE: dict[str, str] = {
    "trip_branch_counts": f"""{WITH} SELECT {BRANCH} AS branch, COUNT(*) AS rows, {_cents('fare_amount')} AS sum_fare
        FROM fixed GROUP BY 1""",
    "correct_numeric": f"{WITH} SELECT {ROW} FROM fixed",
    "clean_text_numbers": f"""WITH t AS (SELECT event_id, {_TEXT} AS text FROM events)
        SELECT event_id, text, {_NUMBER} AS number, CAST(TRUNC({_NUMBER}) AS INT) AS whole,
        CAST(TRY_CAST({_STRIPPED} AS FLOAT) AS DOUBLE) AS single FROM t""",
    "row_identity": f"SELECT event_id, {IDENTITY} AS message_id FROM events",
    "valid_rows": f"{WITH} SELECT {ROW} FROM fixed WHERE {OK}",
    "invalid_rows": f"{WITH} SELECT {ROW} FROM fixed WHERE NOT {OK}",
    "undetermined_rows": f"{WITH} SELECT {ROW} FROM fixed WHERE {OK} IS NULL",
    "invalid_rows_default": f"{WITH} SELECT {ROW} FROM fixed WHERE NOT {STRICT_OK}",
    "rule_violations": WITH + _listed(
        "event_id", {k: f"NOT COALESCE({v}, FALSE)" for k, v in HOLDS.items()}, "fixed"
    ),
    "rule_violations_compat": WITH + _listed("event_id", {k: f"NOT ({v})" for k, v in HOLDS.items()}, "fixed"),
    "rule_violation_summary": f"{WITH} " + " UNION ALL ".join(
        f"SELECT '{k}' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE({v}, FALSE)) AS violations FROM fixed"
        for k, v in HOLDS.items()
    ),
    "retryable_rows": f"""{WITH}, counted AS ({COUNTED})
        SELECT {ROW} FROM counted WHERE {OK} AND retry_count <= 3""",
    "terminal_rows": f"""{WITH}, counted AS ({COUNTED})
        SELECT {ROW} FROM counted WHERE NOT {OK} OR retry_count > 3""",
    "retry_routes": f"""{WITH}, counted AS ({COUNTED})
        SELECT CAST(n AS INT) AS max_retries,
        CASE WHEN {OK} AND retry_count <= n THEN 'retryable' WHEN NOT {OK} OR retry_count > n THEN 'terminal'
             ELSE 'lost' END AS route, COUNT(*) AS rows
        FROM counted, (VALUES (0), (1), (3)) AS limits(n) GROUP BY 1, 2""",
    "dlq_status": f"""{WITH}, counted AS ({MCOUNTED})
        SELECT event_id, {_DLQ_MESSAGE}, {_moment('ts')} AS timestamp, NULLIF({ERROR}, '') AS error, retry_count,
        CASE WHEN {STRICT_OK} AND retry_count <= 3 THEN 'PROCESSED' ELSE 'FAILED' END AS status
        FROM counted JOIN events USING (event_id)""",
    "json_roundtrip": f"{WITH} SELECT {_row('CAST(CAST({n} AS VARCHAR) AS DOUBLE)')} FROM fixed",
    "json_roundtrip_typed": f"{WITH} SELECT {ROW} FROM (SELECT * REPLACE (" + ", ".join(
        f"date_trunc('millisecond', {m}) AS {m}" for m in MOMENTS
    ) + ") FROM fixed)",
    "malformed_kept": f"""{WITH} SELECT event_id, CAST(malformed AS INT) AS malformed,
        CASE WHEN malformed THEN 'not json' END AS kept_text, {STRICT_BRANCH} AS branch, {ERROR} AS error
        FROM mfixed""",
    "dirty_document_branches": f"""{WITH}, dated AS (
          SELECT * REPLACE (CASE WHEN event_id % 59 = 0 OR event_id % 61 <> 0 THEN tpep_pickup_datetime END AS tpep_pickup_datetime)
          FROM mfixed), typed AS (
          SELECT * REPLACE (CASE WHEN event_id % 59 <> 0 THEN ABS(fare_amount) END AS fare_amount,
            CASE WHEN event_id % 59 <> 0 THEN total_amount END AS total_amount,
            CASE WHEN event_id % 59 <> 0 THEN passenger_count ELSE 0 END AS passenger_count,
            CASE WHEN event_id % 59 <> 0 THEN RateCodeID ELSE 0 END AS RateCodeID) FROM dated)
        SELECT 'text' AS parse, {STRICT_BRANCH} AS branch, COUNT(*) AS rows, {_cents('fare_amount')} AS sum_fare
        FROM dated GROUP BY 1, 2
        UNION ALL
        SELECT 'typed', {BRANCH}, COUNT(*), {_cents('fare_amount')} FROM typed GROUP BY 1, 2""",
    "event_documents": f"""{WITH} SELECT '{{"index":{{}}}}' AS action, 'INFO' AS level, 'record accepted' AS message,
        'stream_processing' AS event, event_id, ROUND(CAST(fare_amount AS DOUBLE), 2) AS fare_amount, 1 AS stamped
        FROM fixed WHERE {OK}""",
    "contract_violations": f"""{WITH}
        SELECT event_id, 'not_an_object' AS rule FROM trips WHERE event_id % 97 = 0
        UNION ALL {_listed('event_id', TEXT_DOCUMENT_BROKEN,
                           'trips WHERE event_id % 97 <> 0 AND event_id % 59 = 0')}
        UNION ALL {_listed('event_id', DOCUMENT_BROKEN,
                           'trips WHERE event_id % 97 <> 0 AND event_id % 59 <> 0')}""",
    "contract_lineitem": _listed("l_orderkey, l_linenumber, l_partkey", LINEITEM_BROKEN, "lineitem"),
    "contract_lineitem_summary": " UNION ALL ".join(
        f"SELECT '{k}' AS rule, COUNT(*) FILTER (WHERE {v}) AS violations FROM lineitem"
        for k, v in LINEITEM_BROKEN.items()
    ),
    "unknown_keys": "SELECT event_id, UNNEST(json_keys(props)) AS property FROM events",
    "contract_in_force": f"""{WITH} SELECT event_id, '1.3.0' AS schema_version FROM trips
        WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-10 00:00:00'""",
    "contract_versions": """WITH e AS (SELECT *, CASE WHEN event_id % 41 <> 0 THEN ts END AS t FROM events), v AS (
          SELECT *, CASE WHEN t >= TIMESTAMP '2024-01-20' THEN '2.0.0' WHEN t >= TIMESTAMP '2024-01-12 06:30:00' THEN '1.1.0'
            WHEN t >= TIMESTAMP '2024-01-05' THEN '1.0.0' END AS schema_version FROM e)
        SELECT event_id, schema_version, CASE schema_version
          WHEN '1.0.0' THEN concat_ws(',', CASE WHEN user_id < 1 THEN 'user_id:minimum' END,
            CASE WHEN event_type NOT IN ('click', 'view', 'error', 'signup') THEN 'event_type:enum' END,
            CASE WHEN value > 150 THEN 'value:maximum' END)
          WHEN '1.1.0' THEN concat_ws(',', CASE WHEN event_type NOT IN ('click', 'view') THEN 'event_type:enum' END,
            CASE WHEN value > 50 THEN 'value:maximum' END)
          WHEN '2.0.0' THEN concat_ws(',', CASE WHEN user_id < 5 THEN 'user_id:minimum' END,
            CASE WHEN value < 20 THEN 'value:minimum' END) END AS error FROM v""",
    "contract_document_versions": """WITH d AS (SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-17 12:00:00' THEN '2'
            WHEN ts >= TIMESTAMP '2024-01-03' THEN '1' END AS schema_version,
          event_id % 13 <> 0 AND event_id % 17 = 0 AS odd,
          CASE WHEN event_id % 13 <> 0 AND event_id % 17 <> 0 THEN CAST(props ->> '$.k' AS INT) END AS k FROM events)
        SELECT event_id, schema_version, CASE WHEN schema_version IS NULL THEN NULL WHEN odd THEN 'not_an_object'
          WHEN schema_version = '1' THEN concat_ws(',', CASE WHEN k < 3 THEN 'k:minimum' END, CASE WHEN k > 80 THEN 'k:maximum' END)
          ELSE concat_ws(',', CASE WHEN k < 3 THEN 'k:minimum' END, CASE WHEN k > 50 THEN 'k:maximum' END,
            CASE WHEN k IS NULL THEN 'k:required' END, 'note:required') END AS error FROM d""",
    "table_constraints_processed": _listed("event_id", {
        "id:required": "event_id % 199 = 0",
        "message_id:required": "event_id % 211 = 0",
        "topic:required": "event_id % 31 = 0",
        "topic:length": "event_id % 31 <> 0 AND length(event_type) * user_id > 255",
        "partition:required": "event_id % 53 = 0",
        "offset:required": "event_id % 223 = 0",
    }, "events"),
    "table_constraints_failed": _listed("event_id AS id", {
        "topic:length": "length(event_type) * user_id > 255",
        "offset:required": "event_id % 227 = 0",
        "error:required": "event_id % 19 = 0",
        "retry_count:required": "event_id % 23 = 0",
    }, "events"),
    "table_constraints": _listed("event_id AS id", {
        "message_id:required": "event_id % 211 = 0",
        "topic:length": "length(event_type) * user_id > 255",
        "offset:required": "event_id % 223 = 0",
        "payload:required": "event_id % 97 = 0",
        "status:length": "length(event_type) * (user_id % 12) > 50",
    }, "events"),
    "inject_plan": f"""SELECT event_id, CAST(fault_hit AS INT) AS fault_hit, fault_kind, fault_field
        FROM (SELECT event_id, {_fault(0.01)} FROM events)""",
    "inject_apply": f"""SELECT event_id, {FAULT_OUT} FROM (
        SELECT event_id, {FAULTY} FROM (SELECT *, {_fault(0.01)} FROM ({CLEAN_TRIPS})))""",
    "inject_documents": f"SELECT event_id, {FAULT_DOCUMENT} FROM (SELECT *, {_fault(0.3)} FROM ({TRIPS}))",
    "inject_branch_counts": f"""SELECT fault_kind, fault_field,
        CASE WHEN fault_field = 'passenger_count' AND passenger_count < 0 THEN 'dead'
             WHEN fault_field = 'total_amount' AND total_amount < 0 THEN 'dead'
             WHEN fare_amount IS NULL OR total_amount IS NULL THEN 'undetermined' ELSE 'valid' END AS branch,
        COUNT(*) AS rows
        FROM (SELECT fault_hit, fault_kind, fault_field, {FAULTY} FROM (SELECT *, {_fault(0.5)} FROM ({CLEAN_TRIPS})))
        WHERE fault_hit GROUP BY 1, 2, 3""",
    "union_frames": """SELECT event_id, user_id, value FROM events WHERE event_type IN ('click', 'view', 'error')
        UNION ALL BY NAME SELECT event_id, value FROM events WHERE event_type NOT IN ('click', 'view', 'error')""",
    "topic_backlog": """SELECT topic, CAST(SUM(b) AS BIGINT) AS backlog, CAST(SUM(n) AS BIGINT) AS messages
        FROM (SELECT 'trips' AS topic, event_id % 3, MAX(event_id // 3) - MIN(event_id // 3) + 1 AS b, COUNT(*) AS n
              FROM events GROUP BY 1, 2) GROUP BY 1""",
    "partition_backlog": """SELECT 'trips' AS topic, CAST(event_id % 3 AS INT) AS partition,
        MAX(event_id // 3) - MIN(event_id // 3) + 1 AS backlog, COUNT(*) AS messages FROM events GROUP BY 1, 2""",
    "backlog_events": "SELECT 'trips' AS topic, COUNT(*) AS dlq_size, 1 AS stamped FROM events",
    "dedupe_messages": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedupe_first_delivery": f"""SELECT * REPLACE ({_moment('l_shipdate')} AS l_shipdate) FROM lineitem
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus) = 1""",
    "csv_backup_roundtrip": _DEAD_LETTERS.format(columns=f"""{_DLQ_MESSAGE}, {_moment('ts')} AS timestamp,
        {ERROR} AS error, COALESCE(retry_count, 0) AS retry_count, 'PENDING' AS status,
        ROUND(CAST(CASE WHEN malformed THEN NULL WHEN event_id % 157 = 0 THEN NULL
          WHEN event_id % 163 = 0 THEN -value ELSE value END AS DOUBLE), 2) AS fare"""),
    "csv_fold": f"""SELECT event_id, {_moment('ts')} AS ts, user_id, event_type, value, props,
        '"' || event_type || '", ""' || chr(10) || ',' || props || chr(10) AS note FROM events""",
    "csv_typed_scan": f"{WITH} SELECT " + ", ".join(
        f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}" if n in MOMENTS
        else f"CAST({n} AS DOUBLE) AS {n}" if n in FLOATS else n
        for n in TRIP.names
    ) + " FROM trips",
    "fallback_source": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "parquet_roundtrip": f"{WITH} SELECT {ROW} FROM trips",
    "raw_landing": f"""SELECT event_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS code,
        CASE WHEN event_id % 4 < 3 THEN event_type || chr(10) || '"' || props || '"' END AS note,
        CASE WHEN event_id % 4 < 3 THEN {_moment('ts')} END AS ts FROM events""",
    "raw_landing_bytes": """WITH days AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, props FROM events), contents AS (
          SELECT 'csv' AS format, day, encode('event_id,note' || chr(10) || string_agg(event_id || ',"' || replace(props, '"', '""')
            || '"' || chr(10), '' ORDER BY event_id)) AS bytes FROM days GROUP BY day
          UNION ALL SELECT DISTINCT 'txt', day, '\\xE9'::BLOB || encode(day) || '\\xE8\\xE0'::BLOB FROM days)
        SELECT format, day, octet_length(bytes) AS size, sha256(bytes) AS sha256, 1 AS same FROM contents""",
    "text_objects": "SELECT lang, CAST(SUM(length(text) + 1) AS BIGINT) AS characters FROM documents GROUP BY 1",
    "dlq_tables": _DEAD_LETTERS.format(columns=f"""{_DLQ_MESSAGE}, {_moment('ts')} AS timestamp, {ERROR} AS error,
        0 AS retry_count, 'PENDING' AS status, 1 AS stamped"""),
    "daily_log_counts": """SELECT CASE WHEN event_id % 41 = 0 THEN 'undated' ELSE strftime(ts, '%Y.%m.%d') END
        AS log_date, event_type AS level, COUNT(*) AS lines FROM events GROUP BY 1, 2""",
    "publish_messages": f"""{WITH} SELECT event_id, 'trips' AS topic, VendorID,
        {_moment('tpep_pickup_datetime')} AS tpep_pickup_datetime,
        CAST(CAST(total_amount AS VARCHAR) AS DOUBLE) AS total_amount FROM fixed""",
    "publish_summary": "SELECT COUNT(*) AS reported, COUNT(*) AS stored, 1 AS timed FROM events",
    "stream_split": f"""{WITH} SELECT event_id,
        CASE WHEN {STRICT_OK} THEN 'trips_events' ELSE 'trips_dlq' END AS topic,
        CASE WHEN {STRICT_OK} THEN ROUND(CAST(fare_amount AS DOUBLE), 2) END AS fare, {ERROR} AS error FROM mfixed""",
    "stream_split_compat": f"""{WITH} SELECT CASE WHEN {OK} THEN 'trips_events' ELSE 'trips_dlq' END AS topic,
        COUNT(*) AS rows FROM mfixed WHERE {OK} IS NOT NULL GROUP BY 1""",
    "stream_retry": f"""{WITH}, counted AS ({MCOUNTED})
        SELECT event_id, CASE WHEN {OK} AND retry_count <= 3 THEN 'trips' ELSE 'trips_failed' END AS topic, retry_count
        FROM counted WHERE ({OK} AND retry_count <= 3) OR NOT {OK} OR retry_count > 3""",
    "stream_retry_loop": f"""{WITH} SELECT event_id,
        CASE WHEN {STRICT_OK} THEN 'trips_events'
             WHEN NOT malformed AND {OK_BUT_RATE_CODE} AND COALESCE(retry_count, 0) + 1 <= 3 THEN 'trips_events'
             ELSE 'trips_failed' END AS topic FROM mfixed""",
    "dedupe_nulls_last": f"""SELECT user_id, {_moment('t')} AS ts, event_id
        FROM (SELECT user_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS t, event_id FROM events)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t NULLS LAST, event_id) = 1""",
    "publish_twice": "SELECT event_id, 'trips' AS topic FROM events",
    "null_key_identity": "SELECT 2 * COUNT(*) AS messages, 2 * COUNT(*) AS ids, 0 AS nameless FROM events",
    "stream_new_checkpoint": f"""{WITH} SELECT event_id,
        CASE WHEN {STRICT_OK} THEN 'trips_events' ELSE 'trips_dlq' END AS topic FROM mfixed""",
    "stream_backlog": f"""{WITH} SELECT 'trips_dlq' AS topic, COUNT(*) AS backlog, COUNT(*) AS messages
        FROM mfixed WHERE NOT {STRICT_OK}""",
    "processed_table": f"{WITH} SELECT event_id, 'trips' AS topic, 1 AS filed FROM mfixed WHERE {STRICT_OK}",
    "failed_table": f"""{WITH}, tried AS (SELECT *, {REPAIRED_OK} AND COALESCE(retry_count, 0) + 1 <= 3 AS saved
          FROM mfixed WHERE NOT {STRICT_OK})
        SELECT event_id, {REPAIRED_ERROR} AS error,
        COALESCE(retry_count, 0) + 1 AS retry_count, 1 AS filed FROM tried WHERE NOT saved""",
    "status_transitions": f"""{WITH} SELECT event_id,
        CASE WHEN {REPAIRED_OK} AND COALESCE(retry_count, 0) + 1 <= 3 THEN 'PROCESSED' ELSE 'FAILED' END AS status,
        1 AS in_order FROM mfixed WHERE NOT {STRICT_OK}""",
    "status_compaction": f"""{WITH} SELECT event_id,
        CASE WHEN {REPAIRED_OK} AND COALESCE(retry_count, 0) + 1 <= 3 THEN 'PROCESSED' ELSE 'FAILED' END AS status,
        1 AS in_order FROM mfixed WHERE NOT {STRICT_OK}""",
    "stream_retry_attempts": f"""{WITH}, tried AS (SELECT *, COALESCE(retry_count, 0) + 1 AS attempt FROM mfixed
          WHERE NOT {STRICT_OK})
        SELECT event_id, CASE WHEN {REPAIRED_OK} AND attempt BETWEEN event_id % 3 + 1 AND 3 THEN 'trips'
          ELSE 'trips_failed' END AS topic, attempt FROM tried""",
    "stream_dedupe_replay": "SELECT event_id, user_id, value FROM events",
    "unique_across_batches": "SELECT DISTINCT event_id, user_id, value FROM events",
    "stream_late_rows": """SELECT event_id, CASE WHEN event_id % 7 <= 3 THEN 'in_time' ELSE 'late' END AS stored_in
        FROM events""",
    "stream_dedupe": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "binary_envelopes": f"""{WITH}, bytes AS (SELECT *, event_id % 7 = 0 OR event_id % 11 = 0 AS broken FROM mfixed)
        SELECT event_id, CAST(malformed OR broken AS INT) AS malformed, 1 AS same,
        CASE WHEN event_id % 7 = 0 THEN 'C3FF00' END AS first FROM bytes WHERE broken OR NOT {STRICT_OK}""",
    "stream_rate_limited": "SELECT 5 AS batches, COUNT(*) AS rows, 0 AS above_limit, COUNT(*) AS stored FROM events",
    "stream_from_timestamp": "SELECT event_id FROM events WHERE event_id % 2 = 1",
    "queue_retention": "SELECT event_id, 3 AS removed FROM events",
    "delivery_outcomes": "SELECT 1 AS queries, COUNT(*) FILTER (WHERE event_id % 10 = 3) AS refused FROM events",
    "stable_sample": """SELECT event_id, user_id FROM events
        WHERE CAST('0x' || substr(md5('4|' || user_id), 1, 8) AS UBIGINT) < 429496730""",
    "stream_branch_tables": f"""{WITH} SELECT {IDENTITY} AS message_id, 'trips' AS topic, event_id // 3 AS "offset",
        CASE WHEN {STRICT_OK} THEN 'processed' ELSE 'letters' END AS stored_in FROM mfixed""",
    "stream_event_log": f"""{WITH} SELECT COUNT(*) AS actions, COUNT(*) AS documents, COUNT(*) AS marked
        FROM mfixed WHERE {STRICT_OK}""",
    "stream_progress": f"""{WITH} SELECT COUNT(*) AS input_rows, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {OK}) AS valid,
        COUNT(*) FILTER (WHERE NOT {OK}) AS dead, COUNT(*) FILTER (WHERE {OK} IS NULL) AS undetermined FROM mfixed""",
}
