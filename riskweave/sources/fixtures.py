"""Deterministic mapping of the shared ``events`` test table onto the
transaction / login / decision inputs (test specification in FIXTURES.md).

The mapping is a pure projection of each event: the 12-city and 15-merchant
lookups are literal arrays indexed by integer arithmetic, so the plan is a
single scan -> filter -> project stage with no join and no shuffle, and it
scales with the events table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the test mapping (index, city, country, lat, lon) and
# (index, merchant_id, merchant_name, merchant_category), in natural order.
# ---------------------------------------------------------------------------
CITIES = [
    (0, "New York", "US", 40.71, -74.01),
    (1, "Los Angeles", "US", 34.05, -118.24),
    (2, "Chicago", "US", 41.88, -87.63),
    (3, "Houston", "US", 29.76, -95.37),
    (4, "Miami", "US", 25.76, -80.19),
    (5, "London", "UK", 51.51, -0.13),
    (6, "Lagos", "NG", 6.52, 3.38),
    (7, "Moscow", "RU", 55.76, 37.62),
    (8, "Beijing", "CN", 39.90, 116.41),
    (9, "Sao Paulo", "BR", -23.55, -46.63),
    (10, "Mumbai", "IN", 19.08, 72.88),
    (11, "Dubai", "AE", 25.20, 55.27),
]
MERCHANTS = [
    (0, "MCH-001", "Amazon", "online_retail"),
    (1, "MCH-002", "Walmart", "retail"),
    (2, "MCH-003", "Shell Gas", "fuel"),
    (3, "MCH-004", "Starbucks", "food"),
    (4, "MCH-005", "Wire Transfer Intl", "wire"),
    (5, "MCH-006", "Zelle P2P", "p2p"),
    (6, "MCH-007", "Venmo", "p2p"),
    (7, "MCH-008", "ACH Payroll", "ach"),
    (8, "MCH-009", "Luxury Watches Co", "luxury"),
    (9, "MCH-010", "Crypto Exchange X", "crypto"),
    (10, "MCH-011", "Foreign ATM", "atm"),
    (11, "MCH-012", "Online Casino", "gambling"),
    (12, "MCH-013", "Travel Agency", "travel"),
    (13, "MCH-014", "Electronics Depot", "retail"),
    (14, "MCH-015", "Offshore Holdings LLC", "wire"),
]
TX_TYPES = ["purchase", "wire_transfer", "p2p", "ach", "atm_withdrawal", "refund"]
CHANNELS = ["mobile_app", "web", "atm", "branch", "api"]
DEVICES = ["mobile_ios", "mobile_android", "desktop_chrome", "desktop_firefox", "tablet", "unknown"]
MFA_METHODS = ["sms", "authenticator_app", "email", "hardware_key"]
USER_AGENTS = ["Mozilla/5.0 (Windows NT 10.0)", "Mozilla/5.0 (Macintosh)",
               "Mozilla/5.0 (Linux)", "Mozilla/5.0 (iPhone)"]
DECISION_VALUES = ["APPROVE", "RELEASE", "ESCALATE", "BLOCK_CONFIRMED", "MAYBE"]
TX_EVENT_TYPES = ("purchase", "view", "click")
LOGIN_EVENT_TYPES = ("signup", "error")

# Fixed clock of the triage fixtures.
FIXTURE_NOW = "2024-01-31 00:00:00"


def fixture_now() -> Column:
    return F.lit(FIXTURE_NOW).cast("timestamp")


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "\\'") + "'"
    return repr(v)


def _pick(values: list, idx: str) -> str:
    """SQL text of values[idx] for a 0-based integer expression."""
    return f"element_at(array({', '.join(_sql_lit(v) for v in values)}), CAST(({idx}) + 1 AS INT))"


def _table_lookup(rows: list, names: list[str], idx: str) -> str:
    """SQL text of a struct picked from a literal table by a 0-based index."""
    structs = ", ".join("named_struct(" + ", ".join(f"'{n}', {_sql_lit(v)}" for n, v in zip(names, r)) + ")"
                        for r in rows)
    return f"element_at(array({structs}), CAST(({idx}) + 1 AS INT))"


_CITY_NAMES = ["ci", "city", "country", "lat", "lon"]
_MERCH_NAMES = ["mi", "merchant_id", "merchant_name", "merchant_category"]


def events_base(events: DataFrame) -> DataFrame:
    """Fold five users into one and pull the integer ``k`` out of props."""
    return events.selectExpr(
        "event_id", "CAST((user_id - user_id % 5) / 5 AS BIGINT) AS user_id", "ts", "event_type", "value",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k")


def transactions_from_events(events: DataFrame) -> DataFrame:
    e = events_base(events).where(f"event_type IN {TX_EVENT_TYPES}")
    risky = "(k >= 80 OR user_id % 10 = 1)"
    e = e.selectExpr(
        "*", f"{risky} AS risky",
        _table_lookup(CITIES, _CITY_NAMES, f"CASE WHEN {risky} THEN event_id % 12 ELSE user_id % 5 END") + " AS c",
        _table_lookup(MERCHANTS, _MERCH_NAMES, f"CASE WHEN {risky} THEN 4 + event_id % 11 ELSE event_id % 8 END") + " AS m")
    return e.selectExpr(
        "concat('TXN-', lpad(CAST(event_id AS STRING), 12, '0')) AS transaction_id",
        "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat('USR-', lpad(CAST(user_id AS STRING), 6, '0')) END AS user_id",
        "concat('4000-1234-5678-', lpad(CAST((user_id * 7919) % 10000 AS STRING), 4, '0')) AS card_number",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "CASE WHEN event_id % 97 = 0 THEN -round(value * 100) ELSE round(value * 100) END AS amount",
        "'USD' AS currency", "m.merchant_id", "m.merchant_name", "m.merchant_category",
        _pick(TX_TYPES, "event_id % 6") + " AS transaction_type",
        _pick(CHANNELS, "event_id % 5") + " AS channel",
        "c.city", "c.country", "CAST(c.lat AS DOUBLE) AS latitude", "CAST(c.lon AS DOUBLE) AS longitude",
        _pick(DEVICES, "event_id % 6") + " AS device_type",
        "c.country <> 'US' AS is_international",
        "risky AND event_id % 3 = 0 AS is_flagged")


def logins_from_events(events: DataFrame) -> DataFrame:
    e = events_base(events).where(f"event_type IN {LOGIN_EVENT_TYPES}")
    risky = "(k >= 70 OR user_id % 10 = 1)"
    e = e.selectExpr(
        "*", f"{risky} AS risky",
        _table_lookup(CITIES, _CITY_NAMES, f"CASE WHEN {risky} THEN 5 + event_id % 7 ELSE user_id % 5 END") + " AS c")
    return e.selectExpr(
        "concat('LOG-', lpad(CAST(event_id AS STRING), 12, '0')) AS login_id",
        "concat('USR-', lpad(CAST(user_id AS STRING), 6, '0')) AS user_id",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "concat(CAST(10 + c.ci AS STRING), '.', CAST(1 + event_id % 254 AS STRING), '.', "
        "CAST(1 + user_id % 254 AS STRING), '.', CAST(1 + k AS STRING)) AS ip_address",
        "c.city", "c.country", "CAST(c.lat AS DOUBLE) AS latitude", "CAST(c.lon AS DOUBLE) AS longitude",
        _pick(DEVICES, "event_id % 6") + " AS device_type",
        _pick(USER_AGENTS, "event_id % 4") + " AS user_agent",
        "event_type = 'signup' AS login_successful",
        "CAST(CASE WHEN event_type = 'error' THEN k % 6 ELSE 0 END AS INT) AS failed_attempts_before_success",
        "k % 4 = 0 AS mfa_change_flag",
        _pick(MFA_METHODS, "event_id % 4") + " AS mfa_method",
        "CAST(20 + (event_id * 7 + k) % 160 AS DOUBLE) AS typing_speed_ms",
        "CASE WHEN event_type = 'signup' THEN CAST(1 + event_id % 120 AS DOUBLE) ELSE 0.0 END AS session_duration_min",
        "risky AS is_suspicious")


def decisions_from_events(events: DataFrame) -> DataFrame:
    return events.where("event_id % 3 = 0").selectExpr(
        "concat('TXN-', lpad(CAST(event_id AS STRING), 12, '0')) AS transaction_id",
        "concat('analyst_', CAST(event_id % 4 AS STRING)) AS analyst_id",
        _pick(DECISION_VALUES, "event_id % 5") + " AS decision",
        "CASE WHEN event_id % 5 = 2 THEN 'needs second look' END AS notes",
        "CAST(ts AS TIMESTAMP) + INTERVAL 30 MINUTES AS decided_at")


# Declared patterns and their severities, in catalogue order.
PATTERNS = [
    ("rapid_geo_hop", "high"), ("velocity_spike", "high"), ("mfa_then_wire", "critical"),
    ("new_device_large_tx", "medium"), ("midnight_atm", "high"), ("round_amount_wire", "high"),
    ("bot_typing", "critical"), ("multiple_failed_mfa", "high"), ("ip_tor_exit", "critical"),
    ("account_drain", "critical"), ("sim_swap_pattern", "high"), ("cross_channel_rapid", "high"),
    ("dormant_reactivation", "medium"), ("credential_stuffing", "critical"), ("card_testing", "medium"),
]


def signatures(spark: SparkSession, rows: int = 200) -> DataFrame:
    """A catalogue of ``rows`` signatures that go through the patterns in turn."""
    n = len(PATTERNS)
    pick = lambda k: F.expr(_pick([p[k] for p in PATTERNS], f"id % {n}"))
    return spark.range(rows).select(
        F.format_string("SIG-%04d", F.col("id") + 1).alias("signature_id"), pick(0).alias("pattern_name"),
        pick(1).alias("severity"), ((F.col("id") % 7 + 1) / 100).alias("false_positive_rate"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = read_events(spark, sf_dir)
    return {
        "transactions": transactions_from_events(ev),
        "login_logs": logins_from_events(ev),
        "decisions": decisions_from_events(ev),
    }
