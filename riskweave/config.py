"""Thresholds, weights and vocabularies.

Fixed values: these must equal the documented fraud rules for results to
match, so they are stated here plainly and used everywhere else by name.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (rule thresholds, weights, vocabularies)
# ---------------------------------------------------------------------------

# Merchant categories treated as high risk.
HIGH_RISK_CATEGORIES = ("wire", "crypto", "gambling", "p2p")

# Amount buckets: < 100 low, < 1 000 medium, < 10 000 high, else very_high.
AMOUNT_BUCKETS = ((100, "low"), (1000, "medium"), (10000, "high"))
AMOUNT_BUCKET_TOP = "very_high"

HIGH_AMOUNT = 10000          # amount strictly above this is "high value"
BOT_TYPING_MS = 50           # typing speed strictly below this is bot-like
RAPID_FAIL_ATTEMPTS = 3      # failures at or above this are a rapid-fail burst
OFF_HOURS_BEFORE = 6         # hour < 6 is off hours
OFF_HOURS_AFTER = 22         # hour > 22 is off hours (22:00-22:59 is in hours)

# Gold (pipeline) score: eight additive terms, uncapped.
GOLD_WEIGHTS = {
    "high_amount": 25,
    "high_risk_merchant": 15,
    "geo_mismatch": 20,
    "mfa_then_wire": 30,
    "bot_typing": 25,
    "rapid_fail": 10,
    "off_hours": 5,
    "is_flagged": 20,
}

# Score -> level / action thresholds (score >= threshold).
LEVEL_THRESHOLDS = ((70, "critical"), (40, "high"), (20, "medium"))
LEVEL_BOTTOM = "low"
ACTION_THRESHOLDS = ((70, "BLOCK"), (40, "YELLOW_FLAG"), (20, "MONITOR"))
ACTION_BOTTOM = "ALLOW"

FLAGGED_ACTIONS = ("YELLOW_FLAG", "BLOCK")
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ACTIONS = ("ALLOW", "MONITOR", "YELLOW_FLAG", "BLOCK")
DECISIONS = ("APPROVE", "RELEASE", "ESCALATE", "BLOCK_CONFIRMED")

WIRE_TYPE = "wire_transfer"
SCORE_CAP = 100

# PII masks.
CARD_MASK_PREFIX = "****-****-****-"
IP_MASK_SUFFIX = ".xxx.xxx"

# Join windows and queue lifetime.
SESSION_WINDOW = "1 hour"
MFA_WIRE_WINDOW = "24 hours"
MFA_WIRE_MIN_AMOUNT = 10000
TRIAGE_TTL = "24 hours"
DEFAULT_CURRENCY = "USD"

# Queue paging.
PAGE_DEFAULT = 50
PAGE_MAX = 200

# BI thresholds.
CROSS_CHANNEL_MIN_AMOUNT = 5000
TOP_USERS_MIN_AVG_SCORE = 20
TOP_USERS_N = 20
CROSS_CHANNEL_N = 50
TRAVEL_N = 50

# Nine-factor scorer thresholds.
TRAVEL_MILES = 500
TRAVEL_MINUTES = 60
EARTH_RADIUS_MILES = 3958.8

# Declared detection patterns.
HOME_COUNTRY = "US"
ATM_TYPE = "atm_withdrawal"
MOBILE_DEVICES = ("mobile_ios", "mobile_android")
SEVERITIES = ("low", "medium", "high", "critical")
LARGE_AMOUNT = 10000
GEO_HOP_MILES = 500
GEO_HOP_WINDOW = "10 minutes"
VELOCITY_FACTOR = 5.0
VELOCITY_WINDOW = "1 hour"
VELOCITY_MIN_COUNT = 3
MIDNIGHT_HOURS = (1, 4)
ROUND_MULTIPLE = 1000
CROSS_CHANNEL_WINDOW = "5 minutes"
DORMANT_DAYS = 90
STUFFING_ACCOUNTS = 10
STUFFING_MINUTES = 60
CARD_TEST_BELOW = 1.0
CARD_TEST_COUNT = 3
CARD_TEST_WINDOW = "10 minutes"
