"""Declared detection patterns (V1-V10) as DataFrame operators.

Each takes silver (or bronze) inputs and returns one row per hit.  Thresholds
are parameters; the defaults are the declared ones (``config``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave import config as C
from riskweave.functions import features as fx
from riskweave.operators import chunks
from riskweave.operators.first_seen import first_seen
from riskweave.operators.intervals import floor_div, interval_join, interval_micros, micros

_HOUR = 3_600_000_000


def locations(tx: DataFrame, logins: DataFrame) -> DataFrame:
    """Where a user was seen: (user_id, timestamp, event_id, city, latitude, longitude)."""
    place = ["user_id", "timestamp", "city", "latitude", "longitude"]
    return (tx.select(*place, F.col("transaction_id").alias("event_id"))
            .unionByName(logins.select(*place, F.col("login_id").alias("event_id"))))


def rapid_geo_hop(places: DataFrame, miles: float = C.GEO_HOP_MILES, within: str = C.GEO_HOP_WINDOW,
                  chunk: str = chunks.CHUNK) -> DataFrame:
    """V1: a user seen more than ``miles`` from the place before, at most ``within`` later."""
    p = chunks.with_previous(places, "user_id", "timestamp", "event_id",
                             ["event_id", "timestamp", "city", "latitude", "longitude"], chunk)
    far = fx.haversine_miles("previous.latitude", "previous.longitude", "latitude", "longitude")
    apart = micros("timestamp") - F.unix_micros(F.col("previous.timestamp"))
    return (p.where(apart <= interval_micros(within)).withColumn("miles", far).where(F.col("miles") > miles)
            .select("user_id", "event_id", "timestamp", "city", F.col("previous.event_id").alias("previous_event_id"),
                    F.col("previous.city").alias("previous_city"), "miles",
                    (apart / 1_000_000).alias("seconds_between")))


def velocity_spike(tx: DataFrame, factor: float = C.VELOCITY_FACTOR, window: str = C.VELOCITY_WINDOW,
                   min_count: int = C.VELOCITY_MIN_COUNT, chunk: str = chunks.CHUNK) -> DataFrame:
    """V2: more than ``factor`` times the user's own hourly rate (over the time
    from the user's first to last transaction, one hour at least) in ``window``."""
    t = tx.select("transaction_id", "user_id", "timestamp")
    recent = chunks.trailing(t, "user_id", "timestamp", window, {"recent_count": F.count("*")}, chunk)
    us = micros("timestamp")
    usual = (t.where("user_id IS NOT NULL AND timestamp IS NOT NULL").groupBy("user_id")
             .agg(F.count("*").alias("n"), F.greatest(F.max(us) - F.min(us), F.lit(_HOUR)).alias("span"))
             .select("user_id", (F.col("n") * F.lit(float(_HOUR)) / F.col("span")).alias("usual_per_hour")))
    hours = interval_micros(window) / _HOUR
    return (recent.where(F.col("recent_count") >= min_count).join(usual, "user_id")
            .where(F.col("recent_count") > F.lit(factor * hours) * F.col("usual_per_hour"))
            .select("transaction_id", "user_id", "timestamp", "recent_count", "usual_per_hour"))


def new_device_large(tx: DataFrame, amount: float = C.LARGE_AMOUNT) -> DataFrame:
    """V3: the first transaction of a user from a device, if it is a large one."""
    first = first_seen(tx.select("transaction_id", "user_id", "device_type", "timestamp", "amount"), ["user_id", "device_type"])
    return first.where(F.col("amount") > amount)


def midnight_atm(tx: DataFrame, hours: tuple[int, int] = C.MIDNIGHT_HOURS) -> DataFrame:
    """V4: cash from a foreign machine with the hour of day in ``[first, last)``."""
    hour = F.hour("timestamp")
    return (tx.where((F.col("transaction_type") == C.ATM_TYPE) & F.col("is_international")
                     & (hour >= hours[0]) & (hour < hours[1]))
            .select("transaction_id", "user_id", "timestamp", "amount", "city", "country"))


def round_amount_wire(tx: DataFrame, amount: float = C.LARGE_AMOUNT, multiple: int = C.ROUND_MULTIPLE) -> DataFrame:
    """V5: the first transaction of a user with a merchant (who stands for the
    recipient), if it is a wire of a round amount above ``amount``."""
    first = first_seen(tx.select("transaction_id", "user_id", "merchant_id", "timestamp", "amount", "transaction_type"),
                       ["user_id", "merchant_id"])
    return (first.where((F.col("transaction_type") == C.WIRE_TYPE) & (F.col("amount") > amount)
                        & (F.col("amount") % multiple == 0)).drop("transaction_type"))


def multiple_failed_mfa(logins: DataFrame, attempts: int = C.RAPID_FAIL_ATTEMPTS) -> DataFrame:
    """V6: a successful login after ``attempts`` failures or more."""
    return (logins.where(F.col("login_successful") & (F.col("failed_attempts_before_success") >= attempts))
            .select("login_id", "user_id", "timestamp", "failed_attempts_before_success"))


def cross_channel_rapid(tx: DataFrame, logins: DataFrame, within: str = C.CROSS_CHANNEL_WINDOW) -> DataFrame:
    """V7: a wire over the web at most ``within`` after a login from a mobile device."""
    wires = (tx.where((F.col("channel") == "web") & (F.col("transaction_type") == C.WIRE_TYPE))
             .select("transaction_id", "user_id", F.col("timestamp").alias("wire_timestamp"), "amount"))
    mobile = (logins.where(F.col("device_type").isin(*C.MOBILE_DEVICES))
              .select("user_id", "login_id", F.col("timestamp").alias("login_timestamp"), "device_type"))
    return interval_join(wires, mobile, "user_id", "wire_timestamp", "login_timestamp", upper=within, how="inner")


def dormant_reactivation(tx: DataFrame, days: float = C.DORMANT_DAYS, chunk: str = "30 days") -> DataFrame:
    """V8: a wire more than ``days`` days after the user's transaction before it."""
    t = tx.select("transaction_id", "user_id", "timestamp", "transaction_type", "amount")
    p = chunks.with_previous(t, "user_id", "timestamp", "transaction_id", ["transaction_id", "timestamp"], chunk)
    idle = micros("timestamp") - F.unix_micros(F.col("previous.timestamp"))
    return (p.where((F.col("transaction_type") == C.WIRE_TYPE) & (idle > int(days * 24 * _HOUR)))
            .select("transaction_id", "user_id", "timestamp", "amount",
                    F.col("previous.transaction_id").alias("previous_transaction_id"), (idle / (24 * _HOUR)).alias("idle_days")))


def credential_stuffing(logins: DataFrame, address: str = "ip_address", accounts: int = C.STUFFING_ACCOUNTS,
                        minutes: int = C.STUFFING_MINUTES) -> DataFrame:
    """V9: an address whose login attempts of the last ``minutes`` minutes (the
    current one included) were on ``accounts`` accounts or more; one row per
    address and minute with an attempt.

    A sliding distinct count without gathering an address: attempts are counted
    per (address, account, minute); each account is active from an attempt until
    ``minutes`` later or its next attempt, whichever comes first, so its active
    times do not overlap; starts and ends are summed per (address, minute), and a
    running sum over those rows counts the active accounts.  A hot address is
    split by account, then reduced to one row a minute.
    """
    a = (logins.where(F.col(address).isNotNull() & F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
         .select(F.col(address).alias("address"), "user_id", micros("timestamp").alias("us"))
         .withColumn("minute", floor_div("us", 60_000_000))
         .groupBy("address", "user_id", "minute").agg(F.count("*").alias("attempts")))
    after = F.lead("minute").over(Window.partitionBy("address", "user_id").orderBy("minute"))
    active = a.withColumn("until", F.least(F.col("minute") + minutes, after))
    steps = active.select("address", F.inline(F.array(
        F.struct(F.col("minute").alias("minute"), F.lit(1).alias("step"), F.col("attempts")),
        F.struct(F.col("until").alias("minute"), F.lit(-1).alias("step"), F.lit(0).cast("long").alias("attempts")))))
    timeline = steps.groupBy("address", "minute").agg(F.sum("step").alias("step"), F.sum("attempts").alias("attempts"))
    running = Window.partitionBy("address").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    recent = Window.partitionBy("address").orderBy("minute").rangeBetween(-(minutes - 1), 0)
    return (timeline.withColumns({"accounts": F.sum("step").over(running), "recent_attempts": F.sum("attempts").over(recent)})
            .where((F.col("attempts") > 0) & (F.col("accounts") >= accounts))
            .select("address", F.timestamp_micros(F.col("minute") * 60_000_000).alias("minute"), "accounts", "recent_attempts"))


def card_testing(tx: DataFrame, below: float = C.CARD_TEST_BELOW, count: int = C.CARD_TEST_COUNT,
                 window: str = C.CARD_TEST_WINDOW, chunk: str = chunks.CHUNK) -> DataFrame:
    """V10: at least ``count`` transactions under ``below`` of one user in ``window``."""
    small = tx.where(F.col("amount") < below).select("transaction_id", "user_id", "timestamp", "amount")
    recent = chunks.trailing(small, "user_id", "timestamp", window,
                             {"recent_count": F.count("*"), "recent_amount": F.sum("amount")}, chunk)
    return recent.where(F.col("recent_count") >= count)
