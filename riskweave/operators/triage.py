"""Review queue ("triage") as DataFrames: flagged extract, defaults, keyed
upsert, first-wins analyst decisions, queue / review pages and statistics,
and the per-login session table.

Key-based changes (upsert, decisions, explanation updates) are equi joins on
``transaction_id``: both sides shuffle on the key, with no broadcast of a side
that grows with the data.  The result is a new table version; a snapshot
writer (``sources.writers.snapshot_write``) swaps it in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import config as C
from riskweave.functions import features as fx
from riskweave.sources.schemas import TRIAGE, TRIAGE_COLUMNS


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


# ---------------------------------------------------------------------------
# Extract (gold pairs -> triage layout)
# ---------------------------------------------------------------------------

def factors_object(df: DataFrame | None = None) -> Column:
    """JSON object of four signals when any of three fires, else ``{}``.
    NULL signals are left out of the object (``to_json`` drops NULL fields)."""
    fire = F.col("mfa_then_wire") | F.col("geo_mismatch") | F.col("is_bot_typing")
    obj = F.to_json(F.struct(F.col("geo_mismatch").alias("geo_mismatch"),
                             F.col("mfa_then_wire").alias("mfa_then_wire"),
                             F.col("is_bot_typing").alias("bot_detected"),
                             F.col("is_off_hours").alias("off_hours")))
    return F.when(fire, obj).otherwise(F.lit("{}"))


def factors_object_min() -> Column:
    """One-key form: ``{"geo_mismatch": true}`` when the city differs, else ``{}``."""
    return F.when(F.col("geo_mismatch"), F.lit('{"geo_mismatch": true}')).otherwise(F.lit("{}"))


def blank_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL -> empty string on text columns."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in cols})


def to_triage(risk: DataFrame, factors: str = "object", created_at: Column | None = None,
              real_merchant_name: bool = False, limit: int | None = None) -> DataFrame:
    """Flagged pairs in the triage layout.  Score capped to 0-100 and level upper
    case (the queue's constraints); text blanks and boolean defaults as the sync
    jobs write them.  ``merchant_name`` carries the category unless
    ``real_merchant_name`` (the extract copies category into name).  ``limit``
    caps one sync batch; it is taken in a fixed order (highest score first) so
    repeated batches are reproducible."""
    fac = factors_object() if factors == "object" else factors_object_min()
    merchant = F.col("merchant_name") if real_merchant_name else F.col("merchant_category")
    out = risk.filter(fx.is_flagged_action()).select(
        "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"),
        F.lit(C.DEFAULT_CURRENCY).alias("currency"), "transaction_type",
        merchant.alias("merchant_name"), F.col("tx_channel").alias("channel"),
        F.least(F.col("risk_score"), F.lit(C.SCORE_CAP)).cast("int").alias("risk_score"),
        F.upper("risk_level").alias("risk_level"), "automated_action",
        fac.alias("triggered_factors"), F.lit("").alias("explanation"),
        "tx_city", "tx_country", "login_city", "login_country",
        F.coalesce("geo_mismatch", F.lit(False)).alias("geo_mismatch"),
        F.coalesce("mfa_change_flag", F.lit(False)).alias("mfa_changed"),
        F.coalesce("is_bot_typing", F.lit(False)).alias("bot_detected"),
        (created_at if created_at is not None else F.lit(None).cast("timestamp")).alias("created_at"),
    )
    out = blank_nulls(out, ["merchant_name", "channel", "tx_city", "tx_country",
                            "login_city", "login_country"])
    if limit is not None:
        out = out.orderBy(F.desc("risk_score"), "transaction_id").limit(int(limit))
    return out


def with_triage_defaults(df: DataFrame, now=None, ttl: str = C.TRIAGE_TTL) -> DataFrame:
    """Fill the table defaults and complete the triage column set."""
    present = set(df.columns)
    df = df.withColumn("__now", _now(now))
    defaults = {"currency": f"'{C.DEFAULT_CURRENCY}'", "triggered_factors": "'[]'", "geo_mismatch": "false",
                "mfa_changed": "false", "bot_detected": "false", "created_at": "__now", "updated_at": "__now"}
    exprs = []
    for f in TRIAGE.fields:
        v = f"CAST(`{f.name}` AS {f.dataType.simpleString()})" if f.name in present else \
            f"CAST(NULL AS {f.dataType.simpleString()})"
        if f.name in defaults:
            v = f"coalesce({v}, {defaults[f.name]})"
        exprs.append(f"{v} AS `{f.name}`")
    out = df.selectExpr(*exprs)
    return out.withColumn("expires_at", F.coalesce(
        "expires_at", F.col("created_at") + F.expr(f"INTERVAL {ttl}")))


def empty_triage(spark) -> DataFrame:
    return spark.createDataFrame([], TRIAGE)


# ---------------------------------------------------------------------------
# Keyed upsert
# ---------------------------------------------------------------------------

TRIAGE_UPDATE_COLS = ("risk_score", "risk_level", "automated_action", "triggered_factors")
#: Columns that describe the login pair a row was scored from.
TRIAGE_PAIR_COLS = TRIAGE_UPDATE_COLS + ("tx_city", "tx_country", "login_city", "login_country", "geo_mismatch",
                                         "mfa_changed", "bot_detected")


def upsert(target: DataFrame | None, source: DataFrame, key: str = "transaction_id",
           update_cols=TRIAGE_UPDATE_COLS, now=None, ttl: str = C.TRIAGE_TTL,
           only_if_higher: bool = False) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols, updated_at = now.

    New keys are inserted with the table defaults; on a match only
    ``update_cols`` and ``updated_at`` change, so creation time, expiry,
    explanation and analyst fields survive.  ``source`` must hold each key at
    most once (dedupe with ``gold.dedupe_per_transaction`` first).  With no
    target (first load) the rows are inserted without a join.
    ``only_if_higher``: a match updates only when the new score is strictly
    higher (used by the streaming sink, where a transaction's login pairs can
    arrive in different micro-batches).  The row then takes every column of the
    new pair (``TRIAGE_PAIR_COLS``), so it equals the row of one batch holding
    all pairs; an explanation of the old pair is cleared, and so asked for
    again, unless an analyst has already decided on it.  Pairs of equal score
    keep the one that came first.
    """
    n = _now(now)
    src = with_triage_defaults(source, n, ttl)
    if target is None:
        return src
    t = target.selectExpr(*[f"`{c}` AS `t__{c}`" for c in TRIAGE_COLUMNS], "true AS __t")
    s = src.selectExpr(*[f"`{c}` AS `s__{c}`" for c in TRIAGE_COLUMNS], "true AS __s")
    j = t.join(s, F.col(f"t__{key}") == F.col(f"s__{key}"), "full").withColumn("__now", n)
    both = "__t IS NOT NULL AND __s IS NOT NULL"
    if only_if_higher:
        both += " AND `s__risk_score` > `t__risk_score`"
        update_cols = tuple(update_cols) + TRIAGE_PAIR_COLS
    exprs = []
    for c in TRIAGE_COLUMNS:
        if c == key:
            e = f"coalesce(`t__{c}`, `s__{c}`)"
        elif c in update_cols:
            e = f"CASE WHEN {both} THEN `s__{c}` WHEN __t IS NOT NULL THEN `t__{c}` ELSE `s__{c}` END"
        elif c == "explanation" and only_if_higher:
            e = (f"CASE WHEN {both} AND t__analyst_decision IS NULL THEN `s__{c}` "
                 f"WHEN __t IS NOT NULL THEN `t__{c}` ELSE `s__{c}` END")
        elif c == "updated_at":
            e = f"CASE WHEN {both} THEN __now WHEN __t IS NOT NULL THEN `t__{c}` ELSE `s__{c}` END"
        else:
            e = f"CASE WHEN __t IS NOT NULL THEN `t__{c}` ELSE `s__{c}` END"
        exprs.append(f"{e} AS `{c}`")
    return j.selectExpr(*exprs)


# ---------------------------------------------------------------------------
# Analyst decisions (first writer wins)
# ---------------------------------------------------------------------------

_DECISION_ORDER = ("decided_at", "analyst_id", "decision", "notes")


def _is_valid_decision() -> Column:
    return F.coalesce(F.col("decision").isin(*C.DECISIONS), F.lit(False))


def _decision_rows(decisions: DataFrame) -> DataFrame:
    """Id and ordering fields of decisions; a missing time or note column is NULL."""
    def field(name: str, kind: str) -> Column:
        return (F.col(name) if name in decisions.columns else F.lit(None).cast(kind)).alias(name)
    return decisions.select("transaction_id", field("decided_at", "timestamp"), "analyst_id", "decision",
                            field("notes", "string"))


def first_decisions(decisions: DataFrame) -> DataFrame:
    """Valid decisions, the first per transaction (by decision time, analyst, value, notes)."""
    first = F.min(F.struct(*_DECISION_ORDER)).alias("__d")
    return _decision_rows(decisions).filter(_is_valid_decision()).groupBy("transaction_id").agg(first) \
        .select("transaction_id", "__d.*")


def apply_decisions(triage: DataFrame, decisions: DataFrame, now=None) -> DataFrame:
    """Set analyst fields where the row is still undecided.  ``reviewed_at`` is
    the decision time when the decisions carry one, else ``now``."""
    n = _now(now)
    d = first_decisions(decisions).select(
        F.col("transaction_id").alias("d__id"), F.col("analyst_id").alias("d__analyst"),
        F.col("decision").alias("d__decision"), F.col("notes").alias("d__notes"),
        F.col("decided_at").alias("d__at"))
    j = triage.join(d, F.col("transaction_id") == F.col("d__id"), "left")
    hit = F.col("d__id").isNotNull() & F.col("analyst_decision").isNull()
    return j.withColumns({
        "analyst_id": F.when(hit, F.col("d__analyst")).otherwise(F.col("analyst_id")),
        "analyst_decision": F.when(hit, F.col("d__decision")).otherwise(F.col("analyst_decision")),
        "analyst_notes": F.when(hit, F.col("d__notes")).otherwise(F.col("analyst_notes")),
        "reviewed_at": F.when(hit, F.coalesce(F.col("d__at"), n)).otherwise(F.col("reviewed_at")),
        "updated_at": F.when(hit, n).otherwise(F.col("updated_at")),
    }).select(*triage.columns)


def decision_outcome(triage: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per submitted decision: ``invalid`` / ``not_found`` / ``already_reviewed`` /
    ``superseded`` (a later decision, or the same one again, for an id decided
    in the same batch) / ``applied``, with the row's previous automated action
    when applied.  Identical decisions are counted before they are joined and
    expanded again after it, and only the first of them can be applied."""
    same = _decision_rows(decisions).groupBy("transaction_id", *_DECISION_ORDER).agg(F.count("*").alias("d__n"))
    first = first_decisions(decisions).select(F.col("transaction_id").alias("f__id"),
                                              F.struct(*_DECISION_ORDER).alias("f__d"))
    t = triage.select(F.col("transaction_id").alias("t__id"), F.col("automated_action").alias("t__action"),
                      F.col("analyst_decision").alias("t__decision"))
    d = same.join(t, F.col("transaction_id") == F.col("t__id"), "left") \
            .join(first, F.col("transaction_id") == F.col("f__id"), "left") \
            .withColumn("d__turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("d__n"))))
    is_first = F.struct(*_DECISION_ORDER).eqNullSafe(F.col("f__d")) & (F.col("d__turn") == 1)
    status = (F.when(~_is_valid_decision(), "invalid").when(F.col("t__id").isNull(), "not_found")
               .when(F.col("t__decision").isNotNull(), "already_reviewed")
               .when(~is_first, "superseded").otherwise("applied"))
    return d.select("transaction_id", "analyst_id", "decision", status.alias("status"),
                    F.when(status == "applied", F.col("t__action")).alias("previous_action"))


# ---------------------------------------------------------------------------
# Queue views
# ---------------------------------------------------------------------------

def age_seconds(now=None, col: str = "created_at") -> Column:
    return (F.unix_micros(_now(now)) - F.unix_micros(F.col(col))) / F.lit(1e6)


def expire(triage: DataFrame, now=None) -> DataFrame:
    """Rows still inside their lifetime (expired rows stay in the table)."""
    return triage.filter(F.col("expires_at") > _now(now))


def pending(triage: DataFrame, now=None) -> DataFrame:
    return expire(triage, now).filter(F.col("analyst_decision").isNull() & fx.is_flagged_action())


_QUEUE_VIEW_COLS = ["transaction_id", "user_id", "amount", "transaction_type", "merchant_name",
                    "risk_score", "risk_level", "automated_action", "triggered_factors", "explanation",
                    "tx_city", "tx_country", "geo_mismatch", "mfa_changed", "bot_detected", "created_at"]


def fraud_queue(triage: DataFrame, now=None) -> DataFrame:
    """The active queue: pending rows, highest score first, oldest first."""
    return pending(triage, now).select(*_QUEUE_VIEW_COLS, age_seconds(now).alias("age_seconds")) \
        .orderBy(F.desc("risk_score"), F.asc("created_at"), F.asc("transaction_id"))


_PAGE_COLS = ["transaction_id", "user_id", "amount", "currency", "transaction_type", "merchant_name",
              "channel", "risk_score", "risk_level", "automated_action", "triggered_factors",
              "explanation", "tx_city", "tx_country", "login_city", "login_country", "geo_mismatch",
              "mfa_changed", "bot_detected"]


def _page(df: DataFrame, limit: int, offset: int) -> DataFrame:
    """``limit`` rows after ``offset``; a limit outside 0..PAGE_MAX is an error,
    never a silently shorter page."""
    limit, offset = int(limit), int(offset)
    if not 0 <= limit <= C.PAGE_MAX:
        raise ValueError(f"limit must lie between 0 and {C.PAGE_MAX}, not {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, not {offset}")
    if offset:
        df = df.offset(offset)
    return df.limit(limit)


# Sort keys of the two pages: (column, descending).  Spark's default null
# order applies: ascending puts NULLs first, descending puts them last.
QUEUE_ORDER = [("risk_score", True), ("created_at", False), ("transaction_id", False)]
REVIEWED_ORDER = [("reviewed_at", True), ("transaction_id", False)]


def _sort_cols(order) -> list[Column]:
    return [F.desc(c) if d else F.asc(c) for c, d in order]


def rows_after(order, cursor) -> Column:
    """Rows strictly after ``cursor`` (the sort-key values of the last row
    seen) in the order ``order``.  Keyset paging: a page is a filter plus a
    bounded top-``limit``, however deep it is, where ``offset`` would have to
    merge every earlier row in one task first."""
    if len(cursor) != len(order):
        raise ValueError(f"cursor needs {len(order)} values")
    after = F.lit(False)
    for (c, desc), v in reversed(list(zip(order, cursor))):
        x = F.col(c)
        if v is None:
            gt = F.lit(False) if desc else x.isNotNull()
            eq = x.isNull()
        else:
            lit = F.lit(v)
            gt = (x < lit) | x.isNull() if desc else x > lit
            eq = x == lit
        after = gt | (eq & after)
    return after


def page_cursor(row, order=QUEUE_ORDER) -> tuple:
    """Cursor of a collected page row (pass the last row of a page)."""
    return tuple(row[c] for c, _ in order)


def queue_page(triage: DataFrame, now=None, action: str | None = None, risk_level: str | None = None,
               limit: int = C.PAGE_DEFAULT, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page of the queue, optionally filtered by action and level.
    ``after``: keyset cursor (``page_cursor`` of the previous page's last row)."""
    df = pending(triage, now)
    if action:
        df = df.filter(F.col("automated_action") == action)
    if risk_level:
        df = df.filter(F.col("risk_level") == risk_level.upper())
    if after is not None:
        df = df.filter(rows_after(QUEUE_ORDER, after))
    secs = age_seconds(now)
    df = df.select(*_PAGE_COLS, "created_at", F.round(secs / 60.0, 1).alias("age_minutes")) \
           .orderBy(*_sort_cols(QUEUE_ORDER))
    return _page(df, limit, offset)


def queue_stats(triage: DataFrame, now=None) -> DataFrame:
    """Single row; zeros (not NULLs) when the queue is empty."""
    p = pending(triage, now)
    return p.agg(
        F.count("*").alias("total_pending"),
        F.count_if(F.col("automated_action") == "YELLOW_FLAG").alias("yellow_flagged"),
        F.count_if(F.col("automated_action") == "BLOCK").alias("blocked"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(F.max(age_seconds(now)) / 60.0, F.lit(0.0)).alias("oldest_age_minutes"),
    )


def queue_size(triage: DataFrame, now=None) -> DataFrame:
    return pending(triage, now).agg(F.count("*").alias("queue_size"))


def reviewed(triage: DataFrame, decision: str | None = None) -> DataFrame:
    df = triage.filter(F.col("analyst_decision").isNotNull())
    if decision:
        df = df.filter(F.col("analyst_decision") == decision)
    return df


def review_seconds() -> Column:
    return (F.unix_micros("reviewed_at") - F.unix_micros("created_at")) / F.lit(1e6)


def reviewed_page(triage: DataFrame, decision: str | None = None, limit: int = C.PAGE_DEFAULT,
                  offset: int = 0, after: tuple | None = None) -> DataFrame:
    """Most recently reviewed first; ``after`` as in ``queue_page`` (REVIEWED_ORDER)."""
    df = reviewed(triage, decision)
    if after is not None:
        df = df.filter(rows_after(REVIEWED_ORDER, after))
    df = df.select(
        *_PAGE_COLS, "analyst_id", "analyst_decision", "analyst_notes", "created_at", "reviewed_at",
        F.coalesce(F.round(review_seconds() / 60.0, 1), F.lit(0.0)).alias("review_time_minutes")) \
        .orderBy(*_sort_cols(REVIEWED_ORDER))
    return _page(df, limit, offset)


def review_summary(triage: DataFrame) -> DataFrame:
    d = F.col("analyst_decision")
    return reviewed(triage).agg(
        F.count("*").alias("total_reviewed"),
        F.count_if(d == "RELEASE").alias("released"),
        F.count_if(d == "BLOCK_CONFIRMED").alias("confirmed"),
        F.count_if(d == "ESCALATE").alias("escalated"))


def analyst_metrics(triage: DataFrame) -> DataFrame:
    d = F.col("analyst_decision")
    return reviewed(triage).groupBy("analyst_id").agg(
        F.count("*").alias("total_reviewed"),
        F.count_if(d == "RELEASE").alias("released"),
        F.count_if(d == "BLOCK_CONFIRMED").alias("confirmed_blocks"),
        F.count_if(d == "ESCALATE").alias("escalated"),
        F.avg(review_seconds()).alias("avg_review_time_seconds"))


def triage_summary(triage: DataFrame) -> DataFrame:
    return triage.groupBy("automated_action").agg(
        F.count("*").alias("cnt"), F.round(F.avg("risk_score"), 0).alias("avg_score"))


def transaction_detail(triage: DataFrame, ids) -> DataFrame:
    """Full rows for the given id(s): a string, a list, or a DataFrame with a
    ``transaction_id`` column (left-semi join; one id pushes down to Parquet)."""
    if isinstance(ids, str):
        return triage.filter(F.col("transaction_id") == ids)
    if isinstance(ids, (list, tuple, set)):
        return triage.filter(F.col("transaction_id").isin(*ids))
    return triage.join(ids.select("transaction_id").distinct(), "transaction_id", "left_semi")


def missing_explanation(triage: DataFrame) -> DataFrame:
    return triage.filter(F.col("explanation").isNull() | (F.col("explanation") == ""))


def explanation_coverage(triage: DataFrame) -> DataFrame:
    has = F.col("explanation").isNotNull() & (F.col("explanation") != "")
    return triage.agg(F.count_if(has).alias("with_explanation"))


def explanation_preview(triage: DataFrame, n: int = 60) -> DataFrame:
    has = F.col("explanation").isNotNull() & (F.col("explanation") != "")
    return triage.filter(has).select("transaction_id", F.left("explanation", F.lit(n)).alias("explanation_preview"))


def apply_explanations(triage: DataFrame, expl: DataFrame) -> DataFrame:
    """Set ``explanation`` and ``triggered_factors`` by id (rows without a new
    text keep theirs).  Of several texts for one id the first in text order is
    taken, so a queue row is never multiplied."""
    texts = F.struct("explanation", "triggered_factors")
    expl = expl.groupBy("transaction_id").agg(F.min(texts).alias("e")).select("transaction_id", "e.*")
    e = expl.select(F.col("transaction_id").alias("e__id"), F.col("explanation").alias("e__text"),
                    F.col("triggered_factors").alias("e__factors"))
    j = triage.join(e, F.col("transaction_id") == F.col("e__id"), "left")
    hit = F.col("e__id").isNotNull()
    return j.withColumns({
        "explanation": F.when(hit, F.col("e__text")).otherwise(F.col("explanation")),
        "triggered_factors": F.when(hit, F.col("e__factors")).otherwise(F.col("triggered_factors")),
    }).select(*triage.columns)


# ---------------------------------------------------------------------------
# Factor JSON (list or object form) -> array<string>
# ---------------------------------------------------------------------------

def parse_factors(c: Column | str = "triggered_factors") -> Column:
    """Names of the fired factors.  List form ``["a", "b"]`` keeps its order;
    object form ``{"a": true, "b": false}`` keeps keys whose value is true;
    empty, NULL or malformed text gives an empty array."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.trim(col)
    as_list = F.from_json(text, "array<string>")
    as_map = F.from_json(text, "map<string,boolean>")
    from_map = F.map_keys(F.map_filter(as_map, lambda k, v: F.coalesce(v, F.lit(False))))
    empty = F.array().cast("array<string>")
    return (F.when(text.startswith("["), F.coalesce(as_list, empty))
             .when(text.startswith("{"), F.coalesce(from_map, empty))
             .otherwise(empty))


# ---------------------------------------------------------------------------
# Session table
# ---------------------------------------------------------------------------

def session_table(bronze_logins: DataFrame, risk: DataFrame, now=None) -> DataFrame:
    """One row per login: hashed IP, place, device, typing, MFA, bot flag and
    the highest pair score the login took part in (0 when none).  Coordinates
    and typing speed carry the serving table's scale (4 and 1 decimals) as
    doubles; a JDBC sink casts them to its DECIMAL columns.  The score is
    reduced per login before the join, so only one row per login shuffles."""
    from riskweave.operators.silver import silver_login_logs
    logins = silver_login_logs(bronze_logins.withColumn("__ip", F.col("ip_address")))
    best = risk.filter(F.col("login_id").isNotNull()).groupBy("login_id") \
               .agg(F.max("risk_score").alias("__score"))
    j = logins.join(best, "login_id", "left")
    return j.select(
        F.col("login_id").alias("session_id"), "user_id", F.col("timestamp").alias("login_timestamp"),
        fx.hash_ip("__ip").alias("ip_address_hash"), "city", "country",
        F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"),
        "device_type", F.round("typing_speed_ms", 1).alias("typing_speed_ms"),
        F.coalesce("mfa_change_flag", F.lit(False)).alias("mfa_change_flag"),
        F.coalesce("is_bot_typing", F.lit(False)).alias("is_bot_typing"),
        F.coalesce("__score", F.lit(0)).cast("int").alias("risk_score"),
        _now(now).alias("created_at"))
