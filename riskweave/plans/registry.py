"""Registered queries over the shared test tables.

``Inputs`` builds each layer lazily from ``events`` (mapped onto the
transaction / login / decision inputs); every query below is a pure
function of those layers, so its work grows with the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import bi, gold, kpis, silver
from riskweave.sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


class Inputs:
    """Lazily built layers for one (session, data directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.now = fixtures.fixture_now()
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def events(self) -> DataFrame:
        return self._get("events", lambda: fixtures.read_events(self.spark, self.sf_dir))

    @property
    def bronze_tx(self) -> DataFrame:
        return self._get("bronze_tx", lambda: fixtures.transactions_from_events(self.events)
                         .withColumn("ingestion_timestamp", self.now))

    @property
    def bronze_logins(self) -> DataFrame:
        return self._get("bronze_logins", lambda: fixtures.logins_from_events(self.events)
                         .withColumn("ingestion_timestamp", self.now))

    @property
    def decisions(self) -> DataFrame:
        return self._get("decisions", lambda: fixtures.decisions_from_events(self.events))

    @property
    def silver_tx(self) -> DataFrame:
        return self._get("silver_tx", lambda: silver.silver_transactions(self.bronze_tx))

    @property
    def silver_logins(self) -> DataFrame:
        return self._get("silver_logins", lambda: silver.silver_login_logs(self.bronze_logins))

    @property
    def risk(self) -> DataFrame:
        return self._get("risk", lambda: gold.session_risk(self.silver_tx, self.silver_logins))

    @property
    def wires(self) -> DataFrame:
        return self._get("wires", lambda: gold.wire_after_mfa(self.silver_tx, self.silver_logins))


_INPUTS: dict[tuple[int, str], Inputs] = {}


def inputs_for(spark: SparkSession, sf_dir: str) -> Inputs:
    """Layers are lazy and immutable, so one set per (session, directory) is
    shared by every query instead of rebuilding the same plans."""
    key = (id(spark), sf_dir)
    if key not in _INPUTS or _INPUTS[key].spark is not spark:
        _INPUTS[key] = Inputs(spark, sf_dir)
    return _INPUTS[key]


def _q(name: str, fn: Callable[[Inputs], DataFrame]):
    QUERIES[name] = lambda spark, sf_dir: fn(inputs_for(spark, sf_dir))


# --- BI reports -------------------------------------------------------------
_q("bi_risk_distribution", lambda i: bi.bi_risk_distribution(i.risk))


# --- Sources and silver -----------------------------------------------------
_q("bronze_transactions", lambda i: i.bronze_tx)
_q("bronze_login_logs", lambda i: i.bronze_logins)
_q("silver_transactions", lambda i: i.silver_tx)
_q("silver_login_logs", lambda i: i.silver_logins)


def _quality(i: Inputs) -> DataFrame:
    from riskweave.operators.quality import LOGIN_RULES, TRANSACTION_RULES, quality_report
    return quality_report(i.bronze_tx, TRANSACTION_RULES, "transactions").unionByName(
        quality_report(i.bronze_logins, LOGIN_RULES, "login_logs"))


_q("quality_report", _quality)


def _mask_card(i: Inputs) -> DataFrame:
    from riskweave.functions.features import mask_card
    return i.bronze_tx.select("transaction_id", "card_number",
                              mask_card("card_number").alias("card_number_masked"))


def _mask_ip(i: Inputs) -> DataFrame:
    from riskweave.functions.features import mask_ip
    return i.bronze_logins.select("login_id", "ip_address", mask_ip("ip_address").alias("ip_masked"))


_q("mask_card", _mask_card)
_q("mask_ip", _mask_ip)
_q("amount_buckets", lambda i: silver.amount_buckets(i.silver_tx))


def _table_counts(i: Inputs) -> DataFrame:
    from riskweave.sources.writers import table_counts
    return table_counts({"bronze_transactions": i.bronze_tx, "bronze_login_logs": i.bronze_logins,
                         "silver_transactions": i.silver_tx, "silver_login_logs": i.silver_logins,
                         "gold_user_session_risk": i.risk, "gold_wire_after_mfa_change": i.wires})


_q("table_counts", _table_counts)

# --- Gold ---------------------------------------------------------------------
_q("session_join", lambda i: gold.session_join(i.silver_tx, i.silver_logins))
_q("session_join_bucketed", lambda i: gold.session_join(i.silver_tx, i.silver_logins, strategy="bucketed"))
_q("session_risk", lambda i: i.risk)
_q("wire_after_mfa", lambda i: i.wires)
_q("fraud_kpis", lambda i: kpis.fraud_kpis(i.risk))
_q("risk_counts", lambda i: gold.risk_counts(i.risk))
_q("risk_per_transaction", lambda i: _risk_dedup(i))
_q("latest_session", lambda i: gold.latest_session(i.silver_logins))

# --- BI reports (remaining) -------------------------------------------------------
_q("bi_false_positive_rate", lambda i: bi.bi_false_positive_rate(i.risk))
_q("bi_account_takeover", lambda i: bi.bi_account_takeover(i.risk))
_q("bi_wire_after_mfa", lambda i: bi.bi_wire_after_mfa(i.wires))
_q("bi_top_risky_users", lambda i: bi.bi_top_risky_users(i.risk))
_q("bi_bot_detection", lambda i: bi.bi_bot_detection(i.risk))
_q("bi_cross_channel", lambda i: bi.bi_cross_channel(i.risk))
_q("bi_cross_channel_family", lambda i: bi.bi_cross_channel_family(i.risk))
_q("bi_impossible_travel", lambda i: bi.bi_impossible_travel(i.risk))


# --- Review queue ---------------------------------------------------------------
from riskweave.operators import quality, triage as tr  # noqa: E402


#: CSV keeps whole microseconds only when told to.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: A clock before the first row, so that the pages have more rows than they
#: return, and a cursor inside the queue.
_EARLY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
_CURSOR = (55, dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc), "")


def _risk_dedup(i: Inputs) -> DataFrame:
    """One deduplicated frame shared by both syncs, so the identical shuffles
    are planned once and reused (ReusedExchange) within a query."""
    return i._get("risk_dedup", lambda: gold.dedupe_per_transaction(i.risk))


def _batch(i: Inputs, factors: str) -> DataFrame:
    return tr.to_triage(_risk_dedup(i), factors=factors, created_at=F.col("tx_timestamp"))


def _triage0(i: Inputs) -> DataFrame:
    """First sync (one-key factor form) into an empty queue."""
    return i._get("triage0", lambda: tr.upsert(None, _batch(i, "min"), now=i.now))


def _triage_decided(i: Inputs) -> DataFrame:
    return i._get("triage_decided", lambda: tr.apply_decisions(_triage0(i), i.decisions, now=i.now))


def _triage(i: Inputs) -> DataFrame:
    """Second sync (object factor form) upserted over the decided queue."""
    return i._get("triage", lambda: tr.upsert(_triage_decided(i), _batch(i, "object"), now=i.now))


def _tags(i: Inputs) -> DataFrame:
    t = _triage(i)
    tags = tr.parse_factors("triggered_factors")
    return t.select("transaction_id", "triggered_factors", F.array_join(tags, ",").alias("tags"),
                    F.size(tags).alias("n_tags"))


def _triage_validation(i: Inputs) -> DataFrame:
    raw = i.risk.filter(F.col("automated_action").isin("YELLOW_FLAG", "BLOCK")).select(
        "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"), "risk_score",
        "risk_level", "automated_action", F.lit(None).cast("string").alias("analyst_decision"))
    v = quality.validate_triage(raw)
    return v.select("transaction_id", F.array_join("violations", ",").alias("violations"), "is_valid")


_q("flagged_extract", lambda i: tr.to_triage(i.risk, created_at=F.col("tx_timestamp")))
_q("factors_object", lambda i: i.risk.select("transaction_id", "login_id",
                                            tr.factors_object().alias("triggered_factors")))
_q("factors_object_min", lambda i: i.risk.select("transaction_id", "login_id",
                                                tr.factors_object_min().alias("triggered_factors")))
_q("decision_validation", lambda i: quality.validate_decisions(i.decisions)
   .select("transaction_id", "analyst_id", "decision", "is_valid"))
_q("decision_apply", _triage_decided)
_q("triage_upsert", _triage)
_q("decision_outcome", lambda i: tr.decision_outcome(_triage0(i), i.decisions))
_q("decision_outcome_repeats",
   lambda i: tr.decision_outcome(_triage0(i), i.decisions.unionByName(i.decisions)))
_q("fraud_queue", lambda i: tr.fraud_queue(_triage(i), i.now))
_q("queue_page", lambda i: tr.queue_page(_triage(i), i.now))
_q("queue_stats", lambda i: tr.queue_stats(_triage(i), i.now))
_q("queue_size", lambda i: tr.queue_size(_triage(i), i.now))
_q("reviewed_page", lambda i: tr.reviewed_page(_triage(i)))
_q("queue_page_filtered",
   lambda i: tr.queue_page(_triage(i), _EARLY, action="YELLOW_FLAG", risk_level="high", limit=200))
_q("queue_page_after", lambda i: tr.queue_page(_triage(i), _EARLY, after=_CURSOR))
_q("reviewed_page_filtered", lambda i: tr.reviewed_page(_triage(i), decision="RELEASE", limit=200))
_q("review_summary", lambda i: tr.review_summary(_triage(i)))
_q("analyst_metrics", lambda i: tr.analyst_metrics(_triage(i)))
_q("triage_summary", lambda i: tr.triage_summary(_triage(i)))
_q("transaction_detail", lambda i: tr.transaction_detail(_triage(i), i.decisions))
_q("missing_explanation", lambda i: tr.missing_explanation(_triage(i)))
_q("triage_validation", _triage_validation)
_q("session_table", lambda i: tr.session_table(i.bronze_logins, i.risk, i.now))
_q("factor_tags", _tags)


# --- Nine-factor scorer and narratives ------------------------------------------
from riskweave.operators import narrative, scorer  # noqa: E402


def _records(i: Inputs) -> DataFrame:
    """Gold pairs with the scorer's extra fields and the gold signals/score."""
    return i._get("records", lambda: gold.with_risk(scorer.scorer_records(i.silver_tx, i.silver_logins)))


def _nine(i: Inputs) -> DataFrame:
    s = scorer.score_pairs(i.silver_tx, i.silver_logins)
    return s.select("transaction_id", "login_id", "raw_score", "risk_score", "risk_level",
                    "automated_action", F.size("factor_names").alias("n_factors"))


def _expl_input(i: Inputs) -> DataFrame:
    return narrative.explanation_input(gold.dedupe_per_transaction(_records(i)))


def _explanations(i: Inputs) -> DataFrame:
    return i._get("explanations", lambda: tr.apply_explanations(
        _triage(i), narrative.assessment_long(_expl_input(i), i.now)))


_q("impossible_travel", lambda i: scorer.impossible_travel(scorer.scorer_records(i.silver_tx, i.silver_logins)))
_q("nine_factor_score", _nine)
_q("triggered_factors", lambda i: scorer.score_frame(scorer.scorer_records(i.silver_tx, i.silver_logins))
   .select("transaction_id", "login_id", scorer.triggered_json().alias("triggered_factors")))
_q("factor_text", lambda i: narrative.factor_text(scorer.scorer_records(i.silver_tx, i.silver_logins))
   .select("transaction_id", "login_id", "factor_text"))
_q("assessment", lambda i: narrative.assessment(scorer.scorer_records(i.silver_tx, i.silver_logins), i.now)
   .select("transaction_id", "login_id", "explanation"))
_q("assessment_short", lambda i: narrative.assessment_triage(_triage(i), i.now)
   .select("transaction_id", "explanation", "triggered_factors"))
_q("assessment_notebook_model", lambda i: narrative.assessment_notebook_model(
    scorer.scorer_records(i.silver_tx, i.silver_logins)).select("transaction_id", "login_id", "explanation"))
_q("explanation_input", _expl_input)
_q("assessment_long", lambda i: narrative.assessment_long(_expl_input(i), i.now)
   .select("transaction_id", "explanation", "triggered_factors"))
_q("factor_details", lambda i: narrative.factor_details(scorer.scorer_records(i.silver_tx, i.silver_logins))
   .select("transaction_id", "login_id", F.array_join("factor_details", "\n").alias("factor_details")))
_q("prompt_text", lambda i: narrative.prompt_text(scorer.scorer_records(i.silver_tx, i.silver_logins))
   .select("transaction_id", "login_id", "prompt_text"))
_q("assessment_fallback", lambda i: narrative.assessment_fallback(
    scorer.scorer_records(i.silver_tx, i.silver_logins)).select("transaction_id", "login_id", "explanation"))
_q("scored_transactions", lambda i: narrative.score_transactions(
    scorer.scorer_records(i.silver_tx, i.silver_logins), i.now))
_q("explanation_apply", lambda i: _explanations(i).select("transaction_id", "explanation", "triggered_factors"))
_q("explanation_coverage", lambda i: tr.explanation_coverage(_explanations(i)))
_q("explanation_preview", lambda i: tr.explanation_preview(_explanations(i)))


# --- Declared patterns ------------------------------------------------------------
from riskweave.operators import catalogue, patterns  # noqa: E402

# Thresholds that the fixture rows do not reach (users act every hour, no
# amount is under a dollar, no address repeats) are set lower here.


def _networks(i: Inputs) -> DataFrame:
    return i.bronze_logins.withColumn("network", F.substring_index("ip_address", ".", 1))


def _pattern_hits(i: Inputs) -> DataFrame:
    return catalogue.with_severity(catalogue.pattern_hits(i.risk), fixtures.signatures(i.spark))


_q("rapid_geo_hop", lambda i: patterns.rapid_geo_hop(patterns.locations(i.silver_tx, i.silver_logins)))
_q("velocity_spike", lambda i: patterns.velocity_spike(i.silver_tx))
_q("new_device_large", lambda i: patterns.new_device_large(i.silver_tx))
_q("midnight_atm", lambda i: patterns.midnight_atm(i.silver_tx))
_q("round_amount_wire", lambda i: patterns.round_amount_wire(i.silver_tx, amount=1000, multiple=10))
_q("multiple_failed_mfa", lambda i: patterns.multiple_failed_mfa(
    i.silver_logins.withColumn("login_successful", F.lit(True))))
_q("cross_channel_rapid", lambda i: patterns.cross_channel_rapid(i.silver_tx, i.silver_logins, within="1 hour"))
_q("dormant_reactivation", lambda i: patterns.dormant_reactivation(i.silver_tx, days=0.5))
_q("credential_stuffing", lambda i: patterns.credential_stuffing(_networks(i), "network", accounts=5, minutes=1440))
_q("card_testing", lambda i: patterns.card_testing(i.silver_tx, below=2000, count=2, window="1 hour"))
_q("pattern_hits", _pattern_hits)
_q("pattern_report", lambda i: catalogue.pattern_report(_pattern_hits(i)))


# --- Readers and write paths ------------------------------------------------------
import uuid  # noqa: E402

from riskweave.plans import medallion  # noqa: E402
from riskweave.session import shared_path  # noqa: E402
from riskweave.sources import partitions, readers, rejects, schemas, writers  # noqa: E402


def _folder(i: Inputs, name: str) -> str:
    """A new folder under the shared root for what a query lands or writes."""
    return shared_path(i.spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _landed(i: Inputs, df: DataFrame, name: str) -> str:
    path = _folder(i, name)
    df.drop("ingestion_timestamp").write.option("header", "true").option("timestampFormat", _MICROS).csv(path)
    return path


def _csv(i: Inputs, df: DataFrame, schema, name: str) -> DataFrame:
    """Rows as CSV and back through the checked reader, broken lines set aside."""
    return readers.load_bronze(i.spark, _landed(i, df, name), schema, _folder(i, f"{name}-bronze"), now=i.now).good


def _landing_counts(i: Inputs) -> DataFrame:
    count = lambda df, n: readers.landing_count(i.spark, _landed(i, df, n)).select(F.lit(n).alias("table_name"), "row_count")
    return count(i.bronze_tx, "transactions").unionByName(count(i.bronze_logins, "login_logs"))


def _loaded(i: Inputs) -> DataFrame:
    """New files of a landing folder only: the folder is loaded again after each arrival."""
    land, target, ckpt = (_folder(i, n) for n in ("land", "loaded", "load-checkpoint"))
    for part in (0, 1):
        i.bronze_tx.drop("ingestion_timestamp").where(F.pmod(F.hash("transaction_id"), F.lit(2)) == part) \
            .write.mode("append").option("header", "true").option("timestampFormat", _MICROS).csv(land)
        readers.load_incremental(i.spark, land, schemas.TRANSACTIONS, target, ckpt, now=i.now)
    return i.spark.read.parquet(target)


def _ctas(i: Inputs) -> DataFrame:
    name = f"rw_ctas_{uuid.uuid4().hex[:8]}"
    return writers.ctas(i.spark, i.silver_logins, name, comment=medallion.DATASETS["silver_login_logs"][1])


def _stored_counts(i: Inputs) -> DataFrame:
    paths = medallion.run_batch(i.spark, i.bronze_tx, i.bronze_logins, _folder(i, "layers"), now=i.now)
    return writers.stored_counts(i.spark, {k: p for k, p in paths.items() if k != "triage"})


def _bucket_queue(i: Inputs) -> str:
    """First sync, decisions and second sync on the table of key buckets."""
    root = _folder(i, "queue")
    partitions.upsert(i.spark, _batch(i, "min"), root, now=i.now, buckets=4)
    partitions.decide(i.spark, i.decisions, root, now=i.now)
    partitions.upsert(i.spark, _batch(i, "object"), root, now=i.now)
    return root


def _lookup(i: Inputs) -> DataFrame:
    root = _bucket_queue(i)
    last = partitions.queue(i.spark, root).agg(F.max("transaction_id")).first()[0]
    return partitions.lookup(i.spark, root, last) if last else partitions.queue(i.spark, root)


def _rejects(i: Inputs) -> DataFrame:
    """Rows of a sync whose unlabelled levels and negative scores break constraints."""
    batch = _batch(i, "object").withColumns({
        "risk_level": F.when(F.col("amount") % 2 == 0, F.col("risk_level")), "risk_score": F.col("risk_score") - 45})
    checked = rejects.check(batch, _folder(i, "checked"), "one")
    return checked.rejected.select("transaction_id", "risk_score", F.array_join("violations", ",").alias("violations"))


_q("csv_transactions", lambda i: _csv(i, i.bronze_tx, schemas.TRANSACTIONS, "transactions"))
_q("csv_login_logs", lambda i: _csv(i, i.bronze_logins, schemas.LOGIN_LOGS, "login-logs"))
_q("landing_counts", _landing_counts)
_q("incremental_load", _loaded)
_q("ctas_login_logs", _ctas)
_q("stored_table_counts", _stored_counts)
_q("queue_buckets", lambda i: partitions.queue(i.spark, _bucket_queue(i)))
_q("transaction_lookup", _lookup)
_q("queue_rejects", _rejects)
_q("flagged_batch", lambda i: tr.to_triage(_risk_dedup(i), created_at=F.col("tx_timestamp"), limit=100))
